"""Declared shapes: raw inputs as DDL strings, stored tables as ``TableSpec``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- raw inputs ----------------------------------------------------------------
AWARD_DETAIL_DDL = (
    "fain string, generated_unique_award_id string, total_funding decimal(18,2), "
    "total_account_outlay decimal(18,2), total_account_obligation decimal(18,2), "
    "total_outlay decimal(18,2), total_obligation decimal(18,2), "
    "cfda_info array<struct<cfda_number:string,cfda_title:string,cfda_objectives:string>>, "
    "place_of_performance struct<state_name:string,state_code:string>, "
    "awarding_agency struct<toptier_agency:struct<name:string,code:string>,"
    "subtier_agency:struct<name:string,code:string>,office_agency_name:string>, "
    "funding_agency struct<toptier_agency:struct<name:string,code:string>,"
    "subtier_agency:struct<name:string,code:string>,office_agency_name:string>, "
    "recipient struct<location:struct<state_name:string,state_code:string>>, "
    "period_of_performance_start_date string, period_of_performance_current_end_date string"
)
AWARDS_DDL = (
    "`Award ID` string, `Recipient Name` string, `Award Amount` decimal(18,2), "
    "`Total Outlays` decimal(18,2), Description string, `Award Type` string, def_codes string, "
    "`COVID-19 Obligations` decimal(18,2), `COVID-19 Outlays` decimal(18,2), "
    "`Infrastructure Obligations` decimal(18,2), `Infrastructure Outlays` decimal(18,2), "
    "`Awarding Agency` string, `Awarding Sub Agency` string, `Start Date` string, "
    "`End Date` string, recipient_id string, prime_award_recipient_id string, "
    "generated_internal_id string"
)
OTHER_DDL = (
    "`Award ID` string, generated_unique_award_id string, total_funding decimal(18,2), "
    "total_account_outlay decimal(18,2), total_account_obligation decimal(18,2), "
    "cfda_objectives string, cfda_title string, cfda_number string, "
    "place_of_performance_state_name string, place_of_performance_state_code string, "
    "total_outlay decimal(18,2), total_obligated decimal(18,2), awarding_agency_name string, "
    "awarding_agency_code string, awarding_sub_agency_name string, "
    "awarding_sub_agency_code string, funding_agency_name string, funding_agency_code string, "
    "funding_sub_agency_name string, funding_sub_agency_code string, "
    "recipient_state_name string, recipient_state_code string, funding_office_name string, "
    "awarding_office_name string, start_date string, end_date string"
)
FUNDING_DDL = (
    "transaction_obligated_amount decimal(18,2), gross_outlay_amount decimal(18,2), "
    "disaster_emergency_fund_code string, federal_account string, account_title string, "
    "funding_agency_name string, funding_agency_id int, funding_toptier_agency_id int, "
    "funding_agency_slug string, awarding_agency_name string, awarding_agency_id int, "
    "awarding_toptier_agency_id int, awarding_agency_slug string, object_class string, "
    "object_class_name string, program_activity_code string, program_activity_name string, "
    "reporting_fiscal_year int, reporting_fiscal_quarter int, reporting_fiscal_month int, "
    "is_quarterly_submission boolean, generated_internal_id string, `Award ID` string"
)
SUBAWARDS_DDL = (
    "subaward_id string, subaward_number string, description string, action_date string, "
    "amount decimal(18,2), recipient_name string, generated_internal_id string"
)
TRANSACTIONS_DDL = (
    "id string, type string, type_description string, action_date string, action_type string, "
    "action_type_description string, modification_number string, description string, "
    "federal_action_obligation decimal(18,2), face_value_loan_guarantee decimal(18,2), "
    "original_loan_subsidy_cost decimal(18,2), cfda_number string, "
    "generated_internal_id string, `Award ID` string"
)
FUND_CODES_DDL = "def_codes string, `PL Number 1` string"
CELLS_DDL = "doc_id string, page int, table_no int, row_no int, col_no int, text string"
BLOCKS_DDL = (
    "doc_id string, block_id string, block_type string, alias string, "
    "answer_ids array<string>, text string"
)
LINES_DDL = "doc_id string, file_name string, line_no bigint, line string"


# --- stored tables ---------------------------------------------------------------
@dataclass(frozen=True)
class TableSpec:
    """A stored table: columns, key, parents, text rules and the buckets its keys fall into.

    ``buckets`` is set before the first load and stays.
    """

    name: str
    ddl: str
    key: tuple[str, ...]
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    serial: str | None = None
    defaults: dict[str, object] = field(default_factory=dict)
    buckets: int = 8

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Parents come before their children.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in [
        TableSpec(
            "disaster",
            "disaster_id int, disaster_name string, disaster_year string",
            ("disaster_id",),
            lengths={"disaster_name": 255, "disaster_year": 9},
        ),
        TableSpec(
            "states",
            "state_code string, state_name string",
            ("state_code",),
            required=("state_name",),
            lengths={"state_code": 2, "state_name": 100},
        ),
        TableSpec(
            "grantee",
            "grantee_id int, grantee_name string, state_code string",
            ("grantee_id",),
            parents={"state_code": ("states", "state_code")},
            lengths={"grantee_name": 255, "state_code": 100},
        ),
        TableSpec(
            "granthistory",
            "grant_history_id int, disaster_id int, grantee_id int, grant_award decimal(15,2), "
            "report_date date",
            ("grant_history_id",),
            parents={
                "disaster_id": ("disaster", "disaster_id"),
                "grantee_id": ("grantee", "grantee_id"),
            },
        ),
        TableSpec(
            "publiclaw",
            "pl_number string, pl_date date",
            ("pl_number",),
            lengths={"pl_number": 20},
        ),
        TableSpec(
            "disasterpubliclaw",
            "disaster_id int, pl_number string",
            ("disaster_id", "pl_number"),
            parents={
                "disaster_id": ("disaster", "disaster_id"),
                "pl_number": ("publiclaw", "pl_number"),
            },
            lengths={"pl_number": 20},
        ),
        TableSpec(
            "cfdaprograms",
            "cfda_number string, cfda_title string, cfda_objectives string",
            ("cfda_number",),
            required=("cfda_title",),
            lengths={"cfda_number": 7, "cfda_title": 255},
        ),
        TableSpec(
            "agencies",
            "agency_id int, agency_name string, agency_code string, toptier_agency_id int, "
            "agency_slug string",
            ("agency_code",),
            required=("agency_name",),
            lengths={"agency_name": 255, "agency_code": 50, "agency_slug": 100},
        ),
        TableSpec(
            "subagency",
            "sub_agency_code int, sub_agency_name string",
            ("sub_agency_code",),
            required=("sub_agency_name",),
            lengths={"sub_agency_name": 100},
        ),
        TableSpec(
            "recipients",
            "recipient_id string, recipient_name string, recipient_state_code string",
            ("recipient_id",),
            parents={"recipient_state_code": ("states", "state_code")},
            required=("recipient_name",),
            lengths={"recipient_id": 50, "recipient_name": 255, "recipient_state_code": 2},
        ),
        TableSpec(
            "grants",
            "grant_id string, generated_internal_id string, cfda_number string, "
            "place_of_performance_state_code string, recipient_state_code string, "
            "awarding_agency_code string, funding_agency_code string, "
            "awarding_sub_agency_code int, funding_sub_agency_code int, "
            "total_funding decimal(18,2), total_account_outlay decimal(18,2), "
            "total_account_obligation decimal(18,2), total_outlay decimal(18,2), "
            "total_obligated decimal(18,2), description string, award_type string, "
            "def_codes string, public_law_number string, covid_19_obligations decimal(18,2), "
            "covid_19_outlays decimal(18,2), infrastructure_obligations decimal(18,2), "
            "infrastructure_outlays decimal(18,2), start_date date, end_date date, "
            "funding_office_name string, awarding_office_name string",
            ("grant_id",),
            parents={
                "cfda_number": ("cfdaprograms", "cfda_number"),
                "place_of_performance_state_code": ("states", "state_code"),
                "recipient_state_code": ("states", "state_code"),
                "awarding_agency_code": ("agencies", "agency_code"),
                "funding_agency_code": ("agencies", "agency_code"),
                "awarding_sub_agency_code": ("subagency", "sub_agency_code"),
                "funding_sub_agency_code": ("subagency", "sub_agency_code"),
            },
            lengths={
                "grant_id": 50, "generated_internal_id": 50, "cfda_number": 7,
                "place_of_performance_state_code": 2, "recipient_state_code": 2,
                "awarding_agency_code": 50, "funding_agency_code": 50, "award_type": 100,
                "def_codes": 50, "public_law_number": 20, "funding_office_name": 255,
                "awarding_office_name": 255,
            },
        ),
        TableSpec(
            "funding",
            "funding_id bigint, grant_id string, transaction_obligated_amount decimal(18,2), "
            "gross_outlay_amount decimal(18,2), federal_account string, account_title string, "
            "object_class string, object_class_name string, program_activity_code string, "
            "program_activity_name string, reporting_fiscal_year int, "
            "reporting_fiscal_quarter smallint, reporting_fiscal_month smallint, "
            "is_quarterly_submission boolean",
            ("funding_id",),
            parents={"grant_id": ("grants", "grant_id")},
            lengths={
                "grant_id": 50, "federal_account": 50, "account_title": 255, "object_class": 50,
                "object_class_name": 255, "program_activity_code": 50,
                "program_activity_name": 255,
            },
            serial="funding_id",
        ),
        TableSpec(
            "subawards",
            "subaward_id bigint, grant_id string, subaward_number string, description string, "
            "action_date date, amount decimal(18,2), recipient_id string",
            ("subaward_id",),
            parents={
                "grant_id": ("grants", "grant_id"),
                "recipient_id": ("recipients", "recipient_id"),
            },
            lengths={"grant_id": 50, "subaward_number": 50, "recipient_id": 50},
        ),
        TableSpec(
            "transactions",
            "transaction_id bigint, grant_id string, type string, type_description string, "
            "action_date date, action_type string, action_type_description string, "
            "modification_number string, description string, "
            "federal_action_obligation decimal(18,2), face_value_loan_guarantee decimal(18,2), "
            "original_loan_subsidy_cost decimal(18,2), cfda_number string",
            ("transaction_id",),
            parents={
                "grant_id": ("grants", "grant_id"),
                "cfda_number": ("cfdaprograms", "cfda_number"),
            },
            lengths={
                "grant_id": 50, "type": 50, "type_description": 255, "action_type": 50,
                "action_type_description": 255, "modification_number": 50, "cfda_number": 7,
            },
            serial="transaction_id",
        ),
        TableSpec(
            "federalawards",
            "award_id bigint, grant_id string, recipient_id string, award_amount decimal(18,2), "
            "total_outlays decimal(18,2), description string, award_type string, "
            "covid_19_obligations decimal(18,2), covid_19_outlays decimal(18,2), "
            "infrastructure_obligations decimal(18,2), infrastructure_outlays decimal(18,2), "
            "start_date date, end_date date",
            ("award_id",),
            parents={
                "grant_id": ("grants", "grant_id"),
                "recipient_id": ("recipients", "recipient_id"),
            },
            lengths={"grant_id": 50, "recipient_id": 50, "award_type": 100},
            serial="award_id",
        ),
        TableSpec(
            "grantfinancialreports",
            "report_id bigint, grant_id string, state_code string, grant_award decimal(18,2), "
            "balance decimal(18,2), disaster_year int, grant_age_in_months smallint, "
            "expected_spending_percentage decimal(5,2), drawn_percentage decimal(5,2), "
            "spending_status string, amount_behind_pace decimal(18,2), report_date date",
            ("report_id",),
            parents={
                "grant_id": ("grants", "grant_id"),
                "state_code": ("states", "state_code"),
            },
            lengths={"grant_id": 50, "state_code": 2, "spending_status": 50},
            serial="report_id",
        ),
        TableSpec(
            "activities",
            "activity_title string, activity_id bigint, activity_number string, "
            "activity_type string, activity_status string, project_number string, "
            "project_title string, projected_start_date date, projected_end_date date, "
            "national_objective string, responsible_organization string, "
            "activity_description string, progress_narrative string, benefit_type string, "
            "completed_activity_actual_end_date date",
            ("activity_id",),
            lengths={
                "activity_number": 50, "activity_type": 100, "activity_status": 50,
                "project_number": 50, "project_title": 100, "national_objective": 50,
                "responsible_organization": 100, "benefit_type": 50,
            },
            serial="activity_id",
        ),
        TableSpec(
            "amountdescriptions",
            "amount_desc_id bigint, description string, time_period_amount decimal(18,2), "
            "time_period string, to_date_amount decimal(18,2)",
            ("amount_desc_id",),
            lengths={"time_period": 50},
            serial="amount_desc_id",
        ),
        TableSpec(
            "performancereports",
            "performance_id bigint, activity_id bigint, amount_desc_id bigint, "
            "grant_id string, to_date_amount decimal(18,2), time_period_amount decimal(18,2)",
            ("performance_id",),
            parents={
                "activity_id": ("activities", "activity_id"),
                "amount_desc_id": ("amountdescriptions", "amount_desc_id"),
                "grant_id": ("grants", "grant_id"),
            },
            lengths={"grant_id": 50},
            serial="performance_id",
        ),
    ]
}
