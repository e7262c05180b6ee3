"""Names, patterns and formats that decide results.

They describe the published inputs and tables, so they must stay as they are.
"""

# --- missing-value markers -------------------------------------------------
MISSING_TEXT = ["", "nan", "No answer found"]
NO_ANSWER = "No answer found"

# --- grant ids ---------------------------------------------------------------
GRANT_ID_PATTERN = r"^B-[0-9]{2}-[A-Z]{2}-[0-9]{2}-[0-9]{4}$"

# --- dates -------------------------------------------------------------------
STAGING_DATE_FORMAT = "MM-dd-yyyy"
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "MM-dd-yyyy", "MMMM d, yyyy", "MMM d, yyyy"]
LAW_DATE_FORMATS = [
    "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy",
    "MMM d,yyyy", "MMMM d,yyyy", "yyyy-MM-dd", "MM/dd/yyyy",
]
LONG_DATE_FORMAT = "MMMM d, yyyy"
LONG_DATE_PATTERN = (
    r"\b(?:January|February|March|April|May|June|July|August|September|October"
    r"|November|December) \d{1,2}, \d{4}\b"
)
ISO_DATE_PATTERN = r"\b\d{4}-\d{2}-\d{2}\b"
FILE_MONTH_PATTERN = r"(\d{4})-(\d{1,2})"
FILE_DATE_PATTERN = r"(\d{4}[-_]\d{1,2})|(\d{1,2}[-_]\d{1,2}[-_]\d{4})"
UNKNOWN_DATE = "unknown_date"
REPORT_DATE_PATTERN = r"([A-Z][a-z]+ \d{1,2}, \d{1,5})"
HEADING_YEARS_PATTERN = r"\d{4}-\d{4}"

# --- disaster history reports --------------------------------------------------
# Tried in this order, each anchored at the start of the line.
EVENT_PATTERNS = [
    r"([A-Za-z, ]+ \d{4}-\d{4})",
    r"([A-Za-z, ]+ \d{4})",
    r"(\d{4})-(\d{4})\s+(.+)",
    r"(\d{4})\s+(.+)",
    r"Hurricane[s]? [A-Za-z, &]+ \d{4}",
    r"Hurricane [A-Za-z ]+ \d{4}",
    r"Hurricanes [A-Za-z, ]+",
]
LAW_PATTERN = (
    r"(P\.?L\.?\s*\d{2,3}\s*-\s*\d{1,3})\s*"
    r"([A-Za-z]{3,9}\.?\s*\d{1,2},?\s*\d{4}"
    r"|[A-Za-z]{3,9}\.?\s*\d{1,2}(?:[\.\-]?\s*\d{4})?"
    r"|(?:\w+\s*\d{1,2}(?:[\.\-]?\s*\d{4})?))?"
)
LAW_NUMBER_PATTERN = r"P\.?L\.?\s*\d{2,3}\s*-\s*\d{1,3}"
STANDALONE_LAW_PATTERN = r"(P\.?L\.?\s*\d{2,3}\s*-\s*\d{1,3})(?=\s*[^\d]|$)"
EVENT_YEAR_PATTERN = r"(\d{4}(?:-\d{4})?)"
REPORT_TERRITORY = "PUERTO RICO"

# --- file names ----------------------------------------------------------------
BATCH_PATTERN = r"usa_spending_data/[a-z_]+_(\d{8}_\d{6})\.csv"
HISTORY_BATCH_PATTERN = r"_(\d{1,2}_\d{1,2}_\d{4}|\d{4}_\d{1,2}|unknown_date)\.csv$"

# Keyword in the file name -> table, parents before children.
AWARD_FILE_TABLES = [
    ("states", "states"),
    ("cfda", "cfdaprograms"),
    ("recipients", "recipients"),
    ("agency_data", "agencies"),
    ("sub_agency", "subagency"),
    ("grants", "grants"),
    ("funding", "funding"),
    ("federal_awards", "federalawards"),
    ("transactions", "transactions"),
    ("sub_awards", "subawards"),
]
HISTORY_FILE_TABLES = [
    ("disaster_events", "disaster"),
    ("grantee", "grantee"),
    ("grant", "granthistory"),
    ("public_law_numbers", "publiclaw"),
    ("disaster_public_law", "disasterpubliclaw"),
]
PERFORMANCE_FILE_TABLES = [
    ("amount_description", "amountdescriptions"),
    ("activity", "activities"),
    ("performance_reports", "performancereports"),
]

# --- web links -------------------------------------------------------------------
REPORT_SITE = "https://www.hud.gov/"
REPORT_SUFFIX = ".pdf"

# --- award search ------------------------------------------------------------------
AWARD_TYPE_CODES = ["02", "03", "04", "05"]
PROGRAM_NUMBERS = ["14.218", "14.228", "14.248"]
PAGE_LIMIT = 100

# --- financial reports ---------------------------------------------------------------
OLD_LAYOUT_BEFORE_YEAR = 2022
OLD_LAYOUT = [
    "Grantee", "Grant", "Grant Award", "Balance", "Last Month Spending", "Spending Status",
]
NEW_LAYOUT = [
    "Grantee", "Grant ID", "Grant Award", "Balance", "Disaster Year", "Grant Age in Months",
    "Expected Spending %", "Drawn %", "Spending Status", "Amount Behind Pace",
]
CONTINUATION_NAMES = [
    ",", "Rouge, LA", "AL", "Samoa", "TX", "DOH", "(NYS)", "OCRA", "County, PA", "PA", "FL",
    "Development Corporation (NYS)", "LA", "County, HI", "County, AL", "Charles, LA",
    "County, PA", "Davidson, TN", "Orleans, LA", "City, NY", "Carolina- NCORR", "Islands",
    "Carolina", "County, SC", "MA", "MI", "NY", "SC",
]

# --- quarterly performance reports -----------------------------------------------------
FIRST_PERFORMANCE_ID = 128
REPORT_PERIOD = "Apr 1 thru Jun 30, 2024"
QUESTION_ALIASES = [
    "Grantee_Activity_Number", "Activity_Title", "Activity_Type", "Activity_Status",
    "Project_Number", "Project_Title", "Projected_Start_Date", "Projected_End_Date",
    "Benefit_Type", "Completed_Activity_Actual_End_Date", "National_Objective",
    "Responsible_Organization",
]

# --- states and territories --------------------------------------------------------------
STATES = {
    "Alabama": "AL", "Alaska": "AK", "American Samoa": "AS", "Arizona": "AZ",
    "Arkansas": "AR", "California": "CA", "Colorado": "CO", "Connecticut": "CT",
    "Delaware": "DE", "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA",
    "Guam": "GU", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN",
    "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME",
    "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE",
    "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM",
    "New York": "NY", "North Carolina": "NC", "North Dakota": "ND",
    "Northern Mariana Islands": "MP", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Puerto Rico": "PR", "Rhode Island": "RI",
    "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX",
    "Utah": "UT", "Vermont": "VT", "Virgin Islands": "VI", "Virginia": "VA",
    "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}
