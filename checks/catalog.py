"""All checked queries; importing the modules registers them."""

from checks import (  # noqa: F401
    clean_checks,
    join_checks,
    load_checks,
    ordered_checks,
    source_checks,
    table_checks,
    text_checks,
)
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
