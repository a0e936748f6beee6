"""Sources, sinks, schema checks and the test-table adapters."""

from .files import load_table, null_tokens, read_csv_na, read_raw_csv, write_summary, write_table
from .schema import aliased_column, place_column, is_empty, require_columns, string_columns

__all__ = [
    "aliased_column",
    "place_column",
    "is_empty",
    "load_table",
    "null_tokens",
    "read_csv_na",
    "read_raw_csv",
    "require_columns",
    "string_columns",
    "write_summary",
    "write_table",
]
