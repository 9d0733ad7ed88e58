"""Reading CSV exports and reading and writing catalog tables."""

from assay.sources.csv_files import read_csv, read_text, typed
from assay.sources.schemas import SOURCE_SCHEMAS
from assay.sources.tables import (
    append_rows,
    create_schema,
    drop_table,
    overwrite_table,
    truncate,
)

__all__ = [
    "SOURCE_SCHEMAS",
    "append_rows",
    "create_schema",
    "drop_table",
    "overwrite_table",
    "read_csv",
    "read_text",
    "truncate",
    "typed",
]
