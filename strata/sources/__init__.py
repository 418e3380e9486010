"""Sources and sinks: parquet tables, text CSV landing, catalogue."""

from .catalog import (apply_dictionary, comment_table, create_schema, describe_dictionary, list_tables,
                      overwrite_table, table_comment, use_catalog)
from .csv_text import ingest_all, missing_files, read_text_csv, row_counts, write_text_csv
from .tables import TableSet

__all__ = ["TableSet", "apply_dictionary", "comment_table", "create_schema", "describe_dictionary", "ingest_all",
           "list_tables", "missing_files", "overwrite_table", "read_text_csv", "row_counts", "table_comment",
           "use_catalog", "write_text_csv"]
