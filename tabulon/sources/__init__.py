"""Sources and sinks: driver tables, inline rows, CSV, bounded exports, saved models."""

from tabulon.sources.tables import TABLES, read_table, read_tables
from tabulon.sources.inline import inline_table
from tabulon.sources.csv import read_csv, write_csv
from tabulon.sources.export import preview_pandas, features_to_columns, vector_column_to_array
from tabulon.sources.models import save_model, load_model
from tabulon.sources.sinks import write_table

__all__ = [
    "TABLES", "read_table", "read_tables", "inline_table", "read_csv", "write_csv",
    "preview_pandas", "features_to_columns", "vector_column_to_array", "save_model",
    "load_model", "write_table",
]
