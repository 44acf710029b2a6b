"""Sources and sinks: the driver tables, the client view, files."""

from propensio.sources.tables import clients_view, read_driver_table
from propensio.sources.files import (
    normalize_nan,
    read_client_file,
    read_table,
    trim_column_names,
    write_json_rows,
    write_table,
)

__all__ = [
    "clients_view",
    "read_driver_table",
    "normalize_nan",
    "read_client_file",
    "read_table",
    "trim_column_names",
    "write_json_rows",
    "write_table",
]
