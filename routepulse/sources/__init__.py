"""Tables in (Parquet, CSV, gzip CSV) and out (Parquet)."""

from routepulse.sources.tables import (
    conform,
    load_hex_tables,
    load_tables,
    read_pings,
    read_table,
    write_hex_tables,
)

__all__ = [
    "conform",
    "load_hex_tables",
    "load_tables",
    "read_pings",
    "read_table",
    "write_hex_tables",
]
