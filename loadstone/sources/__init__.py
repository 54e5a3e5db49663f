"""Where loads read from and write to."""

from loadstone.sources.tables import Source, Warehouse, read_table, write_table

__all__ = ["Source", "Warehouse", "read_table", "write_table"]
