"""Readers and writers. Only these modules touch storage."""

from barloom.sources.documents import (
    land_documents,
    list_documents,
    list_versions,
    read_documents,
)
from barloom.sources.jdbc import export_tables
from barloom.sources.tables import (
    GoldTables,
    append_table,
    read_gold,
    read_if_written,
    read_table,
    register_views,
    remove_folder,
    replace_partitions,
    replace_table,
)

__all__ = [
    "GoldTables",
    "append_table",
    "export_tables",
    "land_documents",
    "list_documents",
    "list_versions",
    "read_documents",
    "read_gold",
    "read_if_written",
    "read_table",
    "register_views",
    "remove_folder",
    "replace_partitions",
    "replace_table",
]
