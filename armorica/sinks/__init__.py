"""Sinks: delimited files, the fact table and database tables."""

from armorica.sinks.database import append_database, load_once, overwrite_database
from armorica.sinks.files import counted, write_delimited
from armorica.sinks.warehouse import ensure_table, is_stored_small, read_facts, stored_bytes, write_facts, write_table

__all__ = [
    "append_database",
    "counted",
    "ensure_table",
    "is_stored_small",
    "load_once",
    "overwrite_database",
    "read_facts",
    "stored_bytes",
    "write_delimited",
    "write_facts",
    "write_table",
]
