"""tenderlake: procurement feed (Atom/XML) analytics on Spark DataFrames."""

from tenderlake.schema import ENTRY_SCHEMA, ENTRY_SCHEMA_RAW, entry_schema

__all__ = ["ENTRY_SCHEMA", "ENTRY_SCHEMA_RAW", "entry_schema"]
