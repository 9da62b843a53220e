"""Source tables: schemas, readers and conformance."""

from .schemas import ALL_SCHEMAS, CW_SCHEMAS, WT_SCHEMAS
from .tables import SchemaError, conform, conform_all, read_family, read_table

__all__ = ["ALL_SCHEMAS", "CW_SCHEMAS", "WT_SCHEMAS", "SchemaError", "conform",
           "conform_all", "read_family", "read_table"]
