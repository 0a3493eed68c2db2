"""tidemark: keep an analytical lake current from operational tables, on plain Spark and parquet."""

from tidemark.spec import TableSpec
from tidemark.tables.lake_table import LakeTable

__all__ = ["LakeTable", "TableSpec"]
