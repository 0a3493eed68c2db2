"""The registered queries: every operator run over whole tables, each with the SQL that must agree."""

from tidemark.queries import errors, gold, merges, raw, rules, streams, tables  # noqa: F401  (fill the registry)
from tidemark.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
