"""Full extracts over JDBC, read in parallel slices of one column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults and option names of an extract.
FETCH_SIZE = 10000
SLICING = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(table: str, url: str, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of ``spark.read.format("jdbc")`` for one table.

    Any option may be overridden. The table itself is read unless ``dbtable`` or ``query`` says otherwise;
    a ``query`` that is also sliced becomes a derived table, because Spark refuses the two together.
    """
    given = {k: str(v) for k, v in (overrides or {}).items()}
    named = {k.lower() for k in given}
    options = {"url": url}
    if "fetchsize" not in named:
        options["fetchsize"] = str(FETCH_SIZE)
    options.update(given)
    present = [o for o in SLICING if o.lower() in named]
    if present and len(present) < len(SLICING):
        raise ValueError(f"{table}: slicing needs all of {SLICING}, got only {present}")
    if {"query", "dbtable"} <= named:
        raise ValueError(f"{table}: give either query or dbtable")
    if "query" in named and present:
        query = options.pop(next(k for k in given if k.lower() == "query"))
        options["dbtable"] = f"({query}) extract"
    elif "query" not in named and "dbtable" not in named:
        options["dbtable"] = table
    return options


def read_table(
    spark: SparkSession, table: str, url: str, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """One table (or query) of a database; filters and columns used later are pushed to it by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(table, url, overrides)).load()


def slice_edges(lower: int, upper: int, slices: int) -> list[int]:
    """The inner edges of evenly wide slices of ``lower..upper``: slice i ends before edge i."""
    if upper <= lower:
        return []
    slices = min(slices, upper - lower)
    return [lower + (upper - lower) * i // slices for i in range(1, slices)]


def slice_predicates(column: str, lower: int, upper: int, slices: int) -> list[str]:
    """One WHERE condition per slice, for ``spark.read.jdbc(..., predicates=...)``.

    The bounds set the width only: rows below, above and without a value fall into the first or last slice.
    """
    edges = slice_edges(lower, upper, slices)
    if not edges:
        return ["1 = 1"]
    first = f"{column} < {edges[0]} OR {column} IS NULL"
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(edges, edges[1:])]
    return [first, *inner, f"{column} >= {edges[-1]}"]


def slice_number(column: str, lower: int, upper: int, slices: int) -> Column:
    """Which slice reads a row (from 0): shows before a load whether bounds give even slices."""
    edges = slice_edges(lower, upper, slices)
    number = F.lit(0)
    for edge in edges:
        number = number + F.when(F.col(column) >= edge, 1).otherwise(0)
    return number
