"""Conform rows to a registered schema, and report how they differ from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds of difference in a drift report.
ADDED, REMOVED, RETYPED = "added", "removed", "retyped"


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Same columns, order and types as ``schema``, all nullable.

    A missing column becomes NULL, an unknown one is left out (``schema_drift`` reports both). A value that
    does not fit the registered type fails the job; ``quarantine`` separates such rows beforehand.
    """
    present = {f.name: f.dataType for f in rows.schema}

    def column(field: T.StructField):
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if present[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in schema])


def drift(found: T.StructType, registered: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, registered type, found type) for every column that differs."""
    old = {f.name: f.dataType.simpleString() for f in registered}
    new = {f.name: f.dataType.simpleString() for f in found}
    changes = [(c, REMOVED, t, None) for c, t in old.items() if c not in new]
    changes += [(c, ADDED, None, t) for c, t in new.items() if c not in old]
    changes += [(c, RETYPED, t, new[c]) for c, t in old.items() if c in new and new[c] != t]
    return sorted(changes)


def drift_report(rows: DataFrame, registered: T.StructType, table: str) -> DataFrame:
    """The differences as a small table, with the rows and filled values each one touches.

    The counts come from one aggregation over the rows; nothing is changed or rejected.
    """
    found = drift(rows.schema, registered)
    out = "table_name string, column_name string, change string, registered_type string, found_type string, " \
          "n_rows long, n_filled long"
    if not found:
        return rows.sparkSession.createDataFrame([], out)
    counted = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            (F.lit(0).cast("long") if new is None else F.count(F.col(name))).alias(f"_filled_{i}")
            for i, (name, _, _, new) in enumerate(found)
        ],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(change).alias("change"),
                F.lit(old).cast("string").alias("registered_type"),
                F.lit(new).cast("string").alias("found_type"),
                F.col("n_rows"),
                F.col(f"_filled_{i}").alias("n_filled"),
            )
            for i, (name, change, old, new) in enumerate(found)
        ]
    )
    return counted.select(F.inline(entries))
