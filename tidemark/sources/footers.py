"""Extremes and counts of plain parquet files from their footers alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings under which Spark answers MIN, MAX and COUNT from parquet statistics.
_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
#: types whose statistics are exact
_EXACT = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def extremes(spark: SparkSession, folder: str, columns: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """One row: the number of rows, and ``least_``, ``greatest_`` and ``filled_`` (values not NULL) of each column.

    No row group is read. Texts and times are refused: their statistics may be cut off, so Spark reads the rows for them;
    keep a day or a number beside them. The result lives in a session of its own, as the settings hold for a session.
    """
    own = spark.newSession()
    for key, value in _SETTINGS.items():
        own.conf.set(key, value)
    rows = (own.read.schema(schema) if schema else own.read).parquet(folder)
    kinds = {f.name: f.dataType for f in rows.schema}
    inexact = [c for c in columns if not isinstance(kinds[c], _EXACT)]
    if inexact:
        raise ValueError(f"no exact statistics for {inexact}")
    wanted = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        wanted += [F.min(c).alias(f"least_{c}"), F.max(c).alias(f"greatest_{c}"), F.count(c).alias(f"filled_{c}")]
    return rows.agg(*wanted)
