"""User logic on a batch before it is merged: SQL text or a DataFrame function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.spec import TableSpec

# Fixed value: how SQL texts name the batch.
SOURCE = "<SRC>"


def apply_sql(batch: DataFrame, text: str, **relations: DataFrame) -> DataFrame:
    """Run SQL over the batch; ``<SRC>`` is the batch, ``{name}`` any other relation given."""
    if SOURCE not in text:
        raise ValueError(f"the transformer SQL must read from {SOURCE}")
    return batch.sparkSession.sql(text.replace(SOURCE, "{batch}"), batch=batch, **relations)


def apply_callable(batch: DataFrame, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return batch.transform(function)


def transformed(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The batch after the transformers of its table spec."""
    if spec.transformer_sql:
        batch = apply_sql(batch, spec.transformer_sql)
    if spec.transformer:
        batch = apply_callable(batch, spec.transformer)
    return batch
