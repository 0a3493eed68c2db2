"""Pre-aggregated sales on top of the denormalized order line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.aggregate import Aggregate

MONEY = "decimal(18,2)"
#: the same sales as a plan that follows changes
SALES = Aggregate(
    groups=("district_name", "order_date"),
    count="n_lines",
    sums={"sum_quantity": f"CAST(quantity AS {MONEY})", "sum_amount": f"CAST(amount AS {MONEY})"},
    maxima={"max_amount": f"CAST(amount AS {MONEY})"},
)


def sales_by_district_and_day(order_lines: DataFrame) -> DataFrame:
    """Lines, quantity and amount per district and order day.

    Sums run on exact decimals, so the result does not depend on the order of the rows. Every task adds up
    its own rows first; only one row per group and task is shuffled.
    """
    amount = F.col("amount").cast(MONEY)
    quantity = F.col("quantity").cast(MONEY)
    return order_lines.groupBy("district_name", "order_date").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(quantity).cast("double").alias("sum_quantity"),
        F.sum(amount).cast("double").alias("sum_amount"),
        (F.sum(amount).cast("double") / F.count(F.lit(1))).alias("avg_amount"),
        F.max(amount).cast("double").alias("max_amount"),
    )
