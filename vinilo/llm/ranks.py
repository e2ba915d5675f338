"""Ranks and running sums within groups of any size, in two steps.

A group is cut into buckets by a uniform key; a window ranks inside each
bucket, and the buckets' totals, summed up in key order, give what comes
before. No task holds more than a bucket of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 100_000


def hex_digits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """How many hexadecimal digits of a uniform key make buckets of that size."""
    digits = 0
    while rows > bucket_rows * 16**digits:
        digits += 1
    return digits


def running(
    df: DataFrame,
    group: list[str],
    bucket: Column,
    order: list[str],
    amount: Column,
    name: str,
) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over the rows before, in (bucket, order)."""
    own = df.columns
    cut = df.withColumns({"_bucket": bucket, "_amount": amount})
    totals = cut.groupBy(*group, "_bucket").agg(F.sum("_amount").alias("_total"))
    ahead = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = totals.select(
        *[F.col(g).alias(f"_key_{g}") for g in group],
        F.col("_bucket").alias("_key_bucket"),
        F.coalesce(
            F.sum("_total").over(
                ahead.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_before"),
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = cut.withColumn("_within", F.sum("_amount").over(inside) - F.col("_amount"))
    same = F.col("_bucket") == F.col("_key_bucket")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_key_{g}"))
    return within.join(before, same).select(
        *own, (F.col("_before") + F.col("_within")).cast("long").alias(name)
    )
