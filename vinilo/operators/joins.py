"""Joins that stay balanced when one key holds a large share of the rows.

A table is broadcast only after its row count has been checked. Beyond that,
keys with many rows are found by counting, and each is split over as many join
keys as its size asks for, with its partner rows repeated once per split. Every
row of ``facts`` meets each partner exactly once, so results are unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
ROWS_PER_SPLIT = 1_000_000
MAX_HOT_KEYS = 100_000
NULL_SPLITS = 1 << 20

LEFT_KEEPING = ("inner", "left", "left_semi", "left_anti")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``max_rows`` rows; stops counting beyond."""
    return df.select(df.columns[0]).limit(max_rows + 1).count() <= max_rows


def hot_keys(
    facts: DataFrame,
    key: str,
    rows_per_split: int = ROWS_PER_SPLIT,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Keys to be split: (key, _splits), never more than ``max_hot_keys`` rows.

    A key must hold at least ``1 / max_hot_keys`` of all rows, which is what
    bounds the result however large ``facts`` is.
    """
    counts = (
        facts.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    return counts.filter(
        (F.col("_rows") > rows_per_split) & (F.col("_rows") * max_hot_keys >= total)
    ).select(key, F.ceil(F.col("_rows") / rows_per_split).cast("int").alias("_splits"))


def skew_join(
    facts: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_split: int = ROWS_PER_SPLIT,
    max_hot_keys: int = MAX_HOT_KEYS,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on ``key`` with the hot keys of ``facts`` split.

    Keys are counted in ``count_in`` where that is given: a frame with the same
    keys as ``facts`` that is cheaper to read.

    The split of a row is taken from a hash of the row and the number of the map
    task that reads it. Both stay the same when a lost task is run again; the hash
    spreads the rows of one task, the number the copies of one row. Rows without a
    key have no partners and are spread in the same way, over all partitions.
    """
    if how not in LEFT_KEEPING:
        raise ValueError(f"how must be one of {LEFT_KEEPING}, not {how!r}")
    counted = facts if count_in is None else count_in
    hot = F.broadcast(hot_keys(counted, key, rows_per_split, max_hot_keys))
    task = F.spark_partition_id()
    spread = F.shiftright(F.xxhash64(*facts.columns), 1) + task
    salted = (
        facts.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(spread, F.lit(NULL_SPLITS)).cast("int"))
            .when(F.col("_splits").isNotNull(), F.pmod(spread, F.col("_splits")).cast("int"))
            .otherwise(F.lit(0)),
        )
        .drop("_splits")
    )
    repeated = (
        other.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)),
        )
        .drop("_splits")
    )
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    size_of: DataFrame | None = None,
    count_in: DataFrame | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Join to a table with one row per ``key``.

    Small tables are broadcast after their row count is checked; larger ones
    go through ``skew_join``. The check is made on ``size_of`` where that is
    given: a frame with no fewer rows that is cheaper to count.
    """
    if fits_broadcast(dimension if size_of is None else size_of, max_rows):
        return facts.join(F.broadcast(dimension), key, how)
    return skew_join(facts, dimension, key, how, rows_per_split, count_in=count_in)
