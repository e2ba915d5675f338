"""Pages of a table at any offset, by an index of order statistics.

The table is written once in key order, cut into ranges of about as many rows, each
row with its range and its place there. The ranges' row counts with running totals
tell which ranges hold a page, so a page reads those alone and gathers no row but
its own. Under a condition the ranges are counted anew, where the condition holds,
and the page is found among them in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vinilo.operators.shop import MAX_PAGE

RANGE, PLACE = "_range", "_place"
RANGE_ROWS = 1_000_000
MAX_RANGES = 100_000
# So many ranges are cut as small as asked for; a folder each, more of them cost more than they save.
SMALL_RANGES = 128
# Of monotonically_increasing_id: the lower bits count the rows of a partition.
_PLACE_BITS = (1 << 33) - 1


def range_count(rows: int, range_rows: int) -> int:
    """Number of ranges for a table: of ``range_rows`` rows, or of more where they would be many.

    Beyond ``SMALL_RANGES`` ranges grow up to ``RANGE_ROWS`` rows before there are more of them.
    """
    wanted = -(-rows // range_rows)
    if wanted > SMALL_RANGES:
        wanted = max(SMALL_RANGES, -(-rows // max(range_rows, RANGE_ROWS)))
    return min(max(wanted, 1), MAX_RANGES)


@dataclass(frozen=True)
class PageIndex:
    """``rows``: the table with its ranges and places; ``counts``: (range, n, before) per range."""

    rows: DataFrame
    counts: DataFrame
    keys: tuple[str, ...]

    @classmethod
    def build(
        cls, table: DataFrame, keys: Sequence[str], path: str, range_rows: int = RANGE_ROWS
    ) -> PageIndex:
        """Write the index below ``path`` and open it. The keys together should tell rows apart."""
        wanted = range_count(table.count(), range_rows)
        placed = (
            table.repartitionByRange(wanted, *keys)
            .sortWithinPartitions(*keys)
            .withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)))
            .withColumn(RANGE, F.spark_partition_id())
        )
        placed.write.partitionBy(RANGE).parquet(f"{path}/rows")
        rows = table.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
        counts = _with_totals(rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")))
        counts.write.parquet(f"{path}/counts")
        return cls.open(table.sparkSession, path, keys, placed.schema)

    @classmethod
    def open(
        cls, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | None = None
    ) -> PageIndex:
        """An index written before. Only an empty one needs the schema of its rows."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        counts = spark.read.parquet(f"{path}/counts")
        return cls(reader.parquet(f"{path}/rows"), counts, tuple(keys))

    def size(self) -> int:
        return self.counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, limit: int = 50, offset: int = 0, condition: Column | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in key order, of those that meet the condition."""
        if not 1 <= limit <= MAX_PAGE:
            raise ValueError(f"limit must lie in 1..{MAX_PAGE}, not {limit}")
        if offset < 0:
            raise ValueError(f"offset must not be negative, not {offset}")
        rows, counts = self.rows, self.counts
        if condition is not None:
            rows = rows.filter(condition)
            counts = _with_totals(rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")))
        # Ranges have rows, so a page of at most MAX_PAGE rows lies in at most as many ranges.
        held = (
            counts.filter((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset))
            .orderBy("before")
            .collect()
        )
        if not held:
            found = rows.limit(0)
        elif condition is None:
            inside = F.lit(False)
            for r in held:
                first = max(offset - r["before"], 0)
                last = min(offset + limit - r["before"], r["n"]) - 1
                inside = inside | ((F.col(RANGE) == r[RANGE]) & F.col(PLACE).between(first, last))
            found = rows.filter(inside)
        else:
            ranges = rows.filter(F.col(RANGE).isin([r[RANGE] for r in held]))
            found = ranges.orderBy(RANGE, PLACE).offset(offset - held[0]["before"]).limit(limit)
        return found.orderBy(*self.keys).drop(RANGE, PLACE)


def _with_totals(counts: DataFrame) -> DataFrame:
    """Counts of ranges with the rows before each; there are at most ``MAX_RANGES`` of them."""
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
