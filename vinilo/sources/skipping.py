"""Tables laid out by key, so that lookups and equality filters skip most of them.

Rows stand in ranges of the key, a folder each, sorted within. A small table of the
ranges' lowest and highest keys tells which folders a key can be in, so that no other
file is opened. Within a file Parquet's statistics skip row groups by the key, and
Bloom filters those that lack a value of another column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vinilo.operators.pageindex import RANGE_ROWS, range_count
from vinilo.operators.shop import point_lookup

RANGE = "_range"
# Keys that travel in a condition; more of them are joined.
FEW_KEYS = 1000
# Spark hands lists of up to so many values to the Parquet reader as they are.
_PUSHED = 10


def one_of(column: Column, values: Sequence) -> Column:
    """Whether the column has one of the values, in a form that reaches the Parquet reader.

    A longer list would be handed on as its lowest and highest value only. The
    parts are paired off, so that the condition is not nested deeply.
    """
    parts = [
        column.isin(list(values[at : at + _PUSHED])) for at in range(0, len(values), _PUSHED)
    ] or [F.lit(False)]
    while len(parts) > 1:
        parts = [reduce(Column.__or__, parts[at : at + 2]) for at in range(0, len(parts), 2)]
    return parts[0]


def few_values(df: DataFrame, column: str, most: int = FEW_KEYS) -> list | None:
    """The distinct values of a column without NULL, or None where there are more than ``most``."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= most else None


def bloom_writer(df: DataFrame, columns: Iterable[str], rows_per_file: int) -> DataFrameWriter:
    """A Parquet writer that adds Bloom filters of the columns, for files of about so many rows."""
    writer = df.write
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", str(rows_per_file)
        )
    return writer


def in_key_order(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """The rows in so many ranges of the key, sorted within.

    Rows of one key are ordered by a hash of the row, so that a key with very many of
    them fills several ranges. Maps cannot be hashed and do not count.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    return df.repartitionByRange(ranges, F.col(key), F.xxhash64(*hashed)).sortWithinPartitions(key)


@dataclass(frozen=True)
class KeyedTable:
    """``rows``: the table with its ranges; ``ranges``: (_range, low, high, n) for each."""

    rows: DataFrame
    ranges: DataFrame
    key: str

    @classmethod
    def write(
        cls,
        table: DataFrame,
        key: str,
        path: str,
        filtered: Sequence[str] = (),
        range_rows: int = RANGE_ROWS,
    ) -> KeyedTable:
        """Lay the table out below ``path``, with Bloom filters of the key and of ``filtered``."""
        count = table.count()
        ranges = range_count(count, range_rows)
        placed = in_key_order(table, key, ranges).withColumn(RANGE, F.spark_partition_id())
        each = max(-(-count // ranges), 1)
        bloom_writer(placed, [key, *filtered], each).partitionBy(RANGE).parquet(f"{path}/rows")
        rows = table.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
        rows.groupBy(RANGE).agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")
        ).write.parquet(f"{path}/ranges")
        return cls.open(table.sparkSession, key, path, placed.schema)

    @classmethod
    def open(
        cls, spark: SparkSession, key: str, path: str, schema: StructType | None = None
    ) -> KeyedTable:
        """A table laid out before. Only an empty one needs the schema of its rows."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return cls(reader.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/ranges"), key)

    def table(self) -> DataFrame:
        return self.rows.drop(RANGE)

    def with_keys(self, keys: Sequence) -> DataFrame:
        """Rows with one of a few keys, read from the ranges that can hold them."""
        keys = sorted({k for k in keys if k is not None})
        if len(keys) > FEW_KEYS:
            raise ValueError(f"{len(keys)} keys are too many for a condition, join them")
        if not keys:
            return self.table().limit(0)
        # A key that stands in many rows can lie in many ranges; ``range_count`` bounds them.
        inside = F.exists(
            F.array(*[F.lit(k) for k in keys]), lambda k: k.between(F.col("low"), F.col("high"))
        )
        held = [r[RANGE] for r in self.ranges.filter(inside).select(RANGE).collect()]
        return self.rows.filter(F.col(RANGE).isin(held) & one_of(F.col(self.key), keys)).drop(RANGE)

    def lookup(self, requests: DataFrame) -> DataFrame:
        """The row for each requested key, with ``found`` telling if there is one.

        The keys should tell the rows apart. A few distinct keys are looked up in
        their ranges; more of them are joined with the whole table.
        """
        same_type = dict(requests.dtypes)[self.key] == dict(self.rows.dtypes)[self.key]
        keys = few_values(requests, self.key) if same_type else None
        return point_lookup(requests, self.table() if keys is None else self.with_keys(keys), self.key)

    def equal(self, **values) -> DataFrame:
        """Rows in which each named column has the value; None sets no condition."""
        rows = self.table()
        for column, value in values.items():
            if value is not None:
                rows = rows.filter(F.col(column) == F.lit(value))
        return rows
