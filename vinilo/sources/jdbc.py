"""Tables of the transactional database over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

RANGE_ROWS = 1_000_000
MAX_RANGES = 10_000
MYSQL_DRIVER = "com.mysql.cj.jdbc.Driver"


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = MYSQL_DRIVER
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",  # the database's times have no zone
        }


def read_query(spark: SparkSession, source: JdbcSource, query: str) -> DataFrame:
    """Result of a query that the database itself runs."""
    return spark.read.format("jdbc").options(**source.options(), query=query).load()


def read_table(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    key: str | None = None,
    num_partitions: int = 64,
) -> DataFrame:
    """A whole table; with an integer ``key`` it is read in parallel key ranges."""
    reader = spark.read.format("jdbc").options(**source.options(), dbtable=table)
    if key is not None:
        low, high = read_query(
            spark, source, f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"
        ).first()
        if low is not None:
            reader = reader.options(
                partitionColumn=key,
                lowerBound=str(low),
                upperBound=str(high + 1),
                numPartitions=str(num_partitions),
            )
    return reader.load()


def range_predicates(
    ask: Callable[[str], Sequence[Sequence]],
    table: str,
    key: str,
    range_rows: int = RANGE_ROWS,
    max_ranges: int = MAX_RANGES,
) -> list[str]:
    """Conditions that cut the table into ranges of the key with about as many rows each.

    ``ask`` runs a query in the database. The cuts are quantiles of the key itself,
    which the database takes from its index, so gaps and crowded stretches do not
    matter; only a single key with many rows cannot be cut. Rows without a key come
    with the first range. No more than ``max_ranges`` ranges come about.
    """
    ((rows,),) = ask(f"SELECT COUNT({key}) AS n FROM {table}")
    step = max(range_rows, -(-int(rows) // max_ranges), 1)
    cuts = ask(
        f"SELECT DISTINCT k FROM (SELECT {key} AS k, ROW_NUMBER() OVER (ORDER BY {key}) AS place "
        f"FROM {table} WHERE {key} IS NOT NULL) ranked WHERE place > 1 AND MOD(place - 1, {step}) = 0"
    )
    bounds = [_literal(k) for k in sorted(cut[0] for cut in cuts)]
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *inner, f"{key} >= {bounds[-1]}"]


def _literal(value) -> str:
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def read_balanced(
    spark: SparkSession, source: JdbcSource, table: str, key: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """A whole table, read in parallel ranges of about ``range_rows`` rows each."""

    def ask(query: str) -> list:
        return read_query(spark, source, query).collect()

    options = {k: v for k, v in source.options().items() if k != "url"}
    predicates = range_predicates(ask, table, key, range_rows)
    return spark.read.jdbc(source.url, table, predicates=predicates, properties=options)
