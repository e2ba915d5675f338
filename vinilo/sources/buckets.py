"""Invoices and their lines laid out together, so that sales need no shuffle of lines.

Both tables are cut into the same number of buckets by ``InvoiceId``, a file each,
sorted by it. Spark then sums the lines per invoice and joins the invoices bucket
by bucket. A bucket is read by one task, so invoices with very many lines are kept
apart: their lines are summed in an ordinary way, and only those sums, of at most
``MAX_HOT_KEYS`` invoices, meet the invoices by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinilo.operators.joins import ROWS_PER_SPLIT, hot_keys
from vinilo.operators.sales import line_sums, valid_dates
from vinilo.sources.layout import check_snapshot

KEY = "InvoiceId"
BUCKET_BYTES = 128 * 1024 * 1024
MAX_BUCKETS = 100_000


def bucket_count(spark: SparkSession, input_bytes: int) -> int:
    """A bucket per 128 MB of the larger table, at least one per core, at most what Spark allows."""
    wanted = -(-input_bytes // BUCKET_BYTES)
    return min(max(wanted, spark.sparkContext.defaultParallelism), MAX_BUCKETS)


@dataclass(frozen=True)
class BucketedSales:
    """Tables of one snapshot in a database of the session's catalog."""

    spark: SparkSession
    root: str
    database: str
    snapshot: str
    buckets: int

    def _name(self, table: str) -> str:
        return f"{self.database}.bk_{table.lower()}_{self.snapshot}"

    def _path(self, table: str) -> str:
        folder = f"{self.root.rstrip('/')}/bucketed/{table}"
        return f"{folder}/{check_snapshot(self.snapshot)}_{self.buckets}"

    def _write(self, df: DataFrame, table: str) -> None:
        """One file per bucket: rows are dealt by the hash that names the buckets."""
        (
            df.repartition(self.buckets, KEY)
            .write.bucketBy(self.buckets, KEY)
            .sortBy(KEY)
            .option("path", self._path(table))
            .saveAsTable(self._name(table))
        )

    def write(self, invoice: DataFrame, line: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> None:
        """Lay out both tables; a snapshot that is there already is an error."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        hot = F.broadcast(hot_keys(line, KEY, rows_per_split).select(KEY))
        self._write(invoice, "Invoice")
        self._write(line.join(hot, KEY, "left_anti"), "InvoiceLine")
        many = line.join(hot, KEY, "left_semi")
        many.write.option("path", self._path("HotLine")).saveAsTable(self._name("HotLine"))

    def register(self, invoice_schema, line_schema) -> None:
        """Name tables that an earlier session has written; buckets are told by their files' names."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        clustered = f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS"
        for table, fields, layout in (
            ("Invoice", invoice_schema, clustered),
            ("InvoiceLine", line_schema, clustered),
            ("HotLine", line_schema, ""),
        ):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({columns}) USING parquet "
                f"{layout} LOCATION '{self._path(table)}'"
            )

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def totals(self) -> DataFrame:
        """What ``sales.invoice_totals`` gives, with no shuffle but that of hot lines' sums."""
        dated = valid_dates(self.table("Invoice")).select(KEY, "CustomerId", "fecha")
        cold = line_sums(self.table("InvoiceLine")).hint("merge").join(dated, KEY)
        hot = dated.join(F.broadcast(line_sums(self.table("HotLine"))), KEY)
        return cold.unionByName(hot)
