"""Sales laid out by invoice, and daily sales merged from bitmaps."""

import pytest
from pyspark.sql import functions as F

from vinilo.functions.dates import is_weekend, year_month
from vinilo.operators.artists import artist_month_metrics, artist_month_metrics_flat
from vinilo.operators.daybase import DayBase
from vinilo.operators.sales import invoice_totals, per_day, rollup, sales_per_day
from vinilo.sources.buckets import BucketedSales, bucket_count

SNAPSHOT = "20240101_000000"


@pytest.fixture(scope="module")
def invoice(spark):
    rows = [(i, 100 + i % 7 if i % 5 else None, f"2024-0{1 + i % 3}-0{1 + i % 4}") for i in range(200)]
    rows += [(900, 1, "nope"), (901, 1, None)]
    return spark.createDataFrame(rows, "InvoiceId int, CustomerId int, InvoiceDate string")


@pytest.fixture(scope="module")
def line(spark):
    """Invoice 3 has a third of all lines; invoice 4 has none; 950 is unknown, as is NULL."""
    rows = [(i, t, 1.25, 1 + t % 3) for i in range(200) if i != 4 for t in range(i % 4 + 1)]
    rows += [(3, t, 0.5, 2) for t in range(250)] + [(950, 1, 9.0, 1), (None, 1, 9.0, 1), (900, 2, 9.0, 1)]
    return spark.createDataFrame(rows, "InvoiceId int, TrackId int, UnitPrice double, Quantity int")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tables(spark, invoice, line, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    made = BucketedSales(spark, root, "bucketed_test", SNAPSHOT, 3)
    made.write(invoice, line, rows_per_split=100)
    return made


def test_lines_are_summed_and_joined_without_a_shuffle(tables, invoice, line):
    totals = tables.totals()
    shown = plan(totals)
    cold = shown[: shown.index("BroadcastHashJoin")]
    assert "SortMergeJoin" in cold and "Exchange" not in cold
    assert shown.count("Bucketed: true") >= 2
    assert sorted_rows(per_day(totals)) == sorted_rows(sales_per_day(invoice, line))


def test_hot_invoices_are_kept_apart(tables):
    hot = tables.table("HotLine")
    assert {r["InvoiceId"] for r in hot.select("InvoiceId").distinct().collect()} == {3}
    cold = tables.table("InvoiceLine")
    assert cold.filter("InvoiceId = 3").isEmpty() and cold.filter("InvoiceId IS NULL").count() == 1
    assert len(cold.inputFiles()) <= 3


def test_another_session_can_name_the_tables(spark, tables, invoice, line):
    again = BucketedSales(spark, tables.root, "bucketed_again", SNAPSHOT, 3)
    again.register(invoice.schema, line.schema)
    again.register(invoice.schema, line.schema)
    assert plan(again.totals()).count("Bucketed: true") >= 2
    assert sorted_rows(again.totals()) == sorted_rows(invoice_totals(invoice, line))


def test_a_layout_is_not_overwritten(tables, invoice, line):
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        tables.write(invoice, line)


def test_empty_tables(spark, invoice, line, tmp_path):
    empty = BucketedSales(spark, str(tmp_path), "bucketed_empty", SNAPSHOT, 2)
    empty.write(invoice.limit(0), line.limit(0))
    assert empty.totals().count() == 0 and per_day(empty.totals()).count() == 0


def test_bucket_numbers(spark):
    assert bucket_count(spark, 1) == spark.sparkContext.defaultParallelism
    assert bucket_count(spark, 2**40) == 8192
    assert bucket_count(spark, 100 * 2**40) == 100_000


@pytest.mark.parametrize("text_ids", [False, True])
def test_days_merge_to_months(invoice, line, text_ids):
    totals = invoice_totals(invoice, line)
    if text_ids:
        totals = totals.withColumn("CustomerId", F.concat(F.lit("c"), F.col("CustomerId")))
    base = DayBase.of(totals)
    month = year_month(F.col("fecha"))
    merged = base.merged(year_month=month)
    assert sorted_rows(merged.drop("numero_dias")) == sorted_rows(rollup(totals, year_month=month))
    days = {r["year_month"]: r["numero_dias"] for r in merged.collect()}
    assert days == {"2024-01": 4, "2024-02": 4, "2024-03": 4}
    weekend = is_weekend(F.col("fecha"))
    both = base.merged(w=weekend).drop("numero_dias")
    assert sorted_rows(both) == sorted_rows(rollup(totals, w=weekend))


def test_ids_of_many_ranges(spark):
    """Negative ids, ids on the borders of ranges, and very large ones count once each."""
    ids = [-40_000, -1, 0, 1, 32_767, 32_768, 32_769, 2**40, 2**40, None]
    rows = [(i, c, d) for d in ("2024-01-01", "2024-01-02") for i, c in enumerate(ids)]
    totals = spark.createDataFrame(rows, "InvoiceId int, CustomerId long, day string").selectExpr(
        "InvoiceId", "CustomerId", "CAST(day AS DATE) AS fecha", "1L AS canciones", "1L AS cantidad", "1.0D AS monto"
    )
    (only,) = DayBase.of(totals).merged(all=F.lit(1)).collect()
    assert (only["clientes_unicos"], only["numero_facturas"]) == (8, 20)


def test_days_of_unknown_customers_only(invoice, line):
    nobody = invoice.withColumn("CustomerId", F.lit(None).cast("int"))
    merged = DayBase.of(invoice_totals(nobody, line)).merged(all=F.lit(1)).collect()
    assert [r["clientes_unicos"] for r in merged] == [0]


@pytest.fixture(scope="module")
def catalog(spark):
    """Albums 0 to 3; album 3 has no artist, and track 9 no album."""
    track = spark.createDataFrame([(t, t % 4 if t != 9 else None) for t in range(250)], "TrackId int, AlbumId int")
    album = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, None)], "AlbumId int, ArtistId int")
    artist = spark.createDataFrame([(1, "One"), (2, "Two")], "ArtistId int, Name string")
    return track, album, artist


def test_artist_counts_equal_count_distinct(invoice, line, catalog):
    track, album, artist = catalog
    metrics = artist_month_metrics(invoice, line, track, album, artist)
    sold = line.join(track, "TrackId", "left").join(album, "AlbumId", "left")
    dated = sold.join(invoice, "InvoiceId").withColumn("d", F.expr("try_cast(InvoiceDate AS DATE)"))
    direct = dated.filter("d IS NOT NULL").groupBy(F.trunc("d", "month").alias("mes"), "ArtistId").agg(
        F.count_distinct("InvoiceId").alias("numero_facturas"),
        F.count_distinct("CustomerId").alias("clientes_unicos"),
        F.count_distinct("AlbumId").alias("albums_vendidos"),
        F.count("TrackId").alias("total_canciones_vendidas"),
    )
    assert sorted_rows(metrics.select(*direct.columns)) == sorted_rows(direct)
    assert metrics.filter("ArtistId IS NULL").count() == 3


def test_flat_counts_equal_count_distinct(invoice, line):
    flat = line.join(invoice, "InvoiceId").withColumn("ArtistId", F.col("TrackId") % 5)
    metrics = artist_month_metrics_flat(flat)
    dated = flat.withColumn("d", F.expr("try_cast(InvoiceDate AS DATE)")).filter("d IS NOT NULL")
    direct = dated.groupBy(F.trunc("d", "month").alias("mes"), "ArtistId").agg(
        F.count_distinct("InvoiceId").alias("numero_facturas"),
        F.count_distinct("CustomerId").alias("clientes_unicos"),
    )
    assert sorted_rows(metrics.select(*direct.columns)) == sorted_rows(direct)
