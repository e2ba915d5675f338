"""Common types of snapshots, dropped dates, months with gaps, and rows without a key."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinilo.operators.joins import skew_join
from vinilo.operators.sales import sales_by_month, watched_dates
from vinilo.plans import reports, rollup_job
from vinilo.sources import lake
from vinilo.sources.catalog import common_type, register_lake
from vinilo.sources.layout import LakeLayout

OLD, NEW = "20240101_000000", "20240102_000000"
INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()


@pytest.mark.parametrize(
    "a, b, both",
    [
        (INT, INT, INT),
        (T.ShortType(), LONG, LONG),
        (INT, T.DecimalType(10, 2), T.DecimalType(12, 2)),
        (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
        (T.DecimalType(38, 2), T.DecimalType(38, 3), None),
        (T.FloatType(), DOUBLE, DOUBLE),
        (INT, DOUBLE, DOUBLE),
        (LONG, DOUBLE, None),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.StringType(), INT, None),
        (T.DecimalType(10, 2), DOUBLE, None),
    ],
)
def test_common_types(a, b, both):
    assert common_type(a, b) == both
    assert common_type(b, a) == both


def test_snapshots_of_several_types_read_through_one_table(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    path = layout.raw("Invoice")
    older = spark.createDataFrame(
        [(1, 7, datetime.date(2024, 1, 1), Decimal("1.5"))],
        "InvoiceId int, CustomerId short, InvoiceDate date, Total decimal(8,1)",
    )
    newer = spark.createDataFrame(
        [(2**40, 2**33, datetime.datetime(2024, 1, 2, 3), Decimal("2.255"))],
        "InvoiceId long, CustomerId long, InvoiceDate timestamp_ntz, Total decimal(10,3)",
    )
    lake.write_snapshot(older, path, OLD)
    assert register_lake(spark, layout, "widened", ["Invoice"])["tables"] == {"dl_invoice": "created"}
    lake.write_snapshot(newer, path, NEW)
    changed = register_lake(spark, layout, "widened", ["Invoice"])
    assert changed["tables"] == {"dl_invoice": "updated"} and changed["errors"] == []
    table = spark.table("widened.dl_invoice")
    assert [tuple(r)[:4] for r in table.orderBy("InvoiceId").collect()] == [
        (1, 7, datetime.datetime(2024, 1, 1), Decimal("1.500")),
        (2**40, 2**33, datetime.datetime(2024, 1, 2, 3), Decimal("2.255")),
    ]
    # Registered anew, both are looked at; narrower columns in a later snapshot change nothing.
    assert register_lake(spark, layout, "widened_again", ["Invoice"])["errors"] == []
    assert spark.table("widened_again.dl_invoice").dtypes[:4] == table.dtypes[:4]
    lake.write_snapshot(older, path, "20240103_000000")
    assert register_lake(spark, layout, "widened", ["Invoice"])["tables"] == {"dl_invoice": "unchanged"}


def test_conflicts_are_reported(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    lake.write_snapshot(spark.createDataFrame([("x",)], "AlbumId string"), layout.raw("Album"), OLD)
    lake.write_snapshot(spark.createDataFrame([(1,)], "AlbumId int"), layout.raw("Album"), NEW)
    lake.write_snapshot(spark.createDataFrame([(1,)], "ArtistId int"), layout.raw("Artist"), NEW)
    result = register_lake(spark, layout, "conflicts", ["Album", "Artist"])
    assert result["tables"] == {"dl_artist": "created"}
    (error,) = result["errors"]
    assert "AlbumId" in error and "string" in error and "int" in error


@pytest.fixture
def sales(spark):
    """Sales in January, February, May and June; two invoices without a readable date."""
    dates = ["2024-01-05", "2024-02-05", "2024-05-05", "2024-06-05", "soon", None]
    invoice = spark.createDataFrame(
        [(i, d, 1, float(10 * (i + 1))) for i, d in enumerate(dates)],
        "InvoiceId int, InvoiceDate string, CustomerId int, Total double",
    )
    line = spark.createDataFrame(
        [(i, 1, float(10 * (i + 1)), 1) for i in range(6)],
        "InvoiceId int, TrackId int, UnitPrice double, Quantity int",
    )
    return invoice, line


def test_trend_follows_the_calendar(sales, rows):
    trend = rows(reports.month_trend(*sales), "year_month")
    assert trend["2024-02"]["monto_anterior"] == 10 and trend["2024-02"]["cambio_porcentual"] == 100
    assert trend["2024-05"]["monto_anterior"] is None and trend["2024-05"]["media_movil_3"] == 30
    assert trend["2024-06"]["monto_anterior"] == 30 and trend["2024-06"]["media_movil_3"] == 35


def test_trend_goes_on_over_the_new_year(spark, rows):
    invoice = spark.createDataFrame(
        [(1, "2023-12-31", 1), (2, "2024-01-01", 1)], "InvoiceId int, InvoiceDate string, CustomerId int"
    )
    line = spark.createDataFrame(
        [(1, 1, 2.0, 1), (2, 1, 3.0, 1)], "InvoiceId int, TrackId int, UnitPrice double, Quantity int"
    )
    assert rows(reports.month_trend(invoice, line), "year_month")["2024-01"]["monto_anterior"] == 2


def test_dropped_dates_are_told(sales):
    watched, dropped = watched_dates(sales[0])
    assert sales_by_month(watched, sales[1]).count() == 4
    assert dropped.get == {"invoices": 6, "without_date": 1, "unreadable": 1, "dropped_amount": 110.0}


@pytest.mark.parametrize("dataset", ["ventas_por_dia", "dia_semana"])
def test_jobs_report_dropped_dates(spark, sales, tmp_path, dataset, capsys):
    layout, told = LakeLayout(str(tmp_path)), []
    tables = dict(zip(("Invoice", "InvoiceLine"), sales))
    lake.full_copy(tables.__getitem__, layout, tables, OLD)
    rollup_job.run_rollup(spark, layout, dataset, NEW, report=told.append)
    assert told == [{"invoices": 6, "without_date": 1, "unreadable": 1, "dropped_amount": 110.0}]
    rollup_job.print_dropped(told[0])
    assert "1 unreadable, amount 110.00" in capsys.readouterr().out


def test_rows_without_a_key_spread_from_one_map_task(spark):
    """All of them come from one task, and still reach all partitions of the join."""
    keyless = spark.range(0, 5000, 1, 1).select(F.when(F.col("id") < 0, F.col("id")).alias("k"), "id")
    partners = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v")).repartition(3)
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = skew_join(keyless, partners, "k", "left", rows_per_split=200)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 5000 and len(sizes) == 8 and max(sizes) < 1000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
