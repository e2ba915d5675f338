import datetime
import os
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from vinilo.operators.history import customer_employee_history
from vinilo.operators.sales import sales_per_day
from vinilo.plans import rollup_job
from vinilo.plans.session import (
    INITIAL_PARTITIONS,
    checkpoint,
    scratch_folder,
    shared_folder,
    size_shuffles,
)
from vinilo.sources import jdbc, lake
from vinilo.sources.catalog import register_lake
from vinilo.sources.layout import COPIED_TABLES, HISTORY, LakeLayout, new_snapshot
from vinilo.sources.schema import PRIMARY_KEYS, RAW_SCHEMAS

OLD, NEW = "20240101_000000", "20240102_000000"


@pytest.fixture
def layout(tmp_path):
    return LakeLayout(str(tmp_path))


@pytest.fixture
def sales(spark):
    return {
        "Invoice": spark.createDataFrame(
            [(1, "2024-01-01", 10), (2, "2024-01-01", 11), (3, "2024-01-02", 10)],
            "InvoiceId int, InvoiceDate string, CustomerId int",
        ),
        "InvoiceLine": spark.createDataFrame(
            [(1, 100, 0.99, 1), (1, 101, 0.99, 2), (2, 102, 1.99, 1), (3, 103, 2.99, 3)],
            "InvoiceId int, TrackId int, UnitPrice double, Quantity int",
        ),
    }


def test_layout():
    lake_layout = LakeLayout.from_bucket("store")
    assert lake_layout.raw("Invoice") == "s3a://store/raw/Invoice"
    assert len(lake_layout.folders()) == 17
    assert new_snapshot(datetime.datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405"


def test_bucket_from_environment(monkeypatch):
    monkeypatch.setenv("S3_BUCKET", "mine")
    assert LakeLayout.from_bucket().root == "s3a://mine"
    monkeypatch.delenv("S3_BUCKET")
    with pytest.raises(ValueError):
        LakeLayout.from_bucket()


def test_two_snapshots_answer_like_one(spark, layout, sales, rows):
    for snapshot in (OLD, NEW):
        lake.full_copy(sales.__getitem__, layout, sales, snapshot)
    read = lake.read_raw_tables(spark, layout, sales)
    assert "snapshot" not in read["Invoice"].columns
    assert rows(sales_per_day(*read.values()), "fecha") == rows(
        sales_per_day(*sales.values()), "fecha"
    )


def test_latest_and_named_snapshot(spark, layout, sales):
    path = layout.raw("Invoice")
    lake.write_snapshot(sales["Invoice"], path, OLD)
    lake.write_snapshot(sales["Invoice"].limit(1), path, NEW)
    assert lake.list_snapshots(spark, path) == [OLD, NEW]
    assert lake.read_snapshot(spark, path).count() == 1
    assert lake.read_snapshot(spark, path, OLD).count() == 3


def test_overwriting_a_snapshot_leaves_the_others(spark, layout, sales):
    path = layout.processed("ventas_por_dia")
    lake.write_snapshot(sales["Invoice"], path, OLD)
    lake.write_snapshot(sales["Invoice"], path, NEW)
    lake.write_snapshot(sales["Invoice"].limit(1), path, NEW)
    assert lake.read_snapshot(spark, path, OLD).count() == 3
    assert lake.read_snapshot(spark, path, NEW).count() == 1


def test_tables_come_from_one_snapshot(spark, layout, sales):
    """A copy that stopped half way left only some tables of the newer snapshot."""
    lake.full_copy(sales.__getitem__, layout, sales, OLD)
    lake.write_snapshot(sales["Invoice"].limit(1), layout.raw("Invoice"), NEW)
    assert lake.read_raw_tables(spark, layout, sales)["Invoice"].count() == 3
    assert lake.read_raw_tables(spark, layout, ["Invoice"])["Invoice"].count() == 1


def test_unfinished_snapshots_are_not_read(spark, layout, sales):
    path = layout.raw("Invoice")
    lake.write_snapshot(sales["Invoice"], path, OLD)
    os.makedirs(f"{path}/snapshot={NEW}/_temporary/0")
    assert lake.list_snapshots(spark, path) == [OLD]


def test_failed_writes_are_not_read(spark, layout, sales):
    path = layout.raw("Invoice")
    lake.write_snapshot(sales["Invoice"], path, OLD)
    broken = sales["Invoice"].withColumn("Total", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        lake.write_snapshot(broken, path, NEW)
    assert lake.list_snapshots(spark, path) == [OLD]
    assert lake.read_snapshot(spark, path).count() == sales["Invoice"].count()


def test_missing_snapshots(spark, layout, sales):
    with pytest.raises(FileNotFoundError):
        lake.read_snapshot(spark, layout.raw("Invoice"))
    with pytest.raises(ValueError):
        lake.write_snapshot(sales["Invoice"], layout.raw("Invoice"), "yesterday")


def test_a_copy_does_not_overwrite(layout, sales):
    lake.full_copy(sales.__getitem__, layout, sales, OLD)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        lake.full_copy(sales.__getitem__, layout, sales, OLD)


def test_customer_history(spark, rows):
    customer = spark.createDataFrame(
        [(1, "a", "A", "a@x.y", None, "US", 3), (2, "b", "B", "b@x.y", "Co", "CA", None), (3, "c", "C", "c@x.y", None, "US", 9)],
        "CustomerId int, FirstName string, LastName string, Email string, Company string, "
        "Country string, SupportRepId int",
    )
    employee = spark.createDataFrame(
        [(1, "Boss", "One", "GM", None), (2, "Mid", "Two", "SM", 1), (3, "Rep", "Three", "SR", 2)],
        "EmployeeId int, FirstName string, LastName string, Title string, ReportsTo int",
    )
    history = customer_employee_history(customer, employee)
    assert len(history.columns) == 14
    found = rows(history, "CustomerId")
    assert (found[1]["EmployeeFirstName"], found[1]["ManagerFirstName"]) == ("Rep", "Mid")
    assert found[2]["EmployeeFirstName"] is None
    assert (found[3]["SupportRepId"], found[3]["EmployeeTitle"]) == (9, None)


def test_full_copy_job(spark, layout):
    def reader(table):
        if table in RAW_SCHEMAS:
            return spark.createDataFrame([], RAW_SCHEMAS[table])
        return spark.createDataFrame([(1,)], f"{PRIMARY_KEYS[table]} int")

    folders = rollup_job.run_full_copy(spark, reader, layout, OLD)
    assert set(folders) == {*COPIED_TABLES, HISTORY}
    assert len(lake.read_snapshot(spark, layout.raw(HISTORY)).columns) == 14


@pytest.mark.parametrize("dataset", ["ventas_por_dia", "dia_semana", "mes_ventas"])
def test_rollup_jobs(spark, layout, sales, dataset):
    lake.full_copy(sales.__getitem__, layout, sales, OLD)
    path = rollup_job.run_rollup(spark, layout, dataset, NEW)
    assert path.endswith(f"processed/{dataset}/snapshot={NEW}")
    result = lake.read_snapshot(spark, layout.processed(dataset))
    assert sum(r["cantidad_total"] for r in result.collect()) == 7


def test_artist_job(spark, layout, sales):
    lines = sales["InvoiceLine"]
    tables = sales | {
        "Track": lines.selectExpr("TrackId", "'t' AS Name", "1 AS AlbumId", "9.9D AS UnitPrice"),
        "Album": spark.createDataFrame([(1, "a", 5)], "AlbumId int, Title string, ArtistId int"),
        "Artist": spark.createDataFrame([(5, "Band")], "ArtistId int, Name string"),
    }
    lake.full_copy(tables.__getitem__, layout, tables, OLD)
    rollup_job.run_rollup(spark, layout, "artista_mes", NEW)
    (only,) = lake.read_snapshot(spark, layout.processed("artista_mes")).collect()
    assert (only["nombre_artista"], only["cantidad_total"]) == ("Band", 7)
    assert only["porcentaje_canciones"] == 100.0


def test_rollup_main(spark, layout, sales, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    lake.full_copy(sales.__getitem__, layout, sales, OLD)
    rollup_job.main(["--root", layout.root, "--job", "mes_ventas"])
    assert lake.read_snapshot(spark, layout.processed("mes_ventas")).count() == 1


def test_rollup_command_line():
    args = rollup_job.arguments(["--root", "/lake", "--job", "artista_mes"])
    assert (args.root, args.job, args.snapshot) == ("/lake", "artista_mes", None)
    with pytest.raises(SystemExit):
        rollup_job.arguments(["--root", "/lake", "--job", "full_copy"])


def test_catalog(spark, layout, sales):
    for snapshot in (OLD, NEW):
        lake.full_copy(sales.__getitem__, layout, sales, snapshot)
    database = "catalog_test"
    first = register_lake(spark, layout, database)
    assert first["database_created"]
    assert first["errors"] == []
    assert first["tables"]["dl_invoice"] == "created"
    assert first["tables"]["dl_track"] == "absent"
    assert spark.table(f"{database}.dl_invoice").count() == 6
    latest = spark.table(f"{database}.dl_invoice").filter(f"snapshot = '{NEW}'")
    assert latest.count() == 3

    again = register_lake(spark, layout, database)
    assert not again["database_created"]
    assert again["tables"]["dl_invoice"] == "unchanged"


def test_catalog_follows_changes(spark, layout, sales, tmp_path):
    path = layout.raw("Invoice")
    lake.write_snapshot(sales["Invoice"], path, OLD)
    database = "catalog_changes"
    register_lake(spark, layout, database, ["Invoice"])
    lake.write_snapshot(sales["Invoice"].selectExpr("*", "1.5 AS Total"), path, NEW)
    changed = register_lake(spark, layout, database, ["Invoice"])
    assert changed["tables"] == {"dl_invoice": "updated"}
    table = spark.table(f"{database}.dl_invoice")
    assert "Total" in table.columns
    assert table.count() == 6
    assert table.filter("Total IS NULL").count() == 3

    moved = LakeLayout(str(tmp_path / "elsewhere"))
    gone = register_lake(spark, moved, database, ["Invoice"])
    assert gone["tables"] == {"dl_invoice": "deprecated"}
    properties = spark.sql(f"SHOW TBLPROPERTIES {database}.dl_invoice").collect()
    assert ("deprecated", "true") in [tuple(p) for p in properties]


def test_catalog_dry_run(spark, layout):
    result = register_lake(spark, layout, "never_made", dry_run=True)
    assert result["dry_run"] and result["database_created"]
    assert len(result["tables"]) == 16
    assert not spark.catalog.databaseExists("never_made")


def test_jdbc_reads_in_key_ranges():
    spark = MagicMock()
    source = jdbc.JdbcSource("jdbc:mysql://host/db", "user", "secret")
    reader = spark.read.format.return_value.options.return_value
    reader.load.return_value.first.return_value = (1, 500)
    jdbc.read_table(spark, source, "Invoice", "InvoiceId", num_partitions=8)
    spark.read.format.assert_called_with("jdbc")
    options = spark.read.format.return_value.options.call_args_list
    assert options[0].kwargs["dbtable"] == "Invoice"
    assert options[0].kwargs["driver"] == "com.mysql.cj.jdbc.Driver"
    assert options[1].kwargs["query"].startswith("SELECT MIN(InvoiceId)")
    assert reader.options.call_args.kwargs == {
        "partitionColumn": "InvoiceId",
        "lowerBound": "1",
        "upperBound": "501",
        "numPartitions": "8",
    }
    assert "secret" not in repr(source)


def test_jdbc_empty_table_is_read_whole():
    spark = MagicMock()
    reader = spark.read.format.return_value.options.return_value
    reader.load.return_value.first.return_value = (None, None)
    jdbc.read_table(spark, jdbc.JdbcSource("u", "a", "b"), "Invoice", "InvoiceId")
    reader.options.assert_not_called()


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    frame = checkpoint(spark.range(5))
    assert frame.count() == 5
    assert spark.sparkContext.getCheckpointDir().startswith(
        ("file:" + shared_folder(spark), shared_folder(spark))
    )


def test_cluster_needs_a_shared_folder():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_shuffles_grow_with_the_input(spark, layout, sales):
    path = lake.write_snapshot(sales["Invoice"], layout.raw("Invoice"), OLD)
    size = sum(
        os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")
    )
    assert size <= lake.raw_bytes(spark, layout, ["Invoice"], OLD) < 2 * size + 10_000
    try:
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 10 * 2**40) == 81920
        assert spark.conf.get(INITIAL_PARTITIONS) == "81920"
        assert size_shuffles(spark, 100 * 2**40) == 200_000
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)
