"""Pages by index, manifests of runs, and balanced reads from a database."""

import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from vinilo.operators.pageindex import PageIndex, range_count
from vinilo.plans import rollup_job, segmentation_job
from vinilo.sources import jdbc, lake, manifest
from vinilo.sources.catalog import register_lake
from vinilo.sources.layout import LakeLayout

OLD, NEW = "20240101_000000", "20240102_000000"


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    keys = random.Random(1).sample(range(100_000), 5000)
    table = spark.createDataFrame([(k, k % 10, f"n{k}") for k in keys], "id int, price int, name string")
    path = str(tmp_path_factory.mktemp("pages"))
    return PageIndex.build(table, ["id"], path, range_rows=300), sorted(keys), path


@pytest.mark.parametrize("offset, limit", [(0, 1), (0, 100), (290, 100), (2500, 7), (4950, 100), (4999, 1), (5000, 10), (10**9, 5)])
def test_pages_equal_slices(index, offset, limit):
    pages, keys, _ = index
    found = pages.page(limit, offset)
    assert [r["id"] for r in found.collect()] == keys[offset : offset + limit]
    assert found.columns == ["id", "price", "name"]


def test_a_page_reads_its_ranges_only(index):
    """However deep, a page reads the files of the ranges it lies in, and its own rows of them."""
    pages, _, _ = index
    assert pages.counts.count() > 10 and pages.size() == 5000
    found = pages.page(100, 2480)
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "_range" in scan.split("PartitionFilters")[1][:120]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset" not in plan and "Limit" not in plan
    rows = found.select(F.input_file_name().alias("f")).distinct().count()
    assert 1 <= rows <= 2


@pytest.mark.parametrize("offset, limit", [(0, 10), (250, 100), (490, 100), (500, 3)])
def test_pages_under_a_condition(index, offset, limit):
    pages, keys, _ = index
    match = [k for k in keys if k % 10 == 3]
    found = pages.page(limit, offset, F.col("price") == 3)
    assert [r["id"] for r in found.collect()] == match[offset : offset + limit]
    assert pages.page(5, 0, F.lit(False)).count() == 0


def test_an_index_can_be_opened_again(spark, index):
    _, keys, path = index
    again = PageIndex.open(spark, path, ["id"])
    assert [r["id"] for r in again.page(3, 1234).collect()] == keys[1234:1237]


def test_pages_by_two_keys_and_of_nothing(spark, tmp_path):
    table = spark.createDataFrame([(a, b) for a in range(3) for b in range(50)], "a int, b int")
    pages = PageIndex.build(table, ["a", "b"], str(tmp_path / "two"), range_rows=20)
    assert [tuple(r) for r in pages.page(4, 98).collect()] == [(1, 48), (1, 49), (2, 0), (2, 1)]
    empty = PageIndex.build(table.limit(0), ["a", "b"], str(tmp_path / "none"))
    assert empty.size() == 0 and empty.page(5).count() == 0
    for limit, offset in ((0, 0), (101, 0), (1, -1)):
        with pytest.raises(ValueError):
            pages.page(limit, offset)


# Manifests


@pytest.fixture
def layout(tmp_path):
    return LakeLayout(str(tmp_path))


@pytest.fixture
def tables(spark):
    return {
        "Invoice": spark.createDataFrame([(1, "2024-01-01", 10)], "InvoiceId int, InvoiceDate string, CustomerId int"),
        "InvoiceLine": spark.createDataFrame([(1, 5, 0.99, 2)], "InvoiceId int, TrackId int, UnitPrice double, Quantity int"),
    }


def test_a_manifest_tells_rows_and_bytes(spark, layout, tables):
    lake.full_copy(tables.__getitem__, layout, tables, OLD)
    (listed,) = manifest.finished(spark, layout.raw("Invoice")).items()
    assert listed[0] == OLD and listed[1]["rows"] == 1
    assert listed[1]["bytes"] == lake.folder_bytes(spark, f"{layout.raw('Invoice')}/snapshot={OLD}")
    assert manifest.finished(spark, layout.raw("Track")) == {}


def killed_copy(layout, tables, snapshot):
    def reader(table):
        if table == "InvoiceLine":
            raise ConnectionError("the database went away")
        return tables[table]

    with pytest.raises(ConnectionError):
        lake.full_copy(reader, layout, tables, snapshot)


def test_a_copy_killed_between_tables_stays_unseen(spark, layout, tables):
    lake.full_copy(tables.__getitem__, layout, tables, OLD)
    killed_copy(layout, tables, NEW)
    done = f"{layout.raw('Invoice')}/snapshot={NEW}"
    assert os.path.exists(f"{done}/_SUCCESS")  # this table was finished, the run was not
    assert lake.list_snapshots(spark, layout.raw("Invoice")) == [OLD]
    with pytest.raises(FileNotFoundError, match=NEW):
        lake.read_snapshot(spark, layout.raw("Invoice"), NEW)
    with pytest.raises(FileNotFoundError):
        lake.read_raw_tables(spark, layout, ["Invoice"], NEW)
    register_lake(spark, layout, "killed_copy", ["Invoice"])
    assert spark.table("killed_copy.dl_invoice").count() == 1
    assert {r["snapshot"] for r in spark.table("killed_copy.dl_invoice").collect()} == {OLD}
    path = rollup_job.run_rollup(spark, layout, "mes_ventas", NEW)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(FileNotFoundError):
        segmentation_job.load_tables(spark, "s3", layout, snapshot=NEW)


def test_a_first_copy_that_was_killed_gives_nothing(spark, layout, tables):
    killed_copy(layout, tables, OLD)
    with pytest.raises(FileNotFoundError):
        lake.read_raw_tables(spark, layout, ["Invoice"])


def test_a_snapshot_being_overwritten_is_not_listed(spark, layout, tables):
    path = layout.processed("x")
    lake.write_snapshot(tables["Invoice"], path, OLD)
    broken = tables["Invoice"].withColumn("Total", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        lake.write_snapshot(broken, path, OLD)
    assert lake.list_snapshots(spark, path) == []
    lake.write_snapshot(tables["Invoice"], path, OLD)
    assert lake.list_snapshots(spark, path) == [OLD]


# Reads from a database


@pytest.fixture
def database():
    """Ids with gaps, a crowded stretch, and one id in 500 rows; some rows without one."""
    connection = sqlite3.connect(":memory:")
    connection.execute("CREATE TABLE t (id INTEGER, name TEXT)")
    ids = [*range(0, 2000), *range(10**6, 10**9, 10**6), *[55_555] * 500, *[None] * 20]
    connection.executemany("INSERT INTO t VALUES (?, ?)", [(i, f"o'{i}") for i in ids])
    return connection


def ask(database):
    return lambda query: database.execute(query).fetchall()


def sizes(database, predicates):
    return [database.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]


def test_ranges_follow_the_keys(database):
    predicates = jdbc.range_predicates(ask(database), "t", "id", range_rows=100)
    counts = sizes(database, predicates)
    assert sum(counts) == 2000 + 999 + 500 + 20
    crowded = [n for n in counts if n > 200]
    assert len(crowded) == 1 and crowded[0] <= 700  # the id that cannot be cut
    assert len(predicates) > 25 and max(n for n in counts if n not in crowded) <= 200
    everything = database.execute("SELECT count(*) FROM t").fetchone()[0]
    joined = " OR ".join(f"({p})" for p in predicates)
    assert sizes(database, [joined]) == [everything]


def test_ranges_are_bounded_and_text_is_quoted(database):
    assert len(jdbc.range_predicates(ask(database), "t", "id", 1, max_ranges=7)) <= 8
    by_name = jdbc.range_predicates(ask(database), "t", "name", range_rows=500)
    assert "''" in by_name[0] and sum(sizes(database, by_name)) == 3519
    database.execute("DELETE FROM t")
    assert jdbc.range_predicates(ask(database), "t", "id") == ["1 = 1"]


def test_ranges_are_read_by_spark():
    from unittest.mock import MagicMock

    spark = MagicMock()
    answers = [[(250,)], [(100,), (200,)]]
    load = spark.read.format.return_value.options.return_value.load
    load.return_value.collect.side_effect = answers
    source = jdbc.JdbcSource("jdbc:mysql://host/db", "user", "secret")
    jdbc.read_balanced(spark, source, "Invoice", "InvoiceId", range_rows=100)
    call = spark.read.jdbc.call_args
    assert call.args == ("jdbc:mysql://host/db", "Invoice")
    assert call.kwargs["predicates"] == [
        "InvoiceId < 100 OR InvoiceId IS NULL",
        "InvoiceId >= 100 AND InvoiceId < 200",
        "InvoiceId >= 200",
    ]
    assert call.kwargs["properties"]["preferTimestampNTZ"] == "true"
    assert "url" not in call.kwargs["properties"]


def test_command_lines_take_the_size_of_a_read():
    copy = ["--root", "/l", "--job", "full_copy", "--jdbc-url", "u", "--db-user", "a", "--db-password", "b"]
    assert rollup_job.arguments([*copy, "--jdbc-rows", "5"]).jdbc_rows == 5
    assert rollup_job.arguments(copy).jdbc_rows == jdbc.RANGE_ROWS
    args = segmentation_job.arguments(["--s3-bucket", "b", "--jdbc-rows", "7"])
    assert args.jdbc_rows == 7


# Many ranges


def test_ranges_grow_with_the_table_before_there_are_many(spark, tmp_path):
    """A small range_rows does not make a folder of every few rows of a large table."""
    assert [range_count(n, 64) for n in (0, 64, 65, 64 * 128)] == [1, 1, 2, 128]
    assert range_count(7_200_000, 64) == range_count(54_000_000, 1000) == 128
    assert range_count(10**9, 64) == range_count(10**9, 10**6) == 1000
    table = spark.range(0, 20_000, 2).select("id", (F.col("id") % 7).alias("price"))
    pages = PageIndex.build(table, ["id"], str(tmp_path / "many"), range_rows=10)
    assert pages.counts.count() <= 128
    assert [r["id"] for r in pages.page(100, 4950).collect()] == list(range(9900, 10_100, 2))
    match = [i for i in range(0, 20_000, 2) if i % 7 == 3]
    found = pages.page(20, 700, F.col("price") == 3)
    assert [r["id"] for r in found.collect()] == match[700:720]
