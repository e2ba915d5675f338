"""Tables laid out by key: what lookups and filters return, and what they leave unread."""

import random

import pytest
from pyspark.sql import functions as F

from vinilo.sources.skipping import FEW_KEYS, KeyedTable, few_values, one_of

ROWS = 20_000
SCHEMA = "id long, mail string, kind int"


@pytest.fixture(scope="module")
def customers():
    ids = random.Random(3).sample(range(0, 200_000, 2), ROWS)
    return {i: (i, f"m{i * 7919 % 1_000_003}@x.org", i % 3) for i in ids}


@pytest.fixture(scope="module")
def keyed(spark, customers, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed"))
    table = spark.createDataFrame(list(customers.values()), SCHEMA)
    return KeyedTable.write(table, "id", path, ["mail"], range_rows=1000), path


def scan_metric(df, name):
    """Rows or files of the scans of a frame that has been collected."""
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName() and node.metrics().contains(name):
            total += node.metrics().apply(name).value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_a_few_keys_read_a_share_of_the_rows(keyed, customers):
    table, _ = keyed
    assert table.ranges.count() >= 15
    wanted = random.Random(4).sample(sorted(customers), 3)
    found = table.with_keys([*wanted, None])
    assert {tuple(r) for r in found.collect()} == {customers[k] for k in wanted}
    assert scan_metric(found, "numFiles") <= 3
    assert scan_metric(found, "numOutputRows") <= 3 * 1500
    whole = table.table()
    assert len(whole.collect()) == ROWS == scan_metric(whole, "numOutputRows")


def test_keys_that_no_row_has_read_nothing(keyed):
    """Odd numbers lie inside the ranges, so only the Bloom filters can tell."""
    table, _ = keyed
    missing = table.with_keys([50_001, 90_001, 150_001])
    assert missing.collect() == []
    assert scan_metric(missing, "numFiles") == 3
    assert scan_metric(missing, "numOutputRows") <= 1500
    outside = table.with_keys([-5, 10**9])
    assert outside.collect() == [] and scan_metric(outside, "numFiles") == 0


def test_many_keys_are_pushed_as_they_are(keyed, customers):
    """More keys than Spark hands on as a list still skip what lies between them."""
    table, _ = keyed
    ids = sorted(customers)
    wanted = ids[:20] + ids[-20:]
    found = table.with_keys(wanted)
    assert {r["id"] for r in found.collect()} == set(wanted)
    assert scan_metric(found, "numFiles") <= 4


def test_filters_by_other_columns_skip_row_groups(keyed, customers):
    table, _ = keyed
    mail = customers[sorted(customers)[777]][1]
    found = table.equal(mail=mail, kind=None)
    assert [r["mail"] for r in found.collect()] == [mail]
    assert scan_metric(found, "numOutputRows") < ROWS / 3
    assert table.equal(kind=1).count() == sum(c[2] == 1 for c in customers.values())


@pytest.mark.parametrize("many", [False, True])
def test_lookup_tells_what_was_found(spark, keyed, customers, many):
    table, _ = keyed
    wanted = sorted(customers)[: FEW_KEYS + 50 if many else 5]
    asked = [*wanted, wanted[0], 1, None]
    requests = spark.createDataFrame([(k,) for k in asked], "id long")
    rows = table.lookup(requests).collect()
    assert len(rows) == len(asked)
    assert sorted(r["id"] for r in rows if r["found"]) == sorted([*wanted, wanted[0]])
    assert all(r["mail"] == customers[r["id"]][1] for r in rows if r["found"])
    assert {r["id"] for r in rows if not r["found"]} == {1, None}


def test_requests_of_another_type_are_joined(spark, keyed, customers):
    requests = spark.createDataFrame([(min(customers),), (1,)], "id int")
    rows = {r["id"]: r["found"] for r in keyed[0].lookup(requests).collect()}
    assert rows == {min(customers): True, 1: False}


def test_open_again_empty_null_keys_and_repeats(spark, keyed, customers, tmp_path):
    again = KeyedTable.open(spark, "id", keyed[1])
    key = max(customers)
    assert [tuple(r) for r in again.with_keys([key]).collect()] == [customers[key]]
    rows = [(None, "a", 1), (5, "b", 1), *[(7, "c", i) for i in range(40)]]
    odd = KeyedTable.write(spark.createDataFrame(rows, SCHEMA), "id", str(tmp_path / "odd"), range_rows=10)
    assert odd.table().count() == 42
    assert odd.with_keys([7]).count() == 40 and odd.with_keys([None]).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    empty = KeyedTable.write(none, "id", str(tmp_path / "none"), ["mail"])
    assert empty.table().count() == 0 and empty.with_keys([1]).count() == 0
    assert empty.lookup(spark.createDataFrame([(1,)], "id long")).first()["found"] is False


def test_a_key_with_most_rows_fills_several_ranges(spark, tmp_path):
    rows = [(7 if i % 3 else i, f"m{i}", i) for i in range(3000)]
    hot = KeyedTable.write(spark.createDataFrame(rows, SCHEMA), "id", str(tmp_path), range_rows=300)
    assert max(r["n"] for r in hot.ranges.collect()) < 900
    found = hot.with_keys([7, 9]).collect()
    assert sorted(tuple(r) for r in found) == sorted(r for r in rows if r[0] in (7, 9))


def test_conditions_on_values(spark):
    numbers = spark.range(200).select("id")
    wanted = list(range(0, 200, 3))
    assert {r["id"] for r in numbers.filter(one_of(F.col("id"), wanted)).collect()} == set(wanted)
    assert numbers.filter(one_of(F.col("id"), [])).count() == 0
    assert few_values(numbers, "id", 199) is None
    assert few_values(numbers, "id", 200) == list(range(200))
    with pytest.raises(ValueError, match="too many"):
        KeyedTable(numbers, numbers, "id").with_keys(range(FEW_KEYS + 1))


def test_ranges_grow_with_the_table_before_there_are_many(spark, tmp_path):
    table = spark.range(0, 20_000, 2)
    keyed = KeyedTable.write(table, "id", str(tmp_path), range_rows=10)
    assert keyed.ranges.count() <= 128
    assert sorted(r["id"] for r in keyed.with_keys([0, 9998, 9999]).collect()) == [0, 9998]
