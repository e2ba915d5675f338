import pytest
from pyspark.sql import functions as F

from vinilo.operators import checkout
from vinilo.operators.audit import constraint_audit
from vinilo.operators.shop import catalog_search, filter_tracks, page, point_lookup
from vinilo.sources.schema import CHECKOUT_REQUEST, RAW_SCHEMAS

CART = "CheckoutId long, CustomerId long, BillingAddress string"
ITEM = "CheckoutId long, Seq long, TrackId long, Quantity int, UnitPrice decimal(10,2)"


@pytest.fixture
def track(spark):
    return spark.createDataFrame(
        [
            (1, "Ring of Fire", 5, 1, 0.99),
            (2, "String", 5, 2, 1.99),
            (3, "Blue", None, 1, 0.0),
            (4, "ring", 6, None, 2.99),
        ],
        "TrackId long, Name string, AlbumId int, GenreId int, UnitPrice double",
    )


@pytest.mark.parametrize(
    ("conditions", "expected"),
    [
        ({}, [1, 2, 3, 4]),
        ({"name": ""}, [1, 2, 3, 4]),
        ({"name": "RING"}, [1, 2, 4]),
        ({"name": "r_ng"}, [1, 2, 4]),
        ({"name": "b%e"}, [3]),
        ({"album_id": 5}, [1, 2]),
        ({"genre_id": 1, "name": "blue"}, [3]),
        ({"min_price": 0.99, "max_price": 1.99}, [1, 2]),
        ({"max_price": 0}, [3]),
        ({"album_id": 0}, []),
    ],
)
def test_filter_tracks(track, conditions, expected):
    assert sorted(r["TrackId"] for r in filter_tracks(track, **conditions).collect()) == expected


def test_search_pages(track):
    found = catalog_search(track, limit=2, offset=1, name="ring")
    assert [r["TrackId"] for r in found.collect()] == [2, 4]


@pytest.mark.parametrize(
    "wrong", [{"limit": 0}, {"limit": 101}, {"offset": -1}, {"min_price": -1}]
)
def test_search_bounds(track, wrong):
    with pytest.raises(ValueError):
        catalog_search(track, **wrong)


def test_page(track):
    assert [r["TrackId"] for r in page(track, "TrackId", 2, 3).collect()] == [4]
    assert [r["TrackId"] for r in page(track, "TrackId", 2, after=1).collect()] == [2, 3]


def test_point_lookup(spark, track, rows):
    requests = spark.createDataFrame([(1,), (1,), (77,)], "TrackId long")
    found = point_lookup(requests, track, "TrackId").collect()
    assert sorted((r["TrackId"], r["found"], r["Name"]) for r in found if r["found"]) == [
        (1, True, "Ring of Fire")
    ] * 2
    assert [(r["TrackId"], r["Name"]) for r in found if not r["found"]] == [(77, None)]


@pytest.fixture
def orders(spark):
    """One good cart and one for each way to go wrong."""
    carts = [
        (1, 10, None),
        (2, 99, None),  # unknown customer
        (3, 10, None),  # unknown tracks
        (4, 10, None),  # wrong price
        (5, 10, None),  # quantities
        (6, 10, None),  # no items
        (7, 10, "x" * 71),
        (8, 0, "x" * 70),
        (9, 99, None),  # unknown customer and track
        (10, 10, None),  # nothing given
    ]
    items = [
        (1, 0, 1, 2, "0.99"),
        (1, 1, 2, 1, "1.99"),
        (2, 0, 1, 1, "0.99"),
        (3, 0, 1, 1, "0.99"),
        (3, 1, 501, 1, "0.99"),
        (3, 2, 500, 1, "0.99"),
        (4, 0, 2, 100, "1.50"),
        (5, 0, 1, 0, "0.99"),
        (5, 1, 2, 101, "1.99"),
        (7, 0, 1, 1, "0.99"),
        (8, 0, -1, 1, "0.00"),
        (9, 0, 500, 1, "0.99"),
        (10, 0, None, None, None),
    ]
    return {
        "carts": spark.createDataFrame(carts, CART),
        "items": spark.createDataFrame(items, ITEM.replace("decimal(10,2)", "string")).withColumn(
            "UnitPrice", F.col("UnitPrice").cast("decimal(10,2)")
        ),
        "customer": spark.createDataFrame([(10,)], "CustomerId long"),
        "track": spark.createDataFrame([(1, "0.99"), (2, "1.99")], "TrackId long, p string").select(
            "TrackId", F.col("p").cast("decimal(10,2)").alias("UnitPrice")
        ),
    }


def test_validation(orders, rows):
    result = rows(checkout.validate_checkouts(orders["carts"], orders["items"]), "CheckoutId")
    assert {k: r["failed_rules"] for k, r in result.items() if r["failed_rules"]} == {
        5: ["quantity"],
        6: ["items"],
        7: ["BillingAddress"],
        8: ["customer_id", "track_id", "unit_price"],
        10: ["track_id", "quantity", "unit_price"],
    }
    assert len(result) == 10


def test_pricing(orders, rows):
    priced = checkout.price_checkouts(**orders)
    invoices = rows(priced.invoices, "InvoiceId")
    assert {k: (float(r["Total"]), r["RepricedItems"]) for k, r in invoices.items()} == {
        1: (3.97, 0),
        4: (199.0, 1),
    }
    lines = rows(priced.lines, "InvoiceId", "TrackId")
    assert {k: (float(r["UnitPrice"]), r["Repriced"]) for k, r in lines.items()} == {
        (1, 1): (0.99, False),
        (1, 2): (1.99, False),
        (4, 2): (1.99, True),
    }
    rejects = rows(priced.rejects, "CheckoutId")
    assert {k: (r["reason"], r["unknown_track"]) for k, r in rejects.items()} == {
        2: ("customer_not_found", None),
        3: ("track_not_found", 501),
        5: ("invalid_request", None),
        6: ("invalid_request", None),
        7: ("invalid_request", None),
        8: ("invalid_request", None),
        9: ("customer_not_found", None),
        10: ("invalid_request", None),
    }


def test_nested_requests(spark, orders):
    request = [(1, 10, None, None, None, [(1, 2, None), (2, 1, None)]), (2, 10, None, None, None, [])]
    carts, items = checkout.flatten_requests(spark.createDataFrame(request, CHECKOUT_REQUEST))
    assert carts.count() == 2
    assert [(r["CheckoutId"], r["Seq"], r["TrackId"]) for r in items.orderBy("Seq").collect()] == [
        (1, 0, 1),
        (1, 1, 2),
    ]


def test_merge_keeps_the_first_price(spark, rows):
    items = spark.createDataFrame(
        [(1, 0, 7, 1, 2.0), (1, 1, 8, 1, 1.0), (1, 2, 7, 3, 9.0), (2, 0, 7, 1, 5.0)],
        "CheckoutId long, Seq long, TrackId long, Quantity int, UnitPrice double",
    )
    merged = rows(checkout.merge_cart(items), "CheckoutId", "TrackId")
    assert (merged[1, 7]["Quantity"], merged[1, 7]["UnitPrice"], merged[1, 7]["Seq"]) == (4, 2.0, 0)
    assert merged[2, 7]["UnitPrice"] == 5.0


def test_cart_totals(spark, rows):
    items = spark.createDataFrame(
        [(1, "1.50", 2), (1, "free", 1), (1, None, 1), (2, "2usd", 3)],
        "CheckoutId long, UnitPrice string, Quantity int",
    )
    totals = rows(checkout.cart_totals(items), "CheckoutId")
    assert (totals[1]["total"], totals[1]["total_items"]) == (3.0, 4)
    assert totals[2]["total"] == 6.0


def test_invoice_documents(spark):
    invoice = spark.createDataFrame([(1, 10, 5.0), (2, 11, 0.0)], "InvoiceId long, CustomerId long, Total double")
    line = spark.range(100).select(
        (100 - F.col("id")).alias("InvoiceLineId"),
        F.lit(1).cast("long").alias("InvoiceId"),
        F.col("id").alias("TrackId"),
        F.lit(1.0).alias("UnitPrice"),
        F.lit(1).alias("Quantity"),
    )
    whole = checkout.invoice_documents(invoice, line).orderBy("InvoiceId").collect()
    assert [(r["InvoiceId"], r["Part"], len(r["Lines"])) for r in whole] == [(1, 0, 100), (2, 0, 0)]
    assert [x["InvoiceLineId"] for x in whole[0]["Lines"]] == list(range(1, 101))

    parts = checkout.invoice_documents(invoice, line, lines_per_document=30).filter("InvoiceId = 1")
    documents = parts.collect()
    assert {r["Part"]: len(r["Lines"]) for r in documents} == {0: 30, 1: 30, 2: 30, 3: 10}
    paged = [x["InvoiceLineId"] for r in sorted(documents, key=lambda r: r["Part"]) for x in r["Lines"]]
    assert paged == list(range(1, 101))


def test_pages_of_stepped_ids_in_many_spans(spark):
    invoice = spark.createDataFrame([(1, 10, 5.0)], "InvoiceId long, CustomerId long, Total double")
    line = spark.range(40).select(
        (F.col("id") * 4).alias("InvoiceLineId"),
        F.lit(1).cast("long").alias("InvoiceId"),
        F.col("id").alias("TrackId"),
        F.lit(1.0).alias("UnitPrice"),
        F.lit(1).alias("Quantity"),
    )
    pages = checkout.invoice_documents(invoice, line, lines_per_document=10, ids_per_span=12)
    found = {r["Part"]: [x["InvoiceLineId"] for x in r["Lines"]] for r in pages.collect()}
    assert found == {p: [4 * i for i in range(10 * p, 10 * p + 10)] for p in range(4)}


def test_first_price_does_not_depend_on_row_order(spark):
    rows = [(1, 7, 0, 5.0, 1), (1, 7, 0, 4.0, 1)]
    kinds = "CheckoutId long, TrackId long, Seq long, UnitPrice double, Quantity int"
    for given in (rows, rows[::-1]):
        assert checkout.merge_cart(spark.createDataFrame(given, kinds)).first()["UnitPrice"] == 4.0


def test_new_customers(spark, rows):
    existing = spark.createDataFrame([("old@x.y",)], "Email string")
    candidates = spark.createDataFrame(
        [
            (1, "A", "B", "old@x.y"),
            (2, "A", "B", "new@x.y"),
            (3, "A", "B", "new@x.y"),
            (4, "", "B", "a@x.y"),
            (5, "A", "B" * 21, "b@x.y"),
            (6, "A", "B", "nonsense"),
            (7, None, "B", None),
            (8, "", "B", "c@x.y"),
            (9, "A", "B", "c@x.y"),
        ],
        "CandidateId int, FirstName string, LastName string, Email string",
    )
    result = rows(checkout.screen_new_customers(candidates, existing), "CandidateId")
    assert {k: r["failed_rules"] for k, r in result.items()} == {
        1: ["email_exists"],
        2: [],
        3: ["email_exists"],
        4: ["FirstName"],
        5: ["LastName"],
        6: ["Email"],
        7: ["FirstName", "Email"],
        8: ["FirstName"],
        9: [],
    }


def test_audit(spark, rows):
    tables = {
        "Artist": spark.createDataFrame([(1, "A" * 121), (1, None), (2, "b")], "ArtistId int, Name string"),
        "Album": spark.createDataFrame([(1, "t", 1), (2, "t", 9), (3, "t", 9), (4, "t", None)], "AlbumId int, Title string, ArtistId int"),
        "Customer": spark.createDataFrame(
            [(1, "f", "l", "a@x"), (2, "f", "l", "a@x"), (3, "f", "l", "a@x"), (4, "f", "l", None)],
            "CustomerId int, FirstName string, LastName string, Email string",
        ),
    }
    found = rows(constraint_audit(tables), "table_name", "rule")
    broken = {k: r["violations"] for k, r in found.items() if r["violations"]}
    assert broken == {
        ("Artist", "Name length 120"): 1,
        ("Artist", "Name not null"): 1,
        ("Artist", "ArtistId unique"): 1,
        ("Album", "ArtistId references Artist"): 2,
        ("Album", "ArtistId not null"): 1,
        ("Customer", "Email unique"): 2,
        ("Customer", "Email not null"): 1,
    }
    assert ("Customer", "SupportRepId references Employee") not in found


def test_audit_of_whole_schemas(spark):
    tables = {name: spark.createDataFrame([], schema) for name, schema in RAW_SCHEMAS.items()}
    result = constraint_audit(tables).collect()
    assert sum(r["violations"] for r in result) == 0
    assert sum(" references " in r["rule"] for r in result) == 9
    assert sum(r["rule"].endswith(" unique") for r in result) == 10
