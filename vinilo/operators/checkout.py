"""Order intake: carts are validated, priced and turned into invoices.

``carts`` has one row per cart (CheckoutId, CustomerId, Billing…); ``items``
one row per item (CheckoutId, Seq, TrackId, Quantity, UnitPrice), with ``Seq``
numbering the items of a cart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinilo.functions.text import parse_price
from vinilo.operators.joins import lookup_join, skew_join

# Fixed limits of a checkout request.
MAX_QUANTITY = 100
BILLING_LENGTHS = {"BillingAddress": 70, "BillingCity": 40, "BillingCountry": 40}

INVALID_REQUEST = "invalid_request"
CUSTOMER_NOT_FOUND = "customer_not_found"
TRACK_NOT_FOUND = "track_not_found"


@dataclass(frozen=True)
class PricedCheckouts:
    invoices: DataFrame
    lines: DataFrame
    rejects: DataFrame


def flatten_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested requests (schema ``CHECKOUT_REQUEST``) as (carts, items)."""
    items = requests.select(
        "CheckoutId", F.posexplode("Items").alias("Seq", "item")
    ).select("CheckoutId", "Seq", "item.TrackId", "item.Quantity", "item.UnitPrice")
    return requests.drop("Items"), items


def _fails(condition: Column) -> Column:
    """True where the condition does not hold, also for NULL."""
    return ~F.coalesce(condition, F.lit(False))


def _item_rules() -> dict[str, Column]:
    return {
        "track_id": _fails(F.col("TrackId") > 0),
        "quantity": _fails(F.col("Quantity").between(1, MAX_QUANTITY)),
        "unit_price": _fails(F.col("UnitPrice") > 0),
    }


def _cart_rules(columns: list[str]) -> dict[str, Column]:
    rules = {
        "customer_id": _fails(F.col("CustomerId") > 0),
        "items": F.col("_items").isNull(),
    }
    for column, longest in BILLING_LENGTHS.items():
        if column in columns:
            rules[column] = F.coalesce(F.length(column) > longest, F.lit(False))
    return rules


def _failed_rules(carts: DataFrame, per_cart: DataFrame) -> DataFrame:
    """Carts with their item summary and the names of the rules they break."""
    joined = carts.join(per_cart, "CheckoutId", "left")
    rules = _cart_rules(carts.columns) | {
        name: F.coalesce(F.col(f"_bad_{name}"), F.lit(False)) for name in _item_rules()
    }
    names = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return joined.withColumn("failed_rules", F.array_compact(names))


def _item_summary() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_items"),
        *[F.max(bad).alias(f"_bad_{name}") for name, bad in _item_rules().items()],
    ]


def validate_checkouts(carts: DataFrame, items: DataFrame) -> DataFrame:
    """(CheckoutId, failed_rules): the rules each cart breaks, empty for a good one."""
    per_cart = items.groupBy("CheckoutId").agg(*_item_summary())
    return _failed_rules(carts, per_cart).select("CheckoutId", "failed_rules")


def price_checkouts(
    carts: DataFrame, items: DataFrame, customer: DataFrame, track: DataFrame
) -> PricedCheckouts:
    """Invoices and lines of the good carts, and a reason for each of the others.

    The first of these that holds rejects a whole cart: a broken rule, an
    unknown customer, an unknown track (the first one is named). Lines carry
    the catalog price; ``Repriced`` marks those where the request had another.
    """
    catalog = track.select("TrackId", F.col("UnitPrice").alias("_catalog_price"))
    priced = lookup_join(items, catalog, "TrackId")
    unknown = F.col("_catalog_price").isNull()
    repriced = F.coalesce(F.col("UnitPrice") != F.col("_catalog_price"), F.lit(False))
    per_cart = priced.groupBy("CheckoutId").agg(
        *_item_summary(),
        F.max(unknown).alias("_unknown"),
        F.min_by(F.when(unknown, F.col("TrackId")), F.when(unknown, F.col("Seq"))).alias(
            "_unknown_track"
        ),
        F.count_if(repriced).alias("RepricedItems"),
        F.sum(F.col("_catalog_price") * F.col("Quantity")).alias("Total"),
    )
    known = customer.select("CustomerId", F.lit(True).alias("_customer_known"))
    checked = _failed_rules(carts, per_cart)
    judged = lookup_join(checked, known, "CustomerId", count_in=carts).withColumn(
        "reason",
        F.when(F.size("failed_rules") > 0, F.lit(INVALID_REQUEST))
        .when(F.col("_customer_known").isNull(), F.lit(CUSTOMER_NOT_FOUND))
        .when(F.col("_unknown"), F.lit(TRACK_NOT_FOUND)),
    )
    accepted = judged.filter(F.col("reason").isNull())
    billing = [c for c in BILLING_LENGTHS if c in carts.columns]
    invoices = accepted.select(
        F.col("CheckoutId").alias("InvoiceId"),
        "CustomerId",
        *billing,
        "Total",
        "RepricedItems",
    )
    lines = skew_join(
        priced.withColumn("Repriced", repriced),
        accepted.select("CheckoutId"),
        "CheckoutId",
        "left_semi",
        count_in=items,
    ).select(
        F.col("CheckoutId").alias("InvoiceId"),
        "Seq",
        "TrackId",
        F.col("_catalog_price").alias("UnitPrice"),
        "Quantity",
        "Repriced",
    )
    track_not_found = F.col("reason") == TRACK_NOT_FOUND
    rejects = judged.filter(F.col("reason").isNotNull()).select(
        "CheckoutId",
        "reason",
        F.array_join("failed_rules", ",").alias("failed_rules"),
        F.when(track_not_found, F.col("_unknown_track")).alias("unknown_track"),
    )
    return PricedCheckouts(invoices, lines, rejects)


def merge_cart(items: DataFrame) -> DataFrame:
    """Repeated adds of a track as one item: quantities summed, first price kept.

    Of prices added at the same place in the order, the lowest is the first.
    """
    return items.groupBy("CheckoutId", "TrackId").agg(
        F.min("Seq").alias("Seq"),
        F.sum("Quantity").alias("Quantity"),
        F.min_by("UnitPrice", F.struct("Seq", "UnitPrice")).alias("UnitPrice"),
    )


def cart_totals(items: DataFrame) -> DataFrame:
    """Amount and number of units per cart; unreadable prices count as 0."""
    kind = dict(items.dtypes)["UnitPrice"]
    exact = kind.startswith("decimal") or kind.endswith("int")
    price = F.col("UnitPrice") if exact else parse_price(F.col("UnitPrice"))
    return items.groupBy("CheckoutId").agg(
        F.coalesce(F.sum(price * F.col("Quantity")), F.lit(0)).alias("total"),
        F.sum("Quantity").alias("total_items"),
    )


def invoice_documents(
    invoice: DataFrame,
    line: DataFrame,
    lines_per_document: int = 10_000,
    ids_per_span: int = 100_000,
) -> DataFrame:
    """Each invoice with its lines nested in order of line id.

    An array must fit in memory, so lines come in pages: ``Part`` p holds the
    lines p * N to p * N + N - 1 of the invoice, N being ``lines_per_document``.
    An invoice without lines has one empty page.

    Lines are numbered in two steps, within spans of ids and then by the spans'
    counts, so a long invoice is never sorted in one task.
    """
    content = ("InvoiceLineId", "TrackId", "UnitPrice", "Quantity")
    spanned = line.select(
        "InvoiceId", *content, F.expr(f"InvoiceLineId div {ids_per_span}").alias("_span")
    )
    counts = spanned.groupBy("InvoiceId", "_span").agg(F.count(F.lit(1)).alias("_lines"))
    ahead = Window.partitionBy("InvoiceId").orderBy("_span")
    before = counts.select(
        "InvoiceId",
        "_span",
        F.coalesce(
            F.sum("_lines").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    within = Window.partitionBy("InvoiceId", "_span").orderBy(*content)
    paged = (
        spanned.withColumn("_n", F.row_number().over(within) - 1)
        .join(before, ["InvoiceId", "_span"])
        .withColumn("Part", F.expr(f"(_before + _n) div {lines_per_document}").cast("int"))
    )
    documents = paged.groupBy("InvoiceId", "Part").agg(
        F.sort_array(F.collect_list(F.struct(*content))).alias("Lines")
    )
    header = [
        c
        for c in ("CustomerId", "InvoiceDate", *BILLING_LENGTHS, "Total")
        if c in invoice.columns
    ]
    pages = counts.groupBy("InvoiceId").agg(
        F.expr(f"(sum(_lines) - 1) div {lines_per_document}").cast("int").alias("_last")
    )
    no_lines = F.array().cast(documents.schema["Lines"].dataType)
    return (
        invoice.select("InvoiceId", *header)
        .join(pages, "InvoiceId", "left")
        .withColumn("Part", F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0)))))
        .drop("_last")
        .join(documents, ["InvoiceId", "Part"], "left")
        .select("InvoiceId", *header, "Part", F.coalesce("Lines", no_lines).alias("Lines"))
    )


def screen_new_customers(candidates: DataFrame, customer: DataFrame) -> DataFrame:
    """(CandidateId, failed_rules) for customers to be added.

    Names and mail address must be present and not too long, the address must
    look like one, and it must be new: neither taken already nor given by a
    candidate with a lower id that breaks no other rule.
    """
    fields = {"FirstName": 40, "LastName": 20, "Email": 60}
    rules = {
        name: _fails(F.length(name).between(1, longest)) for name, longest in fields.items()
    }
    rules["Email"] |= _fails(F.col("Email").rlike(r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+$"))
    broken = F.array_compact(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    )
    checked = candidates.withColumn("failed_rules", broken)
    good = checked.filter(F.size("failed_rules") == 0)
    first = good.groupBy("Email").agg(F.min("CandidateId").alias("_first"))
    taken = customer.select("Email").distinct().withColumn("_taken", F.lit(True))
    owners = first.join(taken, "Email", "left")
    duplicate = (F.size("failed_rules") == 0) & (
        F.coalesce("_taken", F.lit(False)) | (F.col("CandidateId") != F.col("_first"))
    )
    return skew_join(checked, owners, "Email", "left").select(
        "CandidateId",
        F.when(duplicate, F.array(F.lit("email_exists")))
        .otherwise(F.col("failed_rules"))
        .alias("failed_rules"),
    )
