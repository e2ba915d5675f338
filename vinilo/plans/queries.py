"""One query per operator, over the retail tables of a folder.

``comparable`` shows decimals as doubles and dates as text, so that another
engine's result can be compared value by value.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinilo.functions import dates, text
from vinilo.operators import artists, audit, checkout, features, history, sales, segments, shop
from vinilo.operators.daybase import DayBase
from vinilo.operators.joins import skew_join
from vinilo.operators.pageindex import PageIndex
from vinilo.plans import reports
from vinilo.plans.segmentation_job import Segmentation, segment_features
from vinilo.plans.session import checkpoint, scratch_folder
from vinilo.sources import lake
from vinilo.sources.buckets import BucketedSales, bucket_count
from vinilo.sources.catalog import register_lake
from vinilo.sources.layout import LakeLayout
from vinilo.sources.retail import GENRES, MAIN_GENRES, NOBODY, Retail
from vinilo.sources.skipping import KeyedTable

OLDER, NEWER = "20240101_000000", "20240102_000000"
CLUSTERS = 3
SWEEP = segments.K_RANGE

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def query(f: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    """Register ``f`` under its own name."""
    REGISTRY[f.__name__] = lambda spark, folder: comparable(f(Retail(spark, folder)))
    return f


# Rollups


@query
def sales_per_day(r: Retail) -> DataFrame:
    return sales.sales_per_day(r.invoice(), r.line())


def _bucketed(r: Retail) -> BucketedSales:
    """Invoices and lines laid out by invoice; in the test tables none has very many lines."""
    root = scratch_folder(r.spark, "bucketed")
    size = bucket_count(r.spark, r.line().count() * 100)
    tables = BucketedSales(r.spark, root, f"sales_{root[-32:]}", NEWER, size)
    tables.write(r.invoice(), r.line())
    return tables


@query
def sales_per_day_bucketed(r: Retail) -> DataFrame:
    return sales.per_day(_bucketed(r).totals())


def _day_base(r: Retail) -> DayBase:
    """Daily measures and customers, written out once and merged from there."""
    base = DayBase.of(sales.invoice_totals(r.invoice(), r.line()))
    return DayBase(checkpoint(base.measures), checkpoint(base.customers))


@query
def sales_by_month_merged(r: Retail) -> DataFrame:
    months = _day_base(r).merged(year_month=dates.year_month(F.col("fecha"))).drop("numero_dias")
    return sales.with_invoice_ratios(months)


@query
def sales_by_weekday_merged(r: Retail) -> DataFrame:
    days = _day_base(r).merged(dia_semana=dates.weekday_name(F.col("fecha"))).drop("numero_dias")
    return sales.with_invoice_ratios(days)


@query
def weekend_comparison_merged(r: Retail) -> DataFrame:
    return sales.with_invoice_ratios(
        _day_base(r).merged(fin_de_semana=dates.is_weekend(F.col("fecha")))
    )


@query
def sales_per_day_rounded(r: Retail) -> DataFrame:
    return sales.sales_per_day(r.invoice(), r.line(), round_to=2)


@query
def sales_by_weekday(r: Retail) -> DataFrame:
    return sales.sales_by_weekday(r.invoice(), r.line())


@query
def sales_by_month(r: Retail) -> DataFrame:
    return sales.sales_by_month(r.invoice(), r.line())


@query
def sales_dropped_dates(r: Retail) -> DataFrame:
    """What a rollup observes of invoices that it leaves out for their dates."""
    date = F.date_format("InvoiceDate", "yyyy-MM-dd")
    texts = r.invoice().withColumn(
        "InvoiceDate",
        F.when(F.col("InvoiceId") % 50 == 0, "bad").when(F.col("InvoiceId") % 70 != 0, date),
    )
    watched, dropped = sales.watched_dates(texts)
    sales.sales_per_day(watched, r.line()).write.format("noop").mode("overwrite").save()
    return r.spark.createDataFrame([dropped.get], sales.DROPPED)


@query
def sales_valid_dates(r: Retail) -> DataFrame:
    """Invoices per date, with some of the dates made unreadable."""
    date = F.date_format("InvoiceDate", "yyyy-MM-dd")
    texts = r.invoice().withColumn(
        "InvoiceDate", F.when(F.col("InvoiceId") % 50 == 0, "bad").otherwise(date)
    )
    return sales.valid_dates(texts).groupBy("fecha").agg(F.count(F.lit(1)).alias("facturas"))


@query
def date_parts(r: Retail) -> DataFrame:
    date = F.col("fecha")
    return (
        sales.valid_dates(r.invoice())
        .select("fecha")
        .distinct()
        .withColumns(
            {
                "dia_semana": dates.weekday_name(date),
                "nombre_mes": dates.month_name(date),
                "year_month": dates.year_month(date),
                "mes": F.month(date),
                "año": F.year(date),
                "trimestre": F.quarter(date),
                "inicio_mes": dates.month_start(date),
            }
        )
    )


# Artists


def _artist_metrics(r: Retail) -> DataFrame:
    return artists.artist_month_metrics(
        r.invoice(), r.line(), r.track(), r.album(), r.artist()
    )


@query
def artist_sales_attribution(r: Retail) -> DataFrame:
    sold = artists.attribute_sales(r.line(), r.track(), r.album(), r.artist())
    return sold.groupBy("ArtistId", "Name").agg(
        F.count("TrackId").alias("lineas"), F.sum("Quantity").alias("cantidad")
    )


@query
def artist_month_metrics(r: Retail) -> DataFrame:
    return _artist_metrics(r)


@query
def artist_month_metrics_attributed(r: Retail) -> DataFrame:
    return artists.artist_month_metrics(
        r.invoice(), r.line(), r.track(), r.album(), r.artist(), drop_unattributed=True
    )


@query
def artist_month_metrics_flat(r: Retail) -> DataFrame:
    """From one frame under other column names, without invoice and customer ids."""
    sold = artists.attribute_sales(r.line(), r.track(), r.album(), r.artist())
    dates = r.invoice().select("InvoiceId", "InvoiceDate")
    dated = skew_join(sold, dates, "InvoiceId", count_in=r.line())
    flat = dated.select(
        F.col("InvoiceDate").alias("invoice_date"),
        F.col("ArtistId").alias("artist_id"),
        F.col("UnitPrice").alias("unitprice"),
        F.col("TrackId").alias("trackid"),
        F.col("Quantity").alias("quantity"),
    )
    return artists.artist_month_metrics_flat(flat)


@query
def month_totals(r: Retail) -> DataFrame:
    return artists.month_totals(_artist_metrics(r))


@query
def top_artist_per_month(r: Retail) -> DataFrame:
    return artists.top_artist_per_month(_artist_metrics(r))


@query
def top5_artists_per_month(r: Retail) -> DataFrame:
    return artists.top_artists_per_month(_artist_metrics(r), top=5)


# Reports


@query
def report_latest_days(r: Retail) -> DataFrame:
    return reports.latest_days(sales.sales_per_day(r.invoice(), r.line()))


@query
def report_days_after(r: Retail) -> DataFrame:
    daily = sales.sales_per_day(r.invoice(), r.line())
    return reports.days_after(daily, datetime.date(2000, 1, 1))


@query
def report_top_artists(r: Retail) -> DataFrame:
    return reports.top_artists(artists.top_artist_per_month(_artist_metrics(r)))


@query
def weekend_comparison(r: Retail) -> DataFrame:
    return sales.weekend_comparison(r.invoice(), r.line())


@query
def weekday_normalized(r: Retail) -> DataFrame:
    return reports.weekday_normalized(sales.sales_per_day(r.invoice(), r.line()))


@query
def month_ranking(r: Retail) -> DataFrame:
    return reports.month_ranking(r.invoice(), r.line())


@query
def best_month_per_year(r: Retail) -> DataFrame:
    return reports.best_month_per_year(r.invoice(), r.line())


@query
def quarter_ranking(r: Retail) -> DataFrame:
    return reports.quarter_ranking(r.invoice(), r.line())


@query
def month_trend(r: Retail) -> DataFrame:
    return reports.month_trend(r.invoice(), r.line())


@query
def month_trend_with_gaps(r: Retail) -> DataFrame:
    """With every March and every seventh month of the calendar taken out of the data."""
    number = F.year("InvoiceDate") * 12 + F.month("InvoiceDate")
    kept = r.invoice().filter((F.month("InvoiceDate") != 3) & (number % 7 != 0))
    return reports.month_trend(kept, r.line())


# Lake


def _lake(r: Retail, tables: dict[str, DataFrame], older: dict[str, DataFrame]) -> LakeLayout:
    layout = LakeLayout(scratch_folder(r.spark, "lake"))
    lake.full_copy(older.__getitem__, layout, older, OLDER)
    lake.full_copy(tables.__getitem__, layout, tables, NEWER)
    return layout


@query
def customer_employee_history(r: Retail) -> DataFrame:
    return history.customer_employee_history(r.customer(), r.employee())


@query
def full_copy_counts(r: Retail) -> DataFrame:
    """Rows of every table after a full copy."""
    tables = r.lake_tables()
    layout = _lake(r, tables, {})
    return lake.row_counts(lake.read_raw_tables(r.spark, layout, tables))


@query
def snapshot_latest(r: Retail) -> DataFrame:
    """Invoices read back from a lake with two snapshots; the older has other totals."""
    newer = {"Invoice": r.invoice()}
    older = {"Invoice": r.invoice().withColumn("Total", F.col("Total") + 1)}
    layout = _lake(r, newer, older)
    return lake.read_snapshot(r.spark, layout.raw("Invoice"))


@query
def snapshot_roundtrip(r: Retail) -> DataFrame:
    """Daily sales from two-snapshot tables, written as a dataset and read back."""
    tables = {"Invoice": r.invoice(), "InvoiceLine": r.line()}
    layout = _lake(r, tables, tables)
    raw = lake.read_raw_tables(r.spark, layout, tables)
    daily = sales.sales_per_day(raw["Invoice"], raw["InvoiceLine"])
    dataset = layout.processed("ventas_por_dia")
    lake.write_snapshot(daily, dataset, NEWER)
    return lake.read_snapshot(r.spark, dataset)


@query
def catalog_widened(r: Retail) -> DataFrame:
    """Invoices per customer over two snapshots; the older one has narrower columns."""
    older = r.invoice().select(
        F.col("InvoiceId").cast("int").alias("InvoiceId"),
        F.col("CustomerId").cast("int").alias("CustomerId"),
        F.to_date("InvoiceDate").alias("InvoiceDate"),
        F.col("Total").cast("decimal(10,1)").alias("Total"),
    )
    layout = _lake(r, {"Invoice": r.invoice()}, {"Invoice": older})
    database = f"lake_{layout.root[-32:]}"
    register_lake(r.spark, layout, database, ["Invoice"])
    return r.spark.table(f"{database}.dl_invoice").groupBy("CustomerId").agg(
        F.count(F.lit(1)).alias("facturas"),
        F.sum("Total").alias("total"),
        F.max("InvoiceDate").alias("ultima"),
    )


@query
def catalog_tables(r: Retail) -> DataFrame:
    """Rows of every registered table, both snapshots of invoices included."""
    tables = r.lake_tables()
    layout = _lake(r, tables, {"Invoice": r.invoice()})
    database = f"lake_{layout.root[-32:]}"
    registered = register_lake(r.spark, layout, database, tables)["tables"]
    return lake.row_counts({t: r.spark.table(f"{database}.{t}") for t in registered})


# Features


def _purchases(r: Retail) -> DataFrame:
    return features.genre_purchases(r.invoice(), r.line(), r.track(), r.genre())


def _features(r: Retail) -> DataFrame:
    return features.customer_features(
        r.customer(), r.invoice(), r.line(), r.track(), r.genre(), MAIN_GENRES
    )


@query
def customer_basic_features(r: Retail) -> DataFrame:
    return features.basic_features(_purchases(r))


@query
def customer_genre_mix(r: Retail) -> DataFrame:
    return features.genre_mix(_purchases(r), MAIN_GENRES)


@query
def genre_pivot(r: Retail) -> DataFrame:
    return features.genre_pivot(_purchases(r), GENRES)


@query
def customer_features(r: Retail) -> DataFrame:
    return _features(r)


# Segments


FEATURES = features.feature_columns(MAIN_GENRES)


def _segmentation(r: Retail, **options) -> Segmentation:
    return segment_features(_features(r), FEATURES, ks=SWEEP, **options)


@query
def scaled_features(r: Retail) -> DataFrame:
    scaled, _ = segments.scale(checkpoint(_features(r)), FEATURES)
    values = segments.scaled_columns(scaled, FEATURES)
    return values.select(
        "CustomerId", *[(F.rint(F.col(c) * 1e6) / 1e6).alias(c) for c in FEATURES]
    )


@query
def silhouette_sweep(r: Retail) -> DataFrame:
    scaled, _ = segments.scale(checkpoint(_features(r)), FEATURES)
    return r.spark.createDataFrame(
        [(s.k, s.silhouette, s.cost) for s in segments.sweep_k(scaled, SWEEP)],
        "k int, silhouette double, cost double",
    )


@query
def customer_clusters(r: Retail) -> DataFrame:
    result = _segmentation(r, k=CLUSTERS)
    return result.predictions.select(*segments.CUSTOMER_COLUMNS, "cluster")


@query
def cluster_profile(r: Retail) -> DataFrame:
    return _segmentation(r, k=CLUSTERS).profile


@query
def cluster_examples(r: Retail) -> DataFrame:
    return segments.cluster_examples(_segmentation(r, k=CLUSTERS).predictions)


@query
def segmentation_run(r: Retail) -> DataFrame:
    """The whole segmentation with a search for k; its saved statistics read back."""
    output = scratch_folder(r.spark, "segments")
    _segmentation(r, output_path=output)
    return r.spark.read.parquet(f"{output}/cluster_statistics")


@query
def segmentation_checks(r: Retail) -> DataFrame:
    """What holds of a segmentation whatever its clusters are."""
    scaled, _ = segments.scale(checkpoint(_features(r)), FEATURES)
    model, predictions, _ = segments.train_kmeans(scaled, CLUSTERS)
    profile = segments.cluster_profile(predictions, FEATURES)
    return segments.segmentation_checks(
        predictions, profile, [c.tolist() for c in model.clusterCenters()], FEATURES
    )


@query
def silhouette_sweep_checks(r: Retail) -> DataFrame:
    """What holds of every fit of the sweep whatever its clusters are."""
    scaled, _ = segments.scale(checkpoint(_features(r)), FEATURES)
    return segments.sweep_checks(scaled, segments.sweep_models(scaled, SWEEP))


@query
def segmentation_run_checks(r: Retail) -> DataFrame:
    """What holds of the saved results of a whole run."""
    output = scratch_folder(r.spark, "segments")
    customers = checkpoint(_features(r))
    result = segment_features(customers, FEATURES, ks=SWEEP, output_path=output)
    return segments.saved_checks(customers, FEATURES, segments.best_k(result.sweep), output)


@query
def country_silhouettes(r: Retail) -> DataFrame:
    """How well customers of a country stand together by their purchases."""
    scaled, _ = segments.scale(checkpoint(_features(r)), FEATURES)
    rated = segments.silhouettes(scaled.withColumn("g", F.lit(1)), "g", "Country")
    return rated.select(
        "Country",
        F.col("n").alias("customers"),
        (F.rint(F.col("silhouette") * 1e6) / 1e6 + F.lit(0.0)).alias("silhouette"),
    )


# Shop


@query
def catalog_search(r: Retail) -> DataFrame:
    return shop.catalog_search(
        r.track(), limit=50, offset=10, name="ring", min_price=900, max_price=990
    )


@query
def catalog_filter(r: Retail) -> DataFrame:
    """Tracks of one album and genre behind a key."""
    tracks = shop.filter_tracks(r.track(), album_id="Brand#13", genre_id="STANDARD")
    return shop.page(tracks, "TrackId", limit=50, after=20)


@query
def catalog_page(r: Retail) -> DataFrame:
    return shop.page(r.album(), "AlbumId", limit=10, offset=5)


@query
def catalog_page_indexed(r: Retail) -> DataFrame:
    """A hundred tracks from the middle of the catalog, over several ranges of its index."""
    index = PageIndex.build(
        r.track(), ["TrackId"], scratch_folder(r.spark, "pages"), range_rows=64
    )
    return index.page(limit=100, offset=index.size() // 2)


@query
def catalog_search_indexed(r: Retail) -> DataFrame:
    """The second page of a search, found by counting matches per range."""
    index = PageIndex.build(
        r.track(), ["TrackId"], scratch_folder(r.spark, "pages"), range_rows=64
    )
    return index.page(limit=20, offset=20, condition=F.col("UnitPrice") < 1000)


@query
def point_lookup(r: Retail) -> DataFrame:
    """Tracks of all cart items by their id; some are unknown."""
    found = shop.point_lookup(r.cart_items(), r.track(), "TrackId")
    return found.groupBy("TrackId", "found", "Name", "UnitPrice").agg(
        F.count(F.lit(1)).alias("requests")
    )


@query
def invoice_lookup_skipping(r: Retail) -> DataFrame:
    """The invoice with the highest total of each month, from invoices laid out by id."""
    root = scratch_folder(r.spark, "keyed")
    table = KeyedTable.write(r.invoice(), "InvoiceId", root, range_rows=1000)
    month = dates.year_month(F.col("InvoiceDate"))
    best = (
        r.invoice()
        .groupBy(month.alias("year_month"))
        .agg(F.max_by("InvoiceId", F.struct("Total", "InvoiceId")).alias("InvoiceId"))
    )
    missing = r.invoice().select((F.max("InvoiceId") + NOBODY).alias("InvoiceId"))
    return table.lookup(best.select("InvoiceId").union(missing))


@query
def catalog_filter_skipping(r: Retail) -> DataFrame:
    """All tracks of one album and genre, row groups without them skipped."""
    root = scratch_folder(r.spark, "keyed")
    columns = ("AlbumId", "GenreId")
    table = KeyedTable.write(r.track(), "TrackId", root, columns, range_rows=1000)
    return table.equal(AlbumId="Brand#13", GenreId="STANDARD")


@query
def checkout_validation(r: Retail) -> DataFrame:
    return checkout.validate_checkouts(r.carts(), r.cart_items()).withColumn(
        "failed_rules", F.array_join("failed_rules", ",")
    )


def _priced(r: Retail) -> checkout.PricedCheckouts:
    return checkout.price_checkouts(r.carts(), r.cart_items(), r.customer(), r.track())


@query
def price_checkouts(r: Retail) -> DataFrame:
    return _priced(r).invoices


@query
def checkout_lines(r: Retail) -> DataFrame:
    return _priced(r).lines


@query
def checkout_rejects(r: Retail) -> DataFrame:
    return _priced(r).rejects


@query
def new_customer_screening(r: Retail) -> DataFrame:
    """Customers as candidates, some of them sharing or lacking a mail address."""
    key, name = F.col("c_custkey"), F.col("c_name")
    candidates = r.table("customer").select(
        key.alias("CandidateId"),
        F.when(key % 17 != 0, F.col("c_mktsegment")).alias("FirstName"),
        F.when(key % 19 == 0, F.concat(name, name)).otherwise(name).alias("LastName"),
        F.when(key % 3 == 0, F.lit("shared@mail.test"))
        .when(key % 23 == 0, F.lit("no address"))
        .when(key % 5 == 0, F.concat(F.lit("new"), key, F.lit("@mail.test")))
        .otherwise(F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@mail.test")))
        .alias("Email"),
    )
    return checkout.screen_new_customers(candidates, r.customer()).withColumn(
        "failed_rules", F.array_join("failed_rules", ",")
    )


@query
def constraint_audit(r: Retail) -> DataFrame:
    """All rules on all tables, with lines of unknown invoices and shared addresses added."""
    tables = r.lake_tables()
    orphaned = F.when(F.col("InvoiceId") % 500 == 0, NOBODY).otherwise(0)
    tables["InvoiceLine"] = r.line().withColumn("InvoiceId", F.col("InvoiceId") + orphaned)
    shared = F.when(F.col("CustomerId") % 3 == 0, "shared@mail.test").otherwise(F.col("Email"))
    tables["Customer"] = r.customer().withColumn("Email", shared)
    return audit.constraint_audit(tables)


@query
def invoice_documents(r: Retail) -> DataFrame:
    """Pages of three lines, with the nested lines written out as text."""
    lines = F.transform(
        "Lines",
        lambda x: F.concat_ws(
            ":", x["InvoiceLineId"], x["TrackId"], x["UnitPrice"], x["Quantity"]
        ),
    )
    return (
        checkout.invoice_documents(r.invoice(), r.line(), lines_per_document=3)
        .withColumn("line_count", F.size("Lines"))
        .withColumn("Lines", F.array_join(lines, "|"))
    )


@query
def cart_merge(r: Retail) -> DataFrame:
    return checkout.merge_cart(r.cart_items())


@query
def cart_totals(r: Retail) -> DataFrame:
    """Totals of carts whose prices come as text, some of it unreadable."""
    texts = r.cart_items().withColumn(
        "UnitPrice",
        F.when(F.col("CheckoutId") % 11 == 0, F.lit("n/a")).otherwise(
            F.col("UnitPrice").cast("string")
        ),
    )
    totals = checkout.cart_totals(texts)
    return totals.withColumn("total", F.rint(F.col("total") * 100) / 100)


# Text


def _price_texts(r: Retail) -> DataFrame:
    """Every line's price as text, in the forms a client may send."""
    price = F.col("UnitPrice").cast("string")
    form = F.col("InvoiceId") % 7
    shown = (
        F.when(form == 0, F.concat(price, F.lit("abc")))
        .when(form == 1, F.lit(""))
        .when(form == 2, F.lit("abc"))
        .when(form == 3, F.lit(None))
        .when(form == 4, F.concat(F.lit("  -"), price))
        .when(form == 5, F.concat(price, F.lit("e1")))
        .otherwise(price)
    )
    return r.line().select("InvoiceLineId", shown.alias("text"))


@query
def parse_price(r: Retail) -> DataFrame:
    return _price_texts(r).withColumn("price", text.parse_price(F.col("text")))


@query
def format_price(r: Retail) -> DataFrame:
    return _price_texts(r).withColumn("price", text.format_price(F.col("text")))


@query
def format_duration(r: Retail) -> DataFrame:
    """Lengths of all tracks, some missing, zero or negative."""
    key, length = F.col("TrackId"), F.col("Milliseconds")
    lengths = r.track().select(
        "TrackId",
        F.when(key % 10 == 0, F.lit(None))
        .when(key % 10 == 1, 0)
        .when(key % 10 == 2, -length)
        .when(key % 10 == 3, length * 97)
        .otherwise(length)
        .alias("milliseconds"),
    )
    return lengths.withColumn("duration", text.format_duration(F.col("milliseconds")))
