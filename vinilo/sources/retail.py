"""The store's tables, taken from a generic retail schema.

``orders`` are the invoices, ``lineitem`` their lines, ``part`` the tracks,
part brands the albums, part types the genres, nations the artists, regions
the media types and suppliers the employees. Brands run one number beyond the
nations, so that some albums have no artist.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinilo.operators.joins import lookup_join

GENRES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MAIN_GENRES = ("PROMO", "ECONOMY", "LARGE", "MEDIUM", "ABSENT")

NOBODY = 1_000_000_000  # added to an id to make it one that no table has


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


@dataclass(frozen=True)
class Retail:
    spark: SparkSession
    folder: str
    _opened: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def table(self, name: str) -> DataFrame:
        """A source table; its files are listed once, however often it is used."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def invoice(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("InvoiceId"),
            F.col("o_custkey").alias("CustomerId"),
            F.col("o_orderdate").alias("InvoiceDate"),
            F.col("o_orderpriority").alias("BillingCity"),
            F.col("o_orderstatus").alias("BillingState"),
            money("o_totalprice").alias("Total"),
        )

    def line(self) -> DataFrame:
        """Order lines. Line numbers repeat within an order, so the part helps to tell them."""
        numbered = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000
        return self.table("lineitem").select(
            (numbered + F.col("l_partkey") % 1000).alias("InvoiceLineId"),
            F.col("l_orderkey").alias("InvoiceId"),
            F.col("l_partkey").alias("TrackId"),
            money("l_extendedprice").alias("UnitPrice"),
            F.col("l_quantity").cast("int").alias("Quantity"),
        )

    def track(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("TrackId"),
            F.col("p_name").alias("Name"),
            F.col("p_brand").alias("AlbumId"),
            (F.col("p_size") % 6).alias("MediaTypeId"),
            F.col("p_type").alias("GenreId"),
            (F.col("p_size") * 7919).alias("Milliseconds"),
            money("p_retailprice").alias("UnitPrice"),
        )

    def album(self) -> DataFrame:
        brand = F.col("p_brand")
        return (
            self.table("part")
            .select(
                brand.alias("AlbumId"),
                brand.alias("Title"),
                F.regexp_extract(brand, r"(\d+)", 1).cast("int").alias("ArtistId"),
            )
            .distinct()
        )

    def artist(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("ArtistId"), F.col("n_name").alias("Name")
        )

    def genre(self) -> DataFrame:
        kind = F.col("p_type")
        return self.table("part").select(kind.alias("GenreId"), kind.alias("Name")).distinct()

    def media_type(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("MediaTypeId"), F.col("r_name").alias("Name")
        )

    def customer(self) -> DataFrame:
        key = F.col("c_custkey")
        mailbox = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
        countries = self.table("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Country")
        )
        return (
            lookup_join(self.table("customer"), countries, "c_nationkey", "inner")
            .select(
                key.alias("CustomerId"),
                F.col("c_mktsegment").alias("FirstName"),
                F.col("c_name").alias("LastName"),
                F.col("c_mktsegment").alias("Company"),
                "Country",
                F.concat(mailbox, F.lit("@mail.test")).alias("Email"),
                F.when(key % 13 != 0, key % 10).alias("SupportRepId"),
            )
        )

    def employee(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("EmployeeId"),
            F.col("s_name").alias("FirstName"),
            F.col("s_name").alias("LastName"),
            F.lit("rep").alias("Title"),
            F.when(key >= 3, F.floor(key / 3)).alias("ReportsTo"),
        )

    def carts(self) -> DataFrame:
        """Every order as a cart; some come from customers nobody knows."""
        cart = F.col("o_orderkey")
        unknown = F.when(cart % 101 == 0, NOBODY).otherwise(0)
        return self.table("orders").select(
            cart.alias("CheckoutId"),
            (F.col("o_custkey") + unknown).alias("CustomerId"),
            F.col("o_orderpriority").alias("BillingCity"),
        )

    def cart_items(self) -> DataFrame:
        """Every order line as a cart item at the catalog price, some of them wrong.

        Depending on the order, its tracks are unknown, its prices too high, or
        its quantities 0 or 101.
        """
        cart = F.col("l_orderkey")
        prices = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("_price")
        )
        unknown = F.when(cart % 97 == 0, NOBODY).otherwise(0)
        surcharge = F.when(cart % 7 == 0, 1).otherwise(0)
        return (
            lookup_join(self.table("lineitem"), prices, "l_partkey", "inner")
            .select(
                cart.alias("CheckoutId"),
                (F.col("l_linenumber") * 1_000_000_000_000 + F.col("l_partkey")).alias("Seq"),
                (F.col("l_partkey") + unknown).alias("TrackId"),
                F.when(cart % 89 == 0, 0)
                .when(cart % 83 == 0, 101)
                .otherwise(F.col("l_quantity").cast("int"))
                .alias("Quantity"),
                (F.col("_price") + surcharge).cast("decimal(12,2)").alias("UnitPrice"),
            )
        )

    def lake_tables(self) -> dict[str, DataFrame]:
        return {
            "Album": self.album(),
            "Artist": self.artist(),
            "Customer": self.customer(),
            "Employee": self.employee(),
            "Genre": self.genre(),
            "Invoice": self.invoice(),
            "InvoiceLine": self.line(),
            "MediaType": self.media_type(),
            "Track": self.track(),
        }
