"""Purchase features of customers.

Everything is computed from one summary, purchases per customer and genre.
Lines are summed per invoice and genre before they meet the invoices, so an
invoice with very many lines brings at most one row per genre.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinilo.functions.numbers import percentage, ratio
from vinilo.operators.joins import lookup_join

# Fixed list of genres that get a share of their own.
MAIN_GENRES = ("Rock", "Metal", "Jazz", "Latin", "Blues", "Classical")

# Fixed names and order of the features.
BASIC_FEATURES = (
    "total_purchases",
    "total_spent",
    "avg_track_price",
    "avg_track_duration",
    "unique_genres",
)


def share_columns(main_genres: Sequence[str] = MAIN_GENRES) -> list[str]:
    return [f"{g.lower()}_percentage" for g in main_genres] + ["other_percentage"]


def feature_columns(main_genres: Sequence[str] = MAIN_GENRES) -> list[str]:
    """Names of the features, in the order of the feature vector."""
    return [*BASIC_FEATURES, *share_columns(main_genres)]


def genre_purchases(
    invoice: DataFrame, line: DataFrame, track: DataFrame, genre: DataFrame
) -> DataFrame:
    """Purchases per customer and genre name.

    The price is the one paid on the line. Tracks without a genre are left out.
    """
    genres = genre.select("GenreId", F.col("Name").alias("genre_name"))
    tracks = lookup_join(
        track.select("TrackId", "GenreId", "Milliseconds"), genres, "GenreId", "inner"
    ).drop("GenreId")
    bought = lookup_join(
        line.select("InvoiceId", "TrackId", "UnitPrice"),
        tracks,
        "TrackId",
        "inner",
        size_of=track,
    )
    per_invoice = bought.groupBy("InvoiceId", "genre_name").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum("UnitPrice").alias("spent"),
        F.count("UnitPrice").alias("priced"),
        F.sum(F.col("Milliseconds").cast("bigint")).alias("duration"),
        F.count("Milliseconds").alias("timed"),
    )
    buyers = invoice.select("InvoiceId", "CustomerId")
    sums = [F.sum(c).alias(c) for c in ("purchases", "spent", "priced", "duration", "timed")]
    return per_invoice.join(buyers, "InvoiceId").groupBy("CustomerId", "genre_name").agg(*sums)


def _basic_aggregates() -> list[Column]:
    return [
        F.sum("purchases").alias("total_purchases"),
        F.sum("spent").alias("total_spent"),
        ratio(F.sum("spent"), F.sum("priced")).alias("avg_track_price"),
        ratio(F.sum("duration"), F.sum("timed")).alias("avg_track_duration"),
        F.count("genre_name").alias("unique_genres"),
    ]


def _share_aggregates(main_genres: Sequence[str]) -> list[Column]:
    def share(of_interest: Column) -> Column:
        matching = F.sum(F.when(of_interest, F.col("purchases")).otherwise(F.lit(0)))
        return percentage(matching, F.sum("purchases"))

    genre = F.col("genre_name")
    is_main = F.coalesce(genre.isin(*main_genres), F.lit(False))
    named = [share(genre == g) for g in main_genres]
    return [
        column.alias(name)
        for column, name in zip(
            [*named, share(~is_main)], share_columns(main_genres), strict=True
        )
    ]


def basic_features(purchases: DataFrame) -> DataFrame:
    """Purchases, spending, average price and duration, and genres per customer."""
    return purchases.groupBy("CustomerId").agg(*_basic_aggregates())


def genre_mix(
    purchases: DataFrame, main_genres: Sequence[str] = MAIN_GENRES
) -> DataFrame:
    """Share of each main genre, and of all others together, per customer."""
    return purchases.groupBy("CustomerId").agg(*_share_aggregates(main_genres))


def genre_pivot(purchases: DataFrame, genres: Sequence[str]) -> DataFrame:
    """Purchases per customer with one column for each of the given genres."""
    return (
        purchases.groupBy("CustomerId")
        .pivot("genre_name", list(genres))
        .sum("purchases")
        .fillna(0)
    )


def customer_features(
    customer: DataFrame,
    invoice: DataFrame,
    line: DataFrame,
    track: DataFrame,
    genre: DataFrame,
    main_genres: Sequence[str] = MAIN_GENRES,
) -> DataFrame:
    """Features of every customer with a purchase, with name and country."""
    features = (
        genre_purchases(invoice, line, track, genre)
        .groupBy("CustomerId")
        .agg(*_basic_aggregates(), *_share_aggregates(main_genres))
    )
    people = customer.select("CustomerId", "FirstName", "LastName", "Country")
    return people.join(features, "CustomerId")
