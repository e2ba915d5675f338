"""Lookups in the catalog: search, pages and lookups by key."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.operators.joins import fits_broadcast, skew_join

MAX_PAGE = 100


def page(
    table: DataFrame, key: str, limit: int = 50, offset: int = 0, after=None
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the table in key order.

    ``after`` starts behind that key, which stays cheap however deep the page
    is; an offset has to gather all rows before it.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must lie in 1..{MAX_PAGE}, not {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, not {offset}")
    if after is not None:
        table = table.filter(F.col(key) > F.lit(after))
    return table.orderBy(key).offset(offset).limit(limit)


def filter_tracks(
    track: DataFrame,
    name: str | None = None,
    album_id=None,
    genre_id=None,
    min_price: Decimal | float | None = None,
    max_price: Decimal | float | None = None,
) -> DataFrame:
    """Tracks that meet all given conditions; ``None`` and an empty name set none.

    The name may stand anywhere in the track's name, in any case; ``%`` and
    ``_`` in it are wildcards.
    """
    if any(p is not None and p < 0 for p in (min_price, max_price)):
        raise ValueError("prices must not be negative")
    conditions = []
    if name:
        conditions.append(F.col("Name").ilike(f"%{name}%"))
    if album_id is not None:
        conditions.append(F.col("AlbumId") == F.lit(album_id))
    if genre_id is not None:
        conditions.append(F.col("GenreId") == F.lit(genre_id))
    if min_price is not None:
        conditions.append(F.col("UnitPrice") >= F.lit(min_price))
    if max_price is not None:
        conditions.append(F.col("UnitPrice") <= F.lit(max_price))
    for condition in conditions:
        track = track.filter(condition)
    return track


def catalog_search(
    track: DataFrame, limit: int = 50, offset: int = 0, **conditions
) -> DataFrame:
    """One page of ``filter_tracks`` in order of track id."""
    return page(filter_tracks(track, **conditions), "TrackId", limit, offset)


def point_lookup(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The table's row for each requested key, with ``found`` telling if there is one.

    A bounded number of requests is broadcast and the table filtered by it, with
    no shuffle of the table; more are joined as a whole.
    """
    asked = requests.select(key)
    marked = table.withColumn("found", F.lit(True))
    if fits_broadcast(asked):
        hits = marked.join(F.broadcast(asked.distinct()), key, "left_semi")
        found = asked.join(F.broadcast(hits), key, "left")
    else:
        found = skew_join(asked, marked, key, "left")
    return found.withColumn("found", F.coalesce("found", F.lit(False)))
