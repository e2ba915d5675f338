"""Sharding by proportional stratified interleaving.

Rows are shuffled within each source by a seeded hash and ranked; a row's
fractional rank is its place on the unit line. Ordered by it, the sources
interleave in proportion to their sizes, so each of the equal cuts has the
mixture of the whole. Row counts of the shards differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.ranks import BUCKET_ROWS, hex_digits, running


def stratified_shards(
    docs: DataFrame,
    shards: int = 8,
    seed: str = "shards",
    source: str = "source",
    identity: tuple[str, ...] = ("doc_id",),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless within the shard).

    ``identity`` names the columns that tell rows apart. Nulls in them and in
    ``source`` are values like others; a null source is a source of its own.
    Rows equal in ``identity`` and ``source`` share a hash; which of them comes
    first is open, and changes nothing if they are equal throughout. An empty
    table gives an empty result. Columns named shard or slot are replaced.
    """
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.count()
    digits = hex_digits(rows, bucket_rows)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in identity]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.col(source).alias("_source"),
        F.md5(F.concat_ws(":", F.lit(seed), *parts)).alias("_hash"),
    )
    counts = keyed.groupBy("_source").agg(F.count(F.lit(1)).alias("_of"))
    ranked = running(
        keyed,
        ["_source"],
        F.substring("_hash", 1, digits),
        ["_hash", *[f"row.{c}" for c in identity]],
        F.lit(1),
        "_rank",
    )
    # Sources of one row must not all stand at the same place, hence the shift.
    shift = F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(1 << 20)) / float(1 << 20)
    placed = (
        ranked.alias("a")
        .join(counts.alias("b"), F.col("a._source").eqNullSafe(F.col("b._source")))
        .select("a.*", "b._of")
        .withColumn("_place", (F.col("_rank") + shift) / F.col("_of"))
    )
    cuts = max(1, -(-rows // bucket_rows))
    ordered = running(
        placed,
        [],
        F.floor(F.col("_place") * cuts),
        ["_place", "_hash", *[f"row.{c}" for c in identity]],
        F.lit(1),
        "_position",
    )
    total = F.lit(max(rows, 1)).cast("long")
    shard = F.expr(f"_position * {shards} div {max(rows, 1)}")
    return ordered.withColumn("shard", shard.cast("int")).select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        "shard",
        (F.col("_position") - F.ceil(F.col("shard").cast("long") * total / shards))
        .cast("long")
        .alias("slot"),
    )
