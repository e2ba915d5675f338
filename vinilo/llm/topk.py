"""Exact nearest binary codes by incremental multi-index hashing.

A code is cut into segments of about log2(n) bits, n being the number of codes, so that
a segment's value has one posting on average at any size. Two codes at distance d agree within floor(d / m)
bits in at least one of m segments, so once every segment has been probed up to
radius r, all codes within m * (r + 1) - 1 bits have been seen. Radii grow round
by round; a query leaves as soon as its k nearest lie within that bound.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vinilo.llm.common import saved


def sign_codes(vectors: DataFrame, key: str, vector: str, bits: int = 64) -> DataFrame:
    """(id, code): a bit per component, set where it is above zero.

    Rows with a null id or a vector that is null or not of ``bits`` components
    are left out; a null component counts as not above zero.
    """
    return vectors.filter(F.col(key).isNotNull() & (F.size(vector) == bits)).select(
        F.col(key).cast("long").alias("id"),
        F.aggregate(
            F.col(vector),
            F.lit(0).cast("long"),
            lambda code, x: F.shiftleft(code, 1).bitwiseOR(
                F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
            ),
        ).alias("code"),
    )


def segment_widths(bits: int, wanted: int) -> list[int]:
    """Widths of the segments, about ``wanted`` bits each, the wider ones first."""
    segments = max(1, round(bits / wanted))
    return [bits // segments + (s < bits % segments) for s in range(segments)]


def masks(width: int, radius: int) -> F.Column:
    """All numbers of ``width`` bits of which ``radius`` are set."""
    values = [sum(1 << b for b in c) for c in combinations(range(width), radius)]
    return F.lit(values).cast("array<long>")


def nearest_codes(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    bits: int = 64,
    segment_bits: int | None = None,
) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest of ``index`` (id, code) to each query (id, code).

    Ties go to the smaller id. A query's own id is no answer; repeated
    (id, code) rows count once. With fewer than k others all are returned. Equal
    codes are searched once and keep their k + 1 smallest ids, which is all that
    a ranking by distance and id can use. Empty tables give an empty result.

    Probes and postings are merged by segment and value: probes grow with the queries
    and the radius, so they are never broadcast. ``segment_bits`` is by default taken
    from the number of codes; segments differ by one bit where ``bits`` does not divide.
    """

    smallest = Window.partitionBy("code").orderBy("id")
    entries = saved(
        index.distinct()
        .withColumn("_n", F.row_number().over(smallest))
        .filter(F.col("_n") <= k + 1)
        .groupBy("code")
        .agg(F.array_sort(F.collect_list("id")).alias("ids")),
        "codes",
    )
    widths = segment_widths(bits, segment_bits or max(1, entries.count().bit_length()))
    segments = len(widths)

    def part(code, s: int):
        shifted = F.shiftrightunsigned(code, sum(widths[:s]))
        return shifted.bitwiseAND(F.lit((1 << widths[s]) - 1))

    def parts(code):
        return F.array(
            *[
                F.struct(F.lit(s).alias("segment"), part(code, s).cast("long").alias("value"))
                for s in range(segments)
            ]
        )

    postings = saved(
        entries.select("code", "ids", F.explode(parts(F.col("code"))).alias("p")).select(
            "p.segment", "p.value", "code", "ids"
        ),
        "postings",
    )
    active = saved(queries.distinct().toDF("query_id", "query_code"), "queries")
    best = active.sparkSession.createDataFrame([], "query_id long, id long, distance int")
    results = []
    nearest = Window.partitionBy("query_id").orderBy("distance", "id")
    for radius in range(widths[0] + 1):
        flips = F.when(F.col("segment") < widths.count(widths[0]), masks(widths[0], radius))
        flips = flips.otherwise(masks(widths[-1], radius))
        probes = (
            active.select("*", F.explode(parts(F.col("query_code"))).alias("p"))
            .select("query_id", "query_code", "p.segment", "p.value")
            .withColumn("_flip", F.explode(flips))
            .select(
                "query_id",
                "query_code",
                "segment",
                F.col("value").bitwiseXOR(F.col("_flip")).alias("value"),
            )
        )
        away = F.col("code").bitwiseXOR(F.col("query_code"))
        # A code is met once: in the first of the segments where it is closest.
        once = F.lit(True)
        for s in range(segments):
            d = F.bit_count(part(away, s))
            once = once & F.when(F.col("segment") > s, d > radius).otherwise(d >= radius)
        met = (
            probes.hint("merge")
            .join(postings, ["segment", "value"])
            .filter(once)
            .select("query_id", F.explode("ids").alias("id"), F.bit_count(away).alias("distance"))
            .filter("id <> query_id")
        )
        best = saved(
            best.union(met).withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k),
            "nearest",
        )
        covered = segments * (radius + 1) - 1
        if radius == widths[0]:
            results.append(best)
            break
        done = (
            best.filter(F.col("distance") <= covered)
            .groupBy("query_id")
            .count()
            .filter(F.col("count") >= k)
            .select("query_id")
        )
        done = saved(done, "done").hint("merge")
        results.append(best.join(done, "query_id", "left_semi"))
        active = saved(active.join(done, "query_id", "left_anti"), "queries")
        best = best.join(done, "query_id", "left_anti").drop("rank")
        if active.isEmpty():
            break
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found.select("query_id", "rank", "id", "distance")
