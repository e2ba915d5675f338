"""Mixing sources to target weights along a low-discrepancy schedule.

Each source's documents, shuffled, lie end to end on a line of words that is cut
into blocks of equal length. The points t * golden ratio modulo 1 are mapped
through the cumulative targets to sources; the r-th slot of a source takes its
block r. A source that is taken more than once goes round its line again. Blocks have
BLOCK_WORDS words at every size of the corpus, so slots grow with it, and slots after
the sequence fill up the sources that it left short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vinilo.llm.common import saved
from vinilo.llm.ranks import BUCKET_ROWS, hex_digits, running

# The golden ratio's fraction in units of 2**-64, odd: steps of the integer sequence.
GOLDEN = 0x9E3779B97F4A7C15
BLOCK_WORDS = 64
CELLS = 4096
SLOT_RUN = 65_536


def targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources in code point order, null last, weigh ``weights``, repeating. They
    share ``share`` times all sizes by weight; a target stops at ``most`` times
    its source's size, and what is left over is shared again. There is one row
    per source here, and the windows without partition run over those only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sizes.groupBy("source")
        .agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
        .withColumn("_n", F.row_number().over(by_name) - 1)
        .withColumn(
            "_weight",
            F.element_at(F.array(*map(F.lit, weights)), F.col("_n") % len(weights) + 1),
        )
        .withColumn("_cap", F.col("source_size") * most)
    )
    # From the source that is full first on, the level is what the others can share.
    full_first = Window.orderBy(F.col("_cap") / F.col("_weight"), "_n")
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    leveled = sources.withColumn(
        "_level",
        (
            F.sum("source_size").over(whole) * share
            - F.coalesce(F.sum("_cap").over(before), F.lit(0))
        )
        / (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0))),
    ).withColumn("_open", F.col("_cap") > F.col("_level") * F.col("_weight"))
    level = F.min_by(
        F.when(F.col("_open"), F.col("_level")),
        F.when(F.col("_open"), F.struct(F.col("_cap") / F.col("_weight"), F.col("_n"))),
    ).over(whole)
    return leveled.select(
        "source",
        "source_size",
        F.least(
            F.col("_cap").cast("double"),
            F.coalesce(level * F.col("_weight"), F.col("_cap").cast("double")),
        ).alias("target"),
    )


def schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """(slot, source, rank): which source each slot takes, and its how-manieth slot that is.

    Points and intervals of the cumulative targets meet in cells of the unit
    line, so neither the sources nor the slots are broadcast. Points are whole
    multiples of the ratio modulo 2**64, exact for any number of slots.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    upto = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("target").over(whole)
    intervals = (
        sources.withColumn("_hi", F.sum("target").over(upto) / total)
        .withColumn("_lo", F.lag("_hi", 1, 0.0).over(by_name))
        .filter("target > 0")
        .select(
            "source",
            "_lo",
            F.when(F.col("_hi") > 1 - 1e-12, 2.0).otherwise(F.col("_hi")).alias("_hi"),
            F.explode(
                F.sequence(
                    F.floor(F.col("_lo") * CELLS),
                    F.least(F.floor(F.col("_hi") * CELLS), F.lit(CELLS - 1)),
                )
            ).alias("_cell"),
        )
    )
    turn = F.expr(
        f"CAST(id + 1 AS DECIMAL(17, 0)) * CAST({GOLDEN} AS DECIMAL(20, 0)) "
        f"% CAST({1 << 64} AS DECIMAL(20, 0))"
    )
    points = (
        spark.range(slots)
        .select(F.col("id").alias("slot"), (turn.cast("double") / float(1 << 64)).alias("_point"))
        .withColumn("_cell", F.least(F.floor(F.col("_point") * CELLS), F.lit(CELLS - 1)))
    )
    assigned = (
        points.join(intervals, "_cell")
        .filter("_point >= _lo AND _point < _hi")
        .select("slot", "source")
    )
    return running(
        assigned, ["source"], F.expr(f"slot div {SLOT_RUN}"), ["slot"], F.lit(1), "rank"
    )


def topped_up(plan: DataFrame, sources: DataFrame, slots: int, block: int) -> DataFrame:
    """The plan of so many slots, followed by those that sources lack for their whole target.

    The window without partition runs over sources, one row each.
    """
    have = plan.groupBy("source").agg(F.count(F.lit(1)).alias("_have"))
    ahead = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    short = (
        sources.alias("a")
        .join(have.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
        .select(
            "a.source",
            F.coalesce("_have", F.lit(0)).alias("_have"),
            F.expr(f"(floor(target) + {block - 1}) div {block}").alias("_need"),
        )
        .filter("_need > _have")
        .withColumn("_ahead", F.coalesce(F.sum(F.expr("_need - _have")).over(ahead), F.lit(0)))
        .select("*", F.explode(F.sequence("_have", F.col("_need") - 1)).alias("rank"))
        .select((F.col("_ahead") + F.col("rank") - F.col("_have") + slots).alias("slot"), "source", "rank")
    )
    return plan.select("slot", "source", "rank").union(short)


def mix(
    docs: DataFrame,
    weights=(5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    block: int = BLOCK_WORDS,
    keys: tuple[str, ...] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The line and the mix of documents (doc_id, source, size, ...).

    The line has a row per document with doc_id, source, size, the columns named
    in ``keys``, ``source_size``, ``target`` and ``line_start``, its place in its
    source. The mix has a row for each piece:
    slot, source, doc_id, line_start, pass, from_word, to_word. A slot holds a block
    of ``block`` words at most, and every source is taken up to its target rounded
    down, however small it is beside the others. The seed fixes the
    result. A null source is a source; a null doc_id is an id; a null size
    counts as 0, and documents without words are in the line but never in the
    mix. Repeated rows follow each other on the line. An
    empty table gives an empty line and mix.
    """
    spark = docs.sparkSession
    docs = docs.select(
        "doc_id", "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"), *keys
    )
    goals = saved(targets(docs, weights, share, most), "targets")
    budget = goals.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    rows = docs.count()
    own = docs.columns
    keyed = docs.withColumn(
        "_hash",
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
    )
    line = running(
        keyed,
        ["source"],
        F.substring("_hash", 1, hex_digits(rows, bucket_rows)),
        ["_hash", "doc_id", "size", *keys],
        F.col("size"),
        "line_start",
    )
    line = (
        line.alias("a")
        .join(goals.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
        .select(*[f"a.{c}" for c in own], "a.line_start", "b.source_size", "b.target")
    )
    line = saved(line, "line")
    taken = F.floor("target")
    pieces = (
        line.filter("size > 0")
        .select(
            "*",
            F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"),
        )
        .withColumn("_at", F.col("line_start") + F.col("pass") * F.col("source_size"))
        .withColumn("_stop", F.least(F.col("_at") + F.col("size"), taken))
        .filter("_stop > _at")
        .withColumn(
            "_block",
            F.explode(F.sequence(F.expr(f"_at div {block}"), F.expr(f"(_stop - 1) div {block}"))),
        )
    )
    points = int(-(-budget // block))
    plan = topped_up(saved(schedule(spark, goals, points), "plan"), goals, points, block)
    plan = plan.withColumnRenamed("source", "_of")
    mixed = pieces.join(
        plan, pieces["source"].eqNullSafe(plan["_of"]) & (pieces["_block"] == plan["rank"])
    ).select(
        "slot",
        "source",
        "doc_id",
        "line_start",
        "pass",
        (F.greatest("_at", F.col("_block") * block) - F.col("_at")).alias("from_word"),
        (F.least("_stop", (F.col("_block") + 1) * block) - F.col("_at")).alias("to_word"),
    )
    return line, mixed


def words_taken(line: DataFrame, mixed: DataFrame) -> DataFrame:
    """The line with ``taken``: the words the mix takes of each document, repeats counted."""
    pieces = mixed.groupBy("source", "line_start").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("_taken")
    )
    return (
        line.alias("a")
        .join(
            pieces.alias("b"),
            F.col("a.source").eqNullSafe(F.col("b.source"))
            & (F.col("a.line_start") == F.col("b.line_start"))
            & (F.col("a.size") > 0),
            "left",
        )
        .select("a.*", F.coalesce(F.col("b._taken"), F.lit(0)).cast("long").alias("taken"))
    )
