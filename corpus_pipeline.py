"""From raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vinilo.llm import bpe, mixing, neardup, repeats, rules
from vinilo.llm.common import documents, saved, tokenizer_path, word_count
from vinilo.llm.queries import pattern

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold all rules."""
    return rules.quality_rules(docs).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by preference that of the smallest doc_id.

    Rows are told apart, not ids: rows that share a doc_id, and rows without
    one, go only if their own shingles are linked to a kept row. Of rows equal
    in every column one stays. Texts without words are linked with nothing.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    shared = saved(
        ids.filter("_n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_shared")), "shared-ids"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_shared"))
    columns = docs.select(*COLUMNS)
    own = columns.join(shared, same, "left_anti").withColumn("_key", F.col("doc_id").cast("long"))
    # A hash of the row stands for its id, above all ids in use.
    place = F.xxhash64(*COLUMNS).bitwiseAND(2**62 - 1) + 2**62
    others = (
        columns.join(shared, same, "left_semi").withColumn("_key", place).dropDuplicates(["_key"])
    )
    rows = own.union(others)
    judged = neardup.near_duplicates(
        rows.select(F.col("_key").alias("doc_id"), "text"), width=5, percent=80
    )
    kept = saved(judged.filter("kept").select(F.col("doc_id").alias("_kept")), "kept")
    return rows.join(kept, F.col("_key") == F.col("_kept"), "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier already; the rest keeps its spacing."""
    cut = repeats.remove_repeats(docs.select(*COLUMNS), window=20, layout=True)
    return cut.withColumn("text", F.col("kept_text")).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in whole: none, one or two times.

    A pass counts if it takes at least half of the words. Documents without
    words are never taken.
    """
    identity = F.xxhash64(*COLUMNS)
    sized = saved(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), identity.alias("_row")
        ),
        "sizes",
    )
    line, mixed = mixing.mix(sized, keys=("_row",))
    share = F.col("taken") / F.col("size")
    times = (
        mixing.words_taken(line, mixed)
        .filter("taken > 0")
        .groupBy("_row")
        .agg(F.sum(F.floor(share + 0.5)).alias("_times"))
        .filter("_times > 0")
    )
    # Equal rows share what was taken of them.
    equal = Window.partitionBy("_row")
    ordered = equal.orderBy("doc_id")
    return (
        docs.select(*COLUMNS, identity.alias("_row"))
        .join(times, "_row")
        .withColumns(
            {"_n": F.row_number().over(ordered) - 1, "_of": F.count(F.lit(1)).over(equal)}
        )
        .withColumn(
            "_copies",
            F.expr("_times div _of + CASE WHEN _n < _times % _of THEN 1 ELSE 0 END").cast("int"),
        )
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*COLUMNS)
    )


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text back."""
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    checked = bpe.encoded(docs.select(*COLUMNS), path, pattern(), back=True)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return checked.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        (F.col("decoded") == text).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

# Min-max bands, the suffix groups and BPE are beyond SQL; the test runs a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
