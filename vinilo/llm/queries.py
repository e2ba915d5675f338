"""The operators' queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinilo.llm import (
    bpe,
    classifier,
    infill,
    langmodel,
    mixing,
    neardup,
    repeats,
    rules,
    sharding,
    suffixranks,
    topk,
    unigram,
    variants,
)
from vinilo.llm.common import documents, saved, tokenizer_path, word_count

QUERY_STEP = 100


def remainder(divisor: int) -> F.Column:
    """crc32 of the doc_id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_nearest_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest sign codes of every hundredth vector."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    codes = saved(topk.sign_codes(vectors, "vec_id", "embedding"), "signs")
    found = topk.nearest_codes(codes, codes.filter(F.col("id") % QUERY_STEP == 0), k=10)
    return found.withColumnRenamed("id", "vec_id")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.quality_rules(documents(spark, folder).select("doc_id", "text", "lang"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_stop_words",
    )


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Remainders 0 and 1 fit the weights, 3 calibrates, 2 is held out."""
    rest = remainder(4)
    scored = classifier.quality_scores(
        documents(spark, folder),
        spark.read.parquet(f"{folder}/labels.parquet"),
        {"fit": rest.isin(0, 1), "calibrate": rest == 3},
    )
    return scored.select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    tokens = bpe.encoded(documents(spark, folder), path, pattern(), carry=["doc_id"])
    return bpe.decoded(tokens, path, pattern()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_stratified_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, folder).select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = sharding.stratified_shards(rows, shards=8, identity=("doc_id", "text_crc32"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    sizes = documents(spark, folder).select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    line, mixed = mixing.mix(saved(sizes, "sizes"))
    return mixing.words_taken(line, mixed).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op7_minmax_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, folder), width=3, percent=85)


def op8_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return langmodel.language_scores(documents(spark, folder), remainder(10) == 0)


def op9_unigram_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    return unigram.token_counts(documents(spark, folder), path, carry=["doc_id"])


def op10_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(documents(spark, folder), window=20, carry=["doc_id"])
    return cut.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce(F.col("kept_text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    counts = saved(variants.word_counts(documents(spark, folder)), "counts")
    return variants.spelling_variants(counts)


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    filled = infill.fill_in_middle(documents(spark, folder), carry=["doc_id"])
    back = infill.restored(F.col("output"), F.col("form"))
    return filled.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_suffix_ranks(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixranks.remove_repeated_bytes(documents(spark, folder), length=200, carry=["doc_id"])
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_nearest_codes,
        op2_quality_rules,
        op3_quality_classifier,
        op4_byte_bpe,
        op5_stratified_shards,
        op6_source_mix,
        op7_minmax_neardup,
        op8_context_mixing,
        op9_unigram_counts,
        op10_repeated_windows,
        op11_spelling_variants,
        op12_infill,
        op13_suffix_ranks,
    )
}
