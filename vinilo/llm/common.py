"""What the operators share: saved tables, words in SQL, and components of a graph."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinilo.plans.session import scratch_folder

# Fixed by the contracts: what separates words.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back, so that nothing above runs again."""
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = "_" + name
    return name


def words(text) -> F.Column:
    """The words of a text, in order; none of a null."""
    blank = F.translate(F.coalesce(text, F.lit("")), SEPARATORS, " " * len(SEPARATORS))
    return F.array_remove(F.split(blank, " "), "")


def word_count(text) -> F.Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; TOKENIZER_FOLDER overrides the installed one."""
    folder = os.environ.get("TOKENIZER_FOLDER")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node that each end of an edge can reach.

    Alternating large-star and small-star steps; every step keeps at most as
    many edges as nodes and links, groups with partial minima and joins on a
    node, where adaptive execution splits a node of high degree.
    """
    now = saved(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        both = now.union(now.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        now = saved(
            small.select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct(),
            "edges",
        )
        state = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if seen == state:
            break
        seen = state
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("v", "v")
    )


def schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)
