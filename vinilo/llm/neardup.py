"""Near-duplicate detection by min-max hashing.

Each permutation of the shingles gives two values of a signature, its minimum
and its maximum, so a signature of n values costs n / 2 hash evaluations.
Bands of values put candidates into one bucket. Links are confirmed on the full
shingle sets, in groups that are cut into blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import components, saved, schema
from vinilo.llm.wordarrays import Words, mixed, positions, slices

BAND_VALUES = 5
MISS = 1e-5
BLOCK_DOCUMENTS = 1024
BLOCK_SHINGLES = 500_000
SLICE_BYTES = 2_000_000
_SHORT = np.uint64(0x9E3779B97F4A7C15)


def band_count(percent: int, values: int = BAND_VALUES, miss: float = MISS) -> int:
    """Bands that leave a pair just at the threshold unseen with a chance of ``miss`` at most."""
    agree = (percent / 100) ** values
    return 1 if agree >= 1 else math.ceil(math.log(miss) / math.log1p(-agree))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles, and how many each document has; repeats are still there.

    A document of fewer words than ``width`` has its whole sequence as one.
    """
    h = words.hashes()
    count = np.where(words.count >= width, words.count - width + 1, np.minimum(words.count, 1))
    at = positions(count, words.first[:-1])
    length = np.repeat(np.minimum(words.count, width), count)
    found = np.zeros(len(at), np.uint64)
    padded = np.concatenate([h, np.zeros(width, np.uint64)])
    for j in range(width):
        word = np.where(j < length, padded[at + j], _SHORT)
        found = mixed(found * np.uint64(3) + word)
    return found, count


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    found, count = shingles(words, width)
    ends = np.cumsum(count)
    return [np.unique(found[e - c : e]) for c, e in zip(count, ends)]


def _signatures(width: int, bands: int):
    evaluations = -(-bands * BAND_VALUES // 2)
    keys = mixed(np.arange(1, 2 * evaluations + 1, dtype=np.uint64) * _SHORT)
    factors, terms = keys[::2] | np.uint64(1), keys[1::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            words = Words(batch.column("text"), lower=True)
            found, count = shingles(words, width)
            ends = np.cumsum(count)
            starts = (ends - count)[count > 0]
            full = np.flatnonzero(count)
            sizes = np.zeros(words.documents, np.int64)
            digests: list[bytes | None] = [None] * words.documents
            for d in full:
                own = np.unique(found[ends[d] - count[d] : ends[d]])
                sizes[d] = len(own)
                digests[d] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            keyed = np.zeros((len(full), bands), np.uint64)
            if len(full):
                values = np.empty((2 * evaluations, len(full)), np.uint64)
                for e in range(evaluations):
                    permuted = found * factors[e] + terms[e]
                    values[2 * e] = np.minimum.reduceat(permuted, starts)
                    values[2 * e + 1] = np.maximum.reduceat(permuted, starts)
                for b in range(bands):
                    key = np.full(len(full), b + 1, np.uint64)
                    for v in values[b * BAND_VALUES : (b + 1) * BAND_VALUES]:
                        key = mixed(key * np.uint64(3) + v)
                    keyed[:, b] = key
            ends_of_lists = np.concatenate([[0], np.cumsum((count > 0) * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(ends_of_lists), pa.array(keyed.ravel().view(np.int64))
                    ),
                ],
                ["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links (root, member) that connect just what the sets' similarities connect.

    Every set not reached yet is compared with all others at once, through the
    list of sets that hold each shingle; each set is expanded once.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), sizes)
    order = np.argsort(column, kind="stable")
    holders = row[order]
    ends = np.cumsum(np.bincount(column))
    begins = np.concatenate([[0], ends[:-1]])
    own_ends = np.cumsum(sizes)
    reached = np.zeros(n, bool)
    links = []
    for root in np.argsort(ids, kind="stable"):
        if reached[root]:
            continue
        reached[root] = True
        waiting = [root]
        while waiting:
            x = waiting.pop()
            own = column[own_ends[x] - sizes[x] : own_ends[x]]
            lists = positions(ends[own] - begins[own], begins[own])
            shared = np.bincount(holders[lists], minlength=n)
            near = 100 * shared >= percent * (sizes[x] + sizes - shared)
            new = np.flatnonzero(near & ~reached)
            reached[new] = True
            waiting.extend(new)
            links.extend((ids[root], ids[y]) for y in new if ids[y] != ids[root])
    return links


def _confirm(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("node").to_numpy()
        sets = []
        for batch in slices(iter(table.to_batches())):
            sets += shingle_sets(Words(batch.column("text"), lower=True), width)
        links = spanning_links(ids, sets, percent)
        return pa.table(
            {
                "a": pa.array([x for x, _ in links], pa.int64()),
                "b": pa.array([y for _, y in links], pa.int64()),
            }
        )

    return run


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    block: int = BLOCK_DOCUMENTS,
    miss: float = MISS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    Texts are lower-cased (A-Z). Documents whose sets of ``width``-word shingles
    have 100 * intersection >= percent * union are linked; component_id is the
    smallest doc_id that links reach. Texts that are null or without words have
    no shingles and no links. Rows with one doc_id are one document: a link of
    either row counts for both. A row with a null doc_id is linked with nothing,
    its component_id is null and it is kept. Empty tables give empty results.

    Equal sets are found by a 128-bit digest of the whole set, which a partial
    minimum brings together, however many copies there are. Bands then link the
    smallest id of each bucket to the others; what these links connect is a
    group, and every candidate pair lies inside one. Groups of more than
    ``block`` documents or BLOCK_SHINGLES shingles are cut into blocks, and every
    two blocks are compared in one task, which sends back links that span, not pairs.
    """
    bands = band_count(percent, miss=miss)
    signed = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
            _signatures(width, bands),
            schema("doc_id long, n_shingles long, digest binary, bands array<long>"),
        ),
        "signatures",
    )
    usable = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = usable.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.min("n_shingles").alias("_shingles")
    )
    banded = (
        usable.join(
            classes.select(F.col("digest").alias("_digest"), "node"),
            (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("node")),
        )
        .select("node", F.explode("bands").alias("key"))
        .distinct()
    )
    buckets = (
        banded.groupBy("key")
        .agg(F.min("node").alias("center"), F.max("node").alias("_last"))
        .filter("_last > center")
        .select("key", "center")
    )
    stars = banded.join(buckets, "key").filter("node <> center").select("center", "node")
    groups = components(stars, "center", "node")
    lengths = classes.groupBy("node").agg(F.sum("_shingles").alias("_shingles"))
    sizes = (
        groups.join(lengths, "node")
        .groupBy("root")
        .agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("_shingles") / BLOCK_SHINGLES)
            )
            .cast("int")
            .alias("_blocks")
        )
    )
    members = saved(groups.join(sizes, "root"), "members")
    placed = (
        docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text"))
        .join(members, "node")
        .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
        .withColumn(
            "_other",
            F.explode(
                F.expr(
                    "CASE WHEN _blocks = 1 THEN array(0) "
                    "ELSE filter(sequence(0, _blocks - 1), x -> x <> _own) END"
                )
            ),
        )
        .select(
            "root",
            F.least("_own", "_other").alias("i"),
            F.greatest("_own", "_other").alias("j"),
            "node",
            "text",
        )
    )
    links = (
        placed.groupBy("root", "i", "j")
        .applyInArrow(_confirm(width, percent), schema("a long, b long"))
        .distinct()
    )
    # Rows of one document with different sets tie their classes together.
    several = (
        usable.groupBy("doc_id")
        .agg(F.min("digest").alias("_low"), F.max("digest").alias("_high"))
        .filter("_low <> _high")
        .select("doc_id")
    )
    ties = (
        usable.select("doc_id", "digest")
        .join(several, "doc_id")
        .join(classes, "digest")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    roots = components(links.union(ties), "a", "b")
    labels = classes.join(roots, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("_label")
    )
    found = signed.join(labels, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_label", "doc_id")).alias("component_id"),
    )
    return found.withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    )
