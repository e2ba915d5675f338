"""Removal of byte strings that stand anywhere else, by prefix doubling.

Two suffixes that share their first ``LENGTH`` bytes get one rank. Ranks are names
of equal prefixes, which grow by pairs: a prefix is named by the rank of the
shorter one inside it and the piece at its end or in front. A suffix leaves as soon
as its rank is its own, or once it is past the threshold.

Not all suffixes start. Every window of ``LENGTH`` bytes has an anchor, the place
of the smallest hash among its first ``BLOCK`` places, which is the same in all
copies of the window. Windows of one anchor stand side by side and are ranked as
one block first, by the bytes that all windows of such a block share. A block whose
own bytes, from its first window to the end of its last, occur again is done. The
others are halved: the halves' windows share 64, then 32, ... bytes more, down to
single windows of ``LENGTH`` bytes. Of blocks with equal bytes one goes on, as a
partner for those that still differ. So every rank is taken over all documents, yet
a round holds only blocks at the ends of repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import saved, schema, unused
from vinilo.llm.repeats import sliding_minimum
from vinilo.llm.wordarrays import mixed, positions, powers, slices

LENGTH = 200
BLOCK = 128
GRAM = 16
_BASE = 0xD6E8FEB86659FD93 | 1
_LOW = np.uint64((1 << 31) - 1)
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
NEW = ("kept", "n_bytes", "n_removed", "n_spans")
ROW = ["doc_id", "text_hash", "anchor", "low", "high"]
CLASS = ["rank", "low", "high", "bytes_hash"]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins, with the end."""
    texts = texts.fill_null("") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    bounds = bounds.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH, block: int = BLOCK):
    """(text, anchor, first window, last window, shared-bytes hash) of each block of windows.

    Places count in ``raw``. The hash is that of the bytes from the anchor on which
    the windows of a full block have in common.
    """
    count = np.maximum(np.diff(bounds) - length + 1, 0)
    if not count.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers(_BASE, len(raw)), out=sums[1:])
    inverse = powers(pow(_BASE, -1, 1 << 64), len(raw))
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(raw) - GRAM + 1])
    # The smallest hash, the first of equal ones, with its place in the low bits.
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_minimum(keys, block) & _LOW).astype(np.int64)
    at = positions(count, bounds[:-1])
    text, anchor = np.repeat(np.arange(len(count)), count), least[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(at)) - 1
    anchor = anchor[first]
    shared = length - block + 1
    rank = mixed((sums[anchor + shared] - sums[anchor]) * inverse[anchor])
    return text[first], anchor, at[first], at[last], rank.view(np.int64)


def _blocks(length: int, block: int):
    """The blocks of each slice; low and high are how far windows begin before the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, bounds = _bytes_of(batch.column("text"))
            text, anchor, first, last, rank = anchors(raw, bounds, length, block)
            view, digest = memoryview(raw), xxhash.xxh3_128_digest
            own = b"".join([digest(view[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())])
            low, high = anchor - last, anchor - first
            halves = np.frombuffer(own, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)),
                    batch.column("text_hash").take(pa.array(text)),
                    pa.array((anchor - bounds[text]).astype(np.int32)),
                    pa.array(low.astype(np.int16)),
                    pa.array(high.astype(np.int16)),
                    pa.array(rank),
                    pa.array(halves[:, 0].copy()),
                    pa.array(halves[:, 1].copy()),
                ],
                [*ROW, "rank", "hash_1", "hash_2"],
            )

    return run


def _contexts(length: int):
    """The bytes of the wanted blocks of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            wanted = batch.column("wanted")
            count = wanted.value_lengths().to_numpy()
            text = np.repeat(np.arange(batch.num_rows), count)
            block = wanted.flatten()
            raw, bounds = _bytes_of(batch.column("text"))
            view = memoryview(raw)
            anchor, low, high = (
                block.field(i).to_numpy().astype(np.int64) for i in range(3)
            )
            begin = bounds[text] + anchor - high
            end = bounds[text] + anchor - low + length
            own = [bytes(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)),
                    batch.column("text_hash").take(pa.array(text)),
                    *(block.field(i) for i in range(5)),
                    pa.array(own, pa.binary()),
                ],
                [*ROW, "partner", "rank", "own"],
            )

    return run


def _settle(blocks: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash, span) of blocks whose bytes stand in another place too."""
    again = classes.filter("n > 1").select(*CLASS)
    found = blocks.filter("NOT partner").join(again, CLASS, "left_semi")
    start, stop = F.col("anchor") - F.col("high"), F.col("anchor") - F.col("low") + length
    return found.select(
        "doc_id", "text_hash", F.shiftleft(start.cast("long"), 32).bitwiseOR(stop.cast("long")).alias("span")
    )


def _classes(blocks: DataFrame, *more: str) -> DataFrame:
    """Blocks of equal bytes under one rank: how many, and one of them."""
    one = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "anchor", *more)]
    return blocks.groupBy(*CLASS).agg(
        F.count(F.lit(1)).alias("n"), F.max("partner").alias("partner"), *one
    )


def _unsettled(classes: DataFrame) -> DataFrame:
    """One block of each class under a rank that several share, some of them still open."""
    open_ones = F.sum(F.when((F.col("n") == 1) & ~F.col("partner"), 1).otherwise(0))
    shared = (
        classes.groupBy("rank")
        .agg(F.count(F.lit(1)).alias("_k"), open_ones.alias("_open"))
        .filter("_k > 1 AND _open > 0")
        .select("rank")
    )
    return classes.join(shared, "rank", "left_semi").withColumn(
        "partner", (F.col("n") > 1) | F.col("partner")
    )


def _halved(blocks: DataFrame, width: int, length: int) -> DataFrame:
    """Blocks of ``width`` places cut into two, each ranked by the pair (rank before, piece it gains)."""
    half = width // 2
    shared = length + 1 - width  # bytes that all windows of a block have in common
    base = (F.floor(F.col("low") / width) * width).cast("int")
    at = F.col("high") - base  # of the shared bytes in the block's own
    sides = []
    for side in (0, 1):
        low = F.greatest(F.col("low").cast("int"), base + side * half)
        high = F.least(F.col("high").cast("int"), base + side * half + half - 1)
        piece = F.substring("own", at + 1 + shared if side == 0 else at + 1 - half, F.lit(half))
        name = F.concat(F.col("rank"), F.lit(bytes([side])), piece)
        own = F.substring("own", F.col("high") - high + 1, high - low + length)
        sides.append(
            F.when(
                low <= high,
                F.struct(
                    low.alias("low"), high.alias("high"), F.unhex(F.md5(name)).alias("rank"), own.alias("own")
                ),
            )
        )
    return (
        blocks.withColumn("_half", F.explode(F.array(*sides)))
        .filter("_half IS NOT NULL")
        .select("doc_id", "text_hash", "anchor", "partner", "_half.*")
        .withColumn("bytes_hash", F.unhex(F.md5("own")))
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, spans): stretches of each text that stand elsewhere too.

    A span has its first byte in the upper and the one behind its last in the lower
    32 bits. Rows of equal id and text share their spans, and each is a copy of the
    others. Texts without spans have no row.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text"),
    )
    fields = "doc_id long, text_hash long, anchor int, low short, high short"
    all_blocks = texts.mapInArrow(
        _blocks(length, block), schema(f"{fields}, rank long, hash_1 long, hash_2 long")
    )
    shared = all_blocks.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rank")
    # Merged: both sides are dealt by the rank, and a rank with many blocks is split.
    blocks = saved(
        all_blocks.join(shared.hint("merge"), "rank", "left_semi").select(
            *ROW,
            F.lit(False).alias("partner"),
            F.col("rank"),
            F.struct("hash_1", "hash_2").alias("bytes_hash"),
        ),
        "blocks",
    )
    found = []
    classes = saved(_classes(blocks), "classes")
    found.append(saved(_settle(blocks, classes, length), "spans"))
    wanted = (
        _unsettled(classes)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("anchor", "low", "high", "partner", "rank")).alias("wanted"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    needed = texts.join(
        wanted.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}).hint("merge"), same
    ).select("doc_id", "text_hash", "wanted", "text")
    rows = needed.mapInArrow(
        _contexts(length), schema(f"{fields}, partner boolean, rank long, own binary")
    ).withColumn("rank", F.col("rank").cast("string").cast("binary"))
    width = block
    while width > 1:
        blocks = saved(_halved(rows, width, length), "blocks")
        width //= 2
        classes = saved(_classes(blocks, "own"), "classes")
        found.append(saved(_settle(blocks, classes, length), "spans"))
        rows = _unsettled(classes).select(*ROW, "partner", "rank", "own")
        if width > 1 and rows.isEmpty():
            break
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans"))


def cut_bytes(raw: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left, how many bytes went, and in how many stretches."""
    spans = np.sort(spans)
    start, stop = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    begins = np.ones(len(spans), bool)
    begins[1:] = start[1:] > stop[:-1]
    first = np.flatnonzero(begins)
    start, stop = start[first], stop[np.append(first[1:], len(spans)) - 1]
    edges = np.stack([np.append(0, stop), np.append(start, len(raw))], 1).tolist()
    return b"".join([raw[a:b] for a, b in edges]), int((stop - start).sum()), len(first)


def _cut(text: str, spans: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rows = []
            for own, cuts in zip(batch.column(text), batch.column(spans)):
                raw = own.as_buffer().to_pybytes() if own.is_valid else b""
                kept, gone, n = raw, 0, 0
                if cuts.is_valid:
                    kept, gone, n = cut_bytes(raw, cuts.values.to_numpy())
                rows.append((kept, len(raw), gone, n))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], *made], [*batch.schema.names[:-2], *NEW]
            )

    return run


def remove_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, block: int = BLOCK, carry: list[str] | None = None
) -> DataFrame:
    """``carry`` columns of ``docs`` (by default all) with kept, n_bytes, n_removed and n_spans.

    Bytes go if a string of ``length`` bytes over them also starts anywhere else,
    in the same text too; matches never cross texts, and are those of the input.
    All copies of a string go. ``kept`` is binary, since a cut may part a character.
    Null and empty texts have no bytes, texts shorter than ``length`` stay whole, and an
    empty table stays empty. Of equal rows each is a copy of the others. A text has to
    fit into a task's memory; one of equal bytes has a block per byte. ``block`` is a
    power of two, and the anchor's 16 bytes must fit into the shared ones. Columns with
    the names of new ones are replaced.
    """
    if block & (block - 1) or length - block + 1 < GRAM:
        raise ValueError(f"block must be a power of two below length - {GRAM}, not {block}")
    keep = [c for c in (carry or docs.columns) if c.lower() not in NEW]
    spans = saved(repeated_spans(docs, length, block), "spans").toDF("_id", "_hash", "_spans")
    text, cuts = unused(keep, "text"), unused(keep, "spans")
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.col("text").alias("_text"),
        F.col("doc_id").cast("long").alias("_doc"),
        F.xxhash64("text").alias("_own"),
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash"))
    joined = own.join(spans.hint("merge"), same, "left").select(
        *[F.col("_row").getField(c).alias(c) for c in keep],
        F.col("_text").alias(text),
        F.col("_spans").alias(cuts),
    )
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in joined.schema.fields[:-2])
    return joined.mapInArrow(
        _cut(text, cuts),
        schema(f"{fields}kept binary, n_bytes long, n_removed long, n_spans long"),
    )
