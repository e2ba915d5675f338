"""Removal of repeated word sequences by prefix-partitioned suffix trees.

Every word starts a suffix. Only nodes at least ``window`` words deep matter
here, so the trees are cut at that depth, where a node is named by the hash of
the ``window`` words on the path to it. Suffixes are dealt to groups by a prefix
of the sequence that ends in their window: of its ``seed``-word prefixes, the
one with the smallest hash. Neighbouring suffixes mostly share it, so they
travel as one run and pay for their position once; equal windows share it too,
so each node lies in one group. The number of groups follows the size of the
corpus. Windows are counted per group first; a group that a frequent prefix makes
large is dealt further by the whole path, which keeps equal windows together. Nodes with two or more suffixes are the repeats; runs of them are the
maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import saved, schema, unused
from vinilo.llm.wordarrays import Words, mixed, positions, sequence_hashes, slices

WINDOW = 20
SEED_WORDS = 6
GROUP_BYTES = 12_000_000
MOST_OF_MEAN = 1.5
_NO_ID = np.iinfo(np.int64).max
_RUNS = "part long, ids binary, text_hashes binary, run_doc binary, run_start binary, run_length binary, nodes binary"
_SPANS = "doc_id long, text_hash long, starts array<int>, stops array<int>"


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i + width] for every i with so many left."""
    reach, low = 1, values
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def later_occurrences(nodes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the same node has an occurrence of smaller (id, start)."""
    later = np.zeros(len(nodes), bool)
    order = np.argsort(nodes)
    ranked = nodes[order]
    same = ranked[1:] == ranked[:-1]
    shared = np.zeros(len(nodes), bool)
    shared[1:] |= same
    shared[:-1] |= same
    among = order[shared]
    if len(among):
        among = among[np.lexsort((starts[among], ids[among], nodes[among]))]
        first = np.ones(len(among), bool)
        first[1:] = nodes[among[1:]] != nodes[among[:-1]]
        head = among[np.maximum.accumulate(np.where(first, np.arange(len(among)), 0))]
        later[among] = (ids[among] > ids[head]) | (starts[among] > starts[head])
    return later


def _runs(breaks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches between breaks (True where one begins)."""
    begin = np.flatnonzero(breaks)
    return begin, np.diff(np.append(begin, n))


def _broken(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Where a start does not follow the one before in the same document."""
    breaks = np.ones(len(doc), bool)
    breaks[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    return breaks


def _packed(part, words_ids, text_hashes, doc, start, length, nodes) -> dict:
    there, local = np.unique(doc, return_inverse=True)
    return {
        "part": part,
        "ids": words_ids[there].tobytes(),
        "text_hashes": text_hashes[there].tobytes(),
        "run_doc": local.astype(np.int32).tobytes(),
        "run_start": start.astype(np.int32).tobytes(),
        "run_length": length.astype(np.int32).tobytes(),
        "nodes": nodes.tobytes(),
    }


def _windows(batches: Iterator[pa.RecordBatch], window: int, seed: int):
    """Of each slice the ids and hashes of its texts, and of its windows the document,
    start, key (their prefix of smallest hash), node, and whether it occurs earlier in the slice."""
    width = window - seed + 1
    for batch in slices(batches):
        ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        batch, ids = batch.take(pa.array(order)), ids[order]
        text_hashes = batch.column("text_hash").to_numpy()
        words = Words(batch.column("text"))
        count = np.maximum(words.count - window + 1, 0)
        if not count.sum():
            continue
        at = positions(count, words.first[:-1])
        doc = np.repeat(np.arange(words.documents), count)
        hashes = words.hashes()
        grams = sequence_hashes(hashes, np.arange(len(hashes) - seed + 1), seed)
        key = sliding_minimum(grams, width)[at]
        nodes = sequence_hashes(hashes, at, window)
        start = at - words.first[doc]
        yield ids, text_hashes, doc, start, key, nodes, later_occurrences(nodes, ids[doc], start)


def _part_of(key: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(key) % np.uint64(parts)).astype(np.int64)


def _count_windows(parts: int, window: int, seed: int):
    """How many windows a task's slices send to each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(parts, np.int64)
        for *_, key, _, later in _windows(batches, window, seed):
            total += np.bincount(_part_of(key[~later], parts), minlength=parts)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"part": some, "n": total[some]})

    return run


def _splits(narrow: DataFrame, parts: int, window: int, seed: int) -> np.ndarray:
    """Into how many groups each part goes: more than one if it has far more windows than the mean.

    There is a number for each GROUP_BYTES of the corpus, and at most ``parts`` groups more.
    """
    splits = np.ones(parts, np.int64)
    if parts > 1:
        counted = narrow.mapInArrow(_count_windows(parts, window, seed), schema("part long, n long"))
        counts = saved(counted.groupBy("part").agg(F.sum("n").alias("n")), "windows")
        mean = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] / parts
        for row in counts.filter(F.col("n") > MOST_OF_MEAN * mean).collect():
            splits[row["part"]] = -(-row["n"] // max(1, int(mean)))
    return splits


def _deal(splits: np.ndarray, window: int, seed: int):
    parts, groups = len(splits), int(splits.sum())
    group_of = np.cumsum(splits) - splits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, text_hashes, doc, start, key, nodes, later in _windows(batches, window, seed):
            # What occurs earlier in this slice needs no further look.
            rows = []
            if later.any():
                d, s = doc[later], start[later]
                begin, length = _runs(_broken(d, s), len(d))
                rows.append(
                    _packed(
                        -1 - int(nodes[0] % np.uint64(groups)),
                        ids,
                        text_hashes,
                        d[begin],
                        s[begin],
                        length + window - 1,
                        np.zeros(0, np.uint64),
                    )
                )
            doc, start, key, nodes = doc[~later], start[~later], key[~later], nodes[~later]
            part = _part_of(key, parts)
            split = (mixed(nodes) % splits[part].view(np.uint64)).astype(np.int64)
            breaks = _broken(doc, start)
            breaks[1:] |= (key[1:] != key[:-1]) | (split[1:] != split[:-1])
            begin, length = _runs(breaks, len(doc))
            part = (group_of[part] + split)[begin]
            order = np.argsort(part, kind="stable")
            begin, length, part = begin[order], length[order], part[order]
            nodes = nodes[positions(length, begin)]
            ends = np.cumsum(length)
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(part))):
                own = begin[a:b]
                rows.append(
                    _packed(
                        int(part[a]),
                        ids,
                        text_hashes,
                        doc[own],
                        start[own],
                        length[a:b],
                        nodes[ends[a] - length[a] : ends[b - 1]],
                    )
                )
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[at : at + 64], schema=_RUN_SCHEMA)

    return run


_RUN_SCHEMA = pa.schema(
    [("part", pa.int64())]
    + [
        (c, pa.binary())
        for c in ("ids", "text_hashes", "run_doc", "run_start", "run_length", "nodes")
    ]
)


def _gather(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]


def _packed_spans(ids, text_hashes, doc, start, stop, buckets: int) -> pa.Table:
    """Spans in one row per bucket of documents."""
    spans = np.stack([ids[doc], text_hashes[doc], start, stop]).astype(np.int64)
    owner = mixed((spans[0] ^ spans[1]).view(np.uint64)) % np.uint64(buckets)
    order = np.argsort(owner, kind="stable")
    owner, spans = owner[order], spans[:, order]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
    blobs = [
        spans[:, a:b].tobytes() for a, b in zip(first, np.append(first[1:], len(owner)))
    ]
    return pa.table(
        {"bucket": pa.array(owner[first].astype(np.int64)), "spans": pa.array(blobs, pa.binary())}
    )


def _by_document(table: pa.Table) -> pa.Table:
    """The spans of a bucket in one row per document, overlapping ones joined."""
    ids, text_hashes, start, stop = np.concatenate(
        [x.reshape(4, -1) for x in _gather(table, "spans", np.int64)], axis=1
    )
    order = np.lexsort((start, text_hashes, ids))
    ids, text_hashes, start, stop = (x[order] for x in (ids, text_hashes, start, stop))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (text_hashes[1:] != text_hashes[:-1])
    # Ends so far within the document: stops grow past those of earlier documents.
    document = np.cumsum(new)
    far = np.int64(stop.max() + 1)
    reach = np.maximum.accumulate(document * far + stop) - document * far
    breaks = new.copy()
    breaks[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(breaks)
    ends = reach[np.append(begin[1:], len(ids)) - 1]
    owner = begin[new[begin]]
    offsets = np.append(np.searchsorted(begin, owner), len(begin)).astype(np.int32)
    return pa.Table.from_arrays(
        [
            pa.array(ids[owner], mask=ids[owner] == _NO_ID),
            pa.array(text_hashes[owner]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(start[begin].astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(ends.astype(np.int32))),
        ],
        schema=_SPAN_SCHEMA,
    )


_SPAN_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("starts", pa.list_(pa.int32())),
        ("stops", pa.list_(pa.int32())),
    ]
)


def _subtree(window: int, buckets: int):
    """Spans of a group's repeated windows, each but its first occurrence."""

    def run(table: pa.Table) -> pa.Table:
        ids = _gather(table, "ids", np.int64)
        ahead = np.cumsum([0] + [len(x) for x in ids])
        doc = np.concatenate(
            [x + a for x, a in zip(_gather(table, "run_doc", np.int32), ahead)]
        )
        ids = np.concatenate(ids)
        text_hashes = np.concatenate(_gather(table, "text_hashes", np.int64))
        start = np.concatenate(_gather(table, "run_start", np.int32)).astype(np.int64)
        length = np.concatenate(_gather(table, "run_length", np.int32)).astype(np.int64)
        if table.column("part")[0].as_py() < 0:
            return _packed_spans(ids, text_hashes, doc, start, start + length, buckets)
        nodes = np.concatenate(_gather(table, "nodes", np.uint64))
        doc, start = np.repeat(doc, length), positions(length, start)
        later = later_occurrences(nodes, ids[doc], start)
        doc, start = doc[later], start[later]
        begin, length = _runs(_broken(doc, start), len(doc))
        doc, start = doc[begin], start[begin]
        return _packed_spans(ids, text_hashes, doc, start, start + length + window - 1, buckets)

    return run


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED_WORDS, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """(doc_id, text_hash, starts, stops): word ranges that repeat an earlier window.

    Earlier means a smaller doc_id, or the same doc_id and an earlier start; a
    null doc_id comes last. A document is known by doc_id and the hash of its
    text, so rows that share a doc_id are told apart unless equal, and equal
    rows get equal ranges. Documents without repeats have no row.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text"),
    )
    size = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts, seed = max(1, -(-size // group_bytes)), min(seed, window)
    splits = _splits(narrow, parts, window, seed)
    dealt = narrow.mapInArrow(_deal(splits, window, seed), schema(_RUNS))
    found = dealt.groupBy("part").applyInArrow(
        _subtree(window, parts), schema("bucket long, spans binary")
    )
    return found.groupBy("bucket").applyInArrow(_by_document, schema(_SPANS))


def cut_words(text: bytes, starts: list[int], stops: list[int], layout: bool) -> tuple:
    """Text without the words of the ranges, its number of words, and of words removed.

    With ``layout`` the kept words keep their spacing, else one space joins them.
    """
    words = text.split()
    if not starts:
        return (text if layout else b" ".join(words)), len(words), 0
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, starts, 1)
    np.add.at(gone, stops, -1)
    keep = np.cumsum(gone)[:-1] == 0
    if layout:
        own = Words(pa.array([text.decode()]))
        follows = np.append(own.start[1:], len(text))
        kept = text[: own.start[0]] + b"".join(
            text[own.start[i] : follows[i]] for i in np.flatnonzero(keep)
        )
    else:
        kept = b" ".join([w for w, k in zip(words, keep) if k])
    return kept, len(words), int((~keep).sum())


def _cut(layout: bool, text_column: str, starts_column: str, stops_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            starts, stops = (
                batch.column(c).to_pylist() for c in (starts_column, stops_column)
            )
            texts, words, removed = [], [], []
            for text, a, b in zip(batch.column(text_column), starts, stops):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                kept, n, gone = cut_words(raw, a or [], b or [], layout)
                texts.append(kept.decode() if text.is_valid else None)
                words.append(n)
                removed.append(gone)
            names = batch.schema.names[:-3]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(texts, pa.string()), pa.array(words), pa.array(removed)],
                [*names, "kept_text", "n_words", "n_removed"],
            )

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, layout: bool = False, carry: list[str] | None = None
) -> DataFrame:
    """``docs`` with kept_text, n_words and n_removed.

    A word goes if a window of ``window`` words over it also starts earlier;
    windows are those of the input. Null texts stay null with no words; texts
    shorter than the window, and empty tables, stay as they are. ``carry`` names
    the columns of ``docs`` to return, by default all but the new ones.
    """
    new = ("kept_text", "n_words", "n_removed")
    keep = [c for c in (carry or docs.columns) if c.lower() not in new]
    spans = saved(repeated_spans(docs, window), "spans").toDF("_id", "_hash", "_starts", "_stops")
    text = unused(keep, "text")
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.col("text").alias("_text"),
        F.col("doc_id").cast("long").alias("_doc"),
        F.xxhash64("text").alias("_own"),
    )
    # Merged at every size: spans have no bound that would let them be broadcast.
    joined = own.join(
        spans.hint("merge"), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash")), "left"
    ).select(
        *[F.col("_row").getField(c).alias(c) for c in keep],
        F.col("_text").alias(text),
        F.col("_starts").alias(unused(keep, "starts")),
        F.col("_stops").alias(unused(keep, "stops")),
    )
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in joined.schema.fields[:-3])
    return joined.mapInArrow(
        _cut(layout, *joined.columns[-3:]),
        schema(f"{fields}kept_text string, n_words long, n_removed long"),
    )
