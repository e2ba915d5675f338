"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a sequence of words and one end, read in order. Frequent words, the end and
"another word" have paths of bits in a Huffman code. Predictors keep counts of zeros
and ones: of the code's node in the group (such as a language) that the text so far is
likeliest in, after the hash of the word before, after that of the two before, and in
the text itself so far. A mixer adds their log odds with weights gated by how well the
contexts before are known, a table refines the mixed probability, and the bits'
probabilities multiply to that of the text. Weights, table and the text's own counts
are learned as the text is read. No group is told.

Another word is spelled byte by byte, bit by bit, and closed by a space, by the same
means over contexts within the word: the byte before, the two and the three before,
and the whole word so far. Its probability is its count plus the spelled probability
times the number of words seen once, over the like sum; this is taken once over all,
and again, with the former in the place of the spelling, over the training rows of
each group, and averaged over the groups as they are likely at that place.

The corpus is gathered as distinct words with counts, per slice of documents and then
per part of the vocabulary; contexts before a word in tables of fixed size.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import saved, schema
from vinilo.llm.wordarrays import _BASE, _BYTE_VALUE, Words, mixed, positions, range_hashes, slices

TABLE_BITS = (16, 18, 18, 20)
PREDICTORS = len(TABLE_BITS)
PRIOR = 0.4
GATES = 64
REFINE_STEPS = 32
STRETCH_LIMIT = 8.0
BATCH = 1 << 15
RATE = 0.02
SLICE_BYTES = 8_000_000
PART_BYTES = 12_000_000
MOST_GROUPS = 8
MOST_CODED = 1 << 16
COUNT_STEPS = 512
CONTEXT_BITS = 22
START_WEIGHTS = (0.8, 0.35, 0.35, 0.12)
OWN_SLOTS = 16
CONTEXT_GATES = 16
BLOCK = 16
ONLINE_RATE = 0.03
TOKENS_AT_ONCE = 1 << 18
TEXTS_AT_ONCE = 384
LINE_BITS = 5
COUNTED_AT_ONCE = 1 << 12
COUNT_PARTS = 4
REFINE_PRIOR = 64.0
BASE_PRIOR = 0.1
_SALT = np.uint64(0x9E3779B97F4A7C15)
_SALT_32 = np.uint32(0x9E3779B1)
_SALTS = mixed(np.arange(1, 4, dtype=np.uint64) * _SALT)


# Spelling: one entry per byte of the words and per closing space


def taken(values: np.ndarray, at: np.ndarray, axis: int | None = None) -> np.ndarray:
    """``take`` of places that are known to be inside, which need no check."""
    return values.take(at, axis, mode="clip")


def spelled(data: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """(word, byte, contexts) of every byte of the words, each closed by a space."""
    count = stop - start + 1
    at = positions(count, start)
    word = np.repeat(np.arange(len(start)), count)
    first, closing = start[word], at == stop[word]
    byte = np.where(closing, 0x20, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0x20)
    padded = np.concatenate([np.zeros(3, np.uint8), data]).astype(np.uint64)

    def back(k: int) -> np.ndarray:
        return np.where(at - k >= first, padded[at + 3 - k] + np.uint64(1), np.uint64(0))

    one, two, three = back(1), back(2), back(3)
    pair = one * np.uint64(257) + two
    whole = range_hashes(_BYTE_VALUE[data], first, at, _BASE) if len(data) else np.zeros(len(at), np.uint64)
    contexts = [
        mixed(one + _SALTS[0]),
        mixed(pair + _SALTS[1]),
        mixed(pair * np.uint64(257) + three + _SALTS[2]),
        whole,
    ]
    return word, byte.astype(np.uint64), contexts


def bits(byte: np.ndarray, contexts: list[np.ndarray]) -> Iterator[tuple]:
    """(position of the bit, its value, table slots of the predictors) for the 8 bits."""
    node = np.ones(len(byte), np.uint64)
    for b in range(7, -1, -1):
        value, salted = (byte >> np.uint64(b)) & np.uint64(1), node * _SALT
        slots = [
            (((c ^ salted) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - t)).view(np.int64)
            for c, t in zip(contexts, TABLE_BITS)
        ]
        yield 7 - b, value.astype(np.float32), slots
        node = (node << np.uint64(1)) | value


# The model


@dataclass
class Model:
    """Counts of zeros and ones by predictor, weights by gate, the refining table."""

    zeros: list[np.ndarray]
    ones: list[np.ndarray]
    weights: np.ndarray | None = None
    refined: np.ndarray | None = None

    def without_own(self, slots, value):
        """Log odds of the predictors and the gate, without one of the own tokens."""
        inputs = []
        for p, at in enumerate(slots):
            zero, one = taken(self.zeros[p], at) - (1 - value), taken(self.ones[p], at) - value
            inputs.append(np.log((one + PRIOR) / (zero + PRIOR)))
            known = zero + one
        return np.clip(inputs, -STRETCH_LIMIT, STRETCH_LIMIT), gates(known)

    def speller(self) -> "Speller":
        odds = [
            np.clip(np.log((o + PRIOR) / (z + PRIOR)), -STRETCH_LIMIT, STRETCH_LIMIT)
            for z, o in zip(self.zeros, self.ones)
        ]
        return Speller(odds, gates(self.zeros[-1] + self.ones[-1]), self.weights, self.refined)


def gates(known: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(known + 1).astype(np.int8), GATES // 8 - 1)


@dataclass
class Speller:
    """The trained model, with the log odds of each slot worked out."""

    odds: list[np.ndarray]
    gate: np.ndarray
    weights: np.ndarray
    refined: np.ndarray

    def word_scores(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """log10 of the probability of each word data[start:stop]."""
        scores = np.zeros(len(start))
        weights = self.weights.astype(np.float32)
        refined = self.refined.astype(np.float32).ravel()
        for lo, hi in pieces(stop - start + 1):
            word, byte, contexts = spelled(data, start[lo:hi], stop[lo:hi])
            total = np.zeros(len(byte))
            for bit, value, slots in bits(byte, contexts):
                gate = taken(self.gate, slots[-1]).astype(np.int64) * 8 + bit
                used = taken(weights, gate, 0)
                odds = used[:, 0] * taken(self.odds[0], slots[0])
                for p in range(1, PREDICTORS):
                    odds += used[:, p] * taken(self.odds[p], slots[p])
                np.clip(odds, -STRETCH_LIMIT, STRETCH_LIMIT, out=odds)
                # The mean of the mixed and the refined probability of a one.
                p = (1 / (1 + np.exp(-odds)) + taken(refined, gate * REFINE_STEPS + steps(odds))) / 2
                # The distance from what did not come is the probability of what did.
                total += np.log(np.abs(p - (1 - value)))
            scores[lo:hi] = np.bincount(word, total, minlength=hi - lo)
        return scores / math.log(10)


def steps(odds: np.ndarray) -> np.ndarray:
    return ((odds + STRETCH_LIMIT) * ((REFINE_STEPS - 1) / (2 * STRETCH_LIMIT)) + 0.5).astype(np.int32)


def pieces(sizes: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Ranges of words with about ``most`` bytes together, or a single word."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, "right")))
        yield lo, hi
        lo = hi


# Gathering: distinct words per slice, then counts per group of words


_SLICE = "slice binary, ids binary, id_null binary, held_out binary, n_words binary, words binary, lengths binary, trained binary, sequence binary"
_REQUEST = "part long, slice binary, size long, trained binary, words binary, lengths binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "long": pa.int64()}
    pairs = [f.split() for f in ddl.split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def _gathered(groups: int):
    """One row per slice of documents: its distinct words and who uses them how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            yield _slice(batch, groups)

    return run


def _slice(batch: pa.RecordBatch, groups: int) -> pa.RecordBatch:
    held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
    group = batch.column("group").to_numpy().astype(np.int64)
    words = Words(batch.column("text"), lower=True)
    at, inverse, times = distinct(words.hashes())
    # Frequent words get small numbers, which pack well.
    order = np.argsort(-times, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at, inverse = at[order], place[inverse]
    key = np.where(held, groups, group)[words.document] * len(at)
    key += inverse
    # What is held out counts in a group of its own, which is left out.
    trained = np.bincount(key, minlength=len(at) * (groups + 1))[: len(at) * groups]
    ids = batch.column("doc_id")
    lengths = (words.stop - words.start)[at]
    row = {
        "ids": ids.fill_null(0).to_numpy().astype(np.int64).tobytes(),
        "id_null": ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
        "held_out": held.astype(np.uint8).tobytes(),
        "n_words": words.count.astype(np.int32).tobytes(),
        "words": words.data[positions(lengths, words.start[at])].tobytes(),
        "lengths": lengths.astype(np.int32).tobytes(),
        "trained": _small(trained),
        "sequence": _planes(inverse),
    }
    name = hashlib.blake2b(row["ids"] + row["words"], digest_size=16)
    name.update(np.random.default_rng().bytes(16))
    return pa.RecordBatch.from_pylist([row | {"slice": name.digest()}], schema=_arrow(_SLICE))


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In order of the hashes, a place where each stands, the number of each hash, and the times.

    ``np.unique`` asks for the first place and sorts several times slower for that.
    """
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return order[first], inverse, np.diff(first, append=len(order))


def _small(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _numbers(batch, column: str, n: int, row: int = 0) -> np.ndarray:
    """The ``n`` numbers that ``_small`` has packed."""
    raw = batch.column(column)[row].as_buffer()
    return np.frombuffer(raw, f"u{max(1, raw.size // max(n, 1))}").astype(np.int64)


def _array(batch, column: str, kind, row: int = 0) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), kind)


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as all their lowest bytes, then all the next; the high ones pack to little."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of words that stand one after another, as of ``Words.hashes``."""
    stop = np.cumsum(lengths, dtype=np.int64)
    return range_hashes(_BYTE_VALUE[data], stop - lengths, stop, _BASE)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(hashes) % np.uint64(parts)).astype(np.int64)


def _requests(parts: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, lengths = _array(batch, "words", np.uint8, r), _array(batch, "lengths", np.int32, r)
                found = _hashes(data, lengths)
                part = part_of(found, parts)
                order = np.argsort(part, kind="stable")
                starts = np.cumsum(lengths) - lengths
                trained = _numbers(batch, "trained", len(found) * groups, r).reshape(groups, -1)
                ends = np.cumsum(np.bincount(part, minlength=parts))
                rows = []
                for p in range(parts):
                    own = order[ends[p - 1] if p else 0 : ends[p]]
                    if len(own):
                        rows.append(
                            {
                                "part": p,
                                "slice": batch.column("slice")[r].as_py(),
                                "size": len(own),
                                "trained": _small(trained[:, own]),
                                "words": data[positions(lengths[own], starts[own])].tobytes(),
                                "lengths": _small(lengths[own]),
                            }
                        )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow(_REQUEST))

    return run


_GROUP = "part long, slice binary, size long, counts binary, words binary, lengths binary"


def _totals(groups: int):
    """Counts of a part's words, as answers to its slices and as one list (slice null)."""

    def run(table: pa.Table) -> pa.Table:
        rows_in = range(table.num_rows)
        sizes = table.column("size").to_pylist()
        trained = [
            _numbers(table, "trained", n * groups, r).reshape(groups, -1)
            for r, n in enumerate(sizes)
        ]
        trained = np.concatenate(trained, axis=1)
        lengths = np.concatenate([_numbers(table, "lengths", n, r) for r, n in enumerate(sizes)])
        data = np.concatenate([_array(table, "words", np.uint8, r) for r in rows_in])
        at, inverse, _ = distinct(_hashes(data, lengths))
        totals = np.stack(
            [np.bincount(inverse, trained[g], minlength=len(at)) for g in range(groups)]
        ).astype(np.int64)
        answers, done = totals[:, inverse], 0
        part = table.column("part")[0].as_py()
        rows = []
        for r, size in enumerate(sizes):
            rows.append(
                {
                    "part": part,
                    "slice": table.column("slice")[r].as_py(),
                    "counts": _small(answers[:, done : done + size]),
                    "size": size,
                }
            )
            done += size
        learned = totals.sum(0) > 0
        at, totals = at[learned], totals[:, learned].T
        starts = np.cumsum(lengths) - lengths
        rows.append(
            {
                "part": part,
                "counts": totals.tobytes(),
                "words": data[positions(lengths[at], starts[at])].tobytes(),
                "lengths": lengths[at].astype(np.int32).tobytes(),
            }
        )
        return pa.Table.from_pylist(rows, schema=_arrow(_GROUP))

    return run


# Training of the speller: sums over groups of words


_BLOB = pa.schema([("kind", pa.string()), ("i", pa.int64()), ("values", pa.binary())])


def _blobs(rows: list[tuple[str, int, np.ndarray]], kind=np.float64) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"kind": k, "i": i, "values": v.astype(kind).tobytes()} for k, i, v in rows],
        schema=_BLOB,
    )


def _word_lists(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            lengths = _array(batch, "lengths", np.int32, r)
            if len(lengths):
                counts = _array(batch, "counts", np.int64, r).reshape(len(lengths), -1)
                stop = np.cumsum(lengths, dtype=np.int64)
                yield _array(batch, "words", np.uint8, r), stop - lengths, stop, counts


def _chunks(table: np.ndarray) -> list[np.ndarray]:
    return np.split(table, max(1, len(table) >> 16))


def _count_bits():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(2 << t) for t in TABLE_BITS]
        for data, start, stop, counts in _word_lists(batches):
            every = counts.sum(1)
            for lo, hi in pieces(stop - start + 1, 1 << 20):
                word, byte, contexts = spelled(data, start[lo:hi], stop[lo:hi])
                times = every[lo:hi].take(word).astype(float)
                for _, value, slots in bits(byte, contexts):
                    turn = value.astype(np.int64)
                    for table, at in zip(tables, slots):
                        table += np.bincount(at * 2 + turn, times, minlength=len(table))
        for v in range(2):
            for p in range(PREDICTORS):
                parts = _chunks(tables[p][v::2])
                yield _blobs([(f"{v}{p}", i, x) for i, x in enumerate(parts) if x.any()])

    return run


def _add(table: pa.Table) -> pa.Table:
    values = [_array(table, "values", np.float64, r) for r in range(table.num_rows)]
    row = (table.column("kind")[0].as_py(), table.column("i")[0].as_py(), np.sum(values, 0))
    return pa.Table.from_batches([_blobs([row], np.float32)])


def _summed(df: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Sums over tasks of blobs of fixed number and size, which the tables' sizes bound."""
    kinds = "kind string, i long, values binary"
    rows = df.groupBy("kind", "i").applyInArrow(_add, schema(kinds)).collect()
    return {(r.kind, r.i): np.frombuffer(r["values"], np.float32) for r in rows}


def _mix_weights(send):
    """Weights and refining sums of one pass over a task's words, by stochastic gradient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*send.value)
        weights = np.full((GATES, PREDICTORS), 1 / PREDICTORS)
        seen = np.zeros((GATES, PREDICTORS))
        hits = np.zeros((2, GATES, REFINE_STEPS))
        for data, start, stop, counts in _word_lists(batches):
            every = counts.sum(1)
            for lo, hi in pieces(stop - start + 1, BATCH):
                word, byte, contexts = spelled(data, start[lo:hi], stop[lo:hi])
                times = every[lo:hi].take(word).astype(float)
                for bit, value, slots in bits(byte, contexts):
                    inputs, known = model.without_own(slots, value)
                    gate = known.astype(np.int64) * 8 + bit
                    used = taken(weights, gate, 0)
                    odds = sum(used[:, p] * x for p, x in enumerate(inputs))
                    odds = np.clip(odds, -STRETCH_LIMIT, STRETCH_LIMIT)
                    error = (value - 1 / (1 + np.exp(-odds))) * times
                    at = (gate * REFINE_STEPS + steps(odds)) * 2 + value.astype(np.int64)
                    pair = np.bincount(at, times, minlength=hits.size).reshape(GATES, -1, 2)
                    hits += pair.transpose(2, 0, 1)
                    total = pair.sum((1, 2))
                    for p in range(PREDICTORS):
                        step = np.bincount(gate, error * inputs[p], minlength=GATES)
                        weights[:, p] += RATE * step / np.maximum(total, 1)
                        seen[:, p] += total
        yield _blobs(
            [
                ("weights", 0, (weights * seen).ravel()),
                ("seen", 0, seen.ravel()),
                ("hits", 0, hits.ravel()),
            ]
        )

    return run


def train(words: DataFrame, ends: int) -> Speller:
    """The speller of a table of word lists (words, lengths, counts) and a number of ends.

    Its tables have fixed sizes, so what the driver adds up and sends out again
    does not grow with the corpus; every word of the corpus is counted.
    """
    spark = words.sparkSession
    kinds = schema("kind string, i long, values binary")
    sums = _summed(words.mapInArrow(_count_bits(), kinds))
    tables = []
    for v in range(2):
        row = []
        for p, t in enumerate(TABLE_BITS):
            chunks = _chunks(np.zeros(1 << t, np.float32))
            row.append(np.concatenate([sums.pop((f"{v}{p}", i), x) for i, x in enumerate(chunks)]))
        tables.append(row)
    # The end is a word of a single closing space.
    none = np.zeros(1, np.int64)
    _, byte, contexts = spelled(np.zeros(0, np.uint8), none, none)
    for _, value, slots in bits(byte, contexts):
        for p, at in enumerate(slots):
            tables[int(value[0])][p][at] += ends
    model = Model(*tables)
    send = spark.sparkContext.broadcast((model.zeros, model.ones))
    sums = _summed(words.mapInArrow(_mix_weights(send), kinds))
    shape = (GATES, PREDICTORS)
    seen = sums.get(("seen", 0), np.zeros(shape)).reshape(shape)
    weights = sums.get(("weights", 0), np.zeros(shape)).reshape(shape)
    model.weights = np.where(seen > 0, weights / np.maximum(seen, 1), 1 / PREDICTORS)
    hits = sums.get(("hits", 0), np.zeros((2, GATES, REFINE_STEPS))).reshape(2, GATES, REFINE_STEPS)
    centers = np.linspace(-STRETCH_LIMIT, STRETCH_LIMIT, REFINE_STEPS)
    prior = 1 / (1 + np.exp(-centers))
    model.refined = (hits[1] + 4 * prior) / (hits.sum(0) + 4)
    model.refined = np.clip(model.refined, 1e-6, 1 - 1e-6)
    return model.speller()


def _values(model) -> tuple:
    return tuple(getattr(model, f.name) for f in fields(model))


# The code of words: frequent ones, the end and "another word" as paths of bits


OTHER, END = 0, 1
_STARTS = np.uint64(1)  # stands for the word before the first


def count_step(counts: np.ndarray) -> np.ndarray:
    """Steps of a count, eight per doubling."""
    return np.minimum((8 * np.log2(np.maximum(counts, 1))).astype(np.int64), COUNT_STEPS - 1)


def least_coded(steps: np.ndarray) -> int:
    """The step from which words are coded: at most ``MOST_CODED`` words, none seen only once."""
    above = np.cumsum(steps[::-1])[::-1]
    return max(8, int(np.argmax(above <= MOST_CODED)) if (above <= MOST_CODED).any() else COUNT_STEPS)


def _coded(least: int):
    """Hashes and counts by group of the words from a step on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, start, stop, counts in _word_lists(batches):
            own = count_step(counts.sum(1)) >= least
            if own.any():
                hashes = range_hashes(_BYTE_VALUE[data], start[own], stop[own], _BASE)
                yield pa.RecordBatch.from_pylist(
                    [{"hashes": hashes.tobytes(), "counts": counts[own].tobytes()}],
                    schema=_arrow("hashes binary, counts binary"),
                )

    return run


def subtree_numbers(parent: np.ndarray) -> np.ndarray:
    """New numbers of nodes that come after their children, the root last and its entry unused."""
    depth, top = np.zeros(len(parent), np.int64), np.arange(len(parent))
    for node in range(len(parent) - 2, -1, -1):
        above = parent[node]
        depth[node] = depth[above] + 1
        if depth[node] % LINE_BITS:
            top[node] = top[above]
    number = np.empty(len(parent), np.int64)
    number[np.lexsort((depth, -top, depth // LINE_BITS))] = np.arange(len(parent))
    return number


@dataclass
class Code:
    """Huffman code with the zeros and ones that the training rows have at its nodes.

    Its symbols are OTHER, END and the coded words; ``symbols`` goes with ``hashes``,
    which are sorted. The path of symbol s is nodes[first[s]:first[s + 1]]. Nodes are
    numbered by subtrees ``LINE_BITS`` levels high, so that a path has few stretches.
    """

    hashes: np.ndarray
    symbols: np.ndarray
    first: np.ndarray
    nodes: np.ndarray
    turns: np.ndarray
    counts: np.ndarray
    odds: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, others, ends) -> "Code":
        """Of coded words with their counts by group, and the counts of OTHER and END."""
        order = np.argsort(hashes)
        leaves = np.concatenate([[others, ends], counts[order].reshape(-1, counts.shape[1])])
        size, groups = leaves.shape
        weights = leaves.sum(1)
        heap = [(int(w), s) for s, w in enumerate(weights)]
        heapq.heapify(heap)
        parent, side = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.uint8)
        for inner in range(size, 2 * size - 1):
            (w, a), (v, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = inner
            side[b] = 1
            heapq.heappush(heap, (w + v, inner))
        root, at, owner = 2 * size - 2, np.arange(size), np.arange(size)
        levels = []
        while len(at):
            levels.append((owner, parent[at] - size, side[at]))
            at = parent[at]
            owner, at = owner[at != root], at[at != root]
        owner = np.concatenate([x[0] for x in levels[::-1]])
        nodes = np.concatenate([x[1] for x in levels[::-1]])
        turns = np.concatenate([x[2] for x in levels[::-1]])
        by_owner = np.argsort(owner, kind="stable")
        owner, nodes, turns = owner[by_owner], nodes[by_owner], turns[by_owner]
        nodes = subtree_numbers(parent[size : 2 * size - 1] - size)[nodes]
        first = np.searchsorted(owner, np.arange(size + 1))
        seen = np.stack(
            [
                np.bincount(nodes * 2 + turns, leaves[owner, g], minlength=2 * (size - 1))
                for g in range(groups)
            ],
            axis=1,
        ).reshape(size - 1, 2, groups)
        total = leaves.sum(0)
        odds = np.log10((leaves + (weights[:, None] + 1) / (weights.sum() + size)) / (total + 1))
        return cls(
            hashes[order],
            np.arange(2, size, dtype=np.int32),
            first,
            nodes.astype(np.int32),
            turns,
            np.ascontiguousarray(seen.transpose(2, 0, 1)).astype(np.float32),
            odds.astype(np.float32),
            np.log10((total + 1) / (total + 1).sum()),
        )

    @cached_property
    def steps(self) -> np.ndarray:
        """Node and turn in one number."""
        return self.nodes * 2 + self.turns

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word, OTHER for those without one."""
        if not len(self.hashes):
            return np.full(len(hashes), OTHER, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbols[at], np.int32(OTHER))


@dataclass
class Texts:
    """Tokens of texts in order: words and one end each, with what stands before them.

    ``word``: place among the distinct words, -1 for an end. ``contexts``: hashes of the
    word before, and of the two before.
    """

    code: Code
    doc: np.ndarray
    place: np.ndarray
    word: np.ndarray
    symbol: np.ndarray
    contexts: list[np.ndarray]

    @classmethod
    def of(cls, code: Code, hashes, symbols, sequence, n_words, chosen) -> "Texts":
        """Of the chosen documents of a slice, numbered from 0."""
        ends = np.cumsum(n_words, dtype=np.int64)
        size = n_words[chosen].astype(np.int64) + 1
        doc = np.repeat(np.arange(len(chosen)), size)
        place = positions(size, np.zeros(len(size), np.int64))
        last = place == size[doc] - 1
        word = np.full(len(doc), -1, np.int64)
        word[~last] = sequence[positions(size - 1, (ends - n_words)[chosen])]
        symbol = np.full(len(doc), END, np.int32)
        symbol[~last] = symbols[word[~last]]
        token = np.full(len(doc), _STARTS, np.uint64)
        token[~last] = hashes[word[~last]]
        # What precedes a text is the end of the one before, alike for all of them.
        one = np.concatenate([[_STARTS], token[:-1]])[: len(token)]
        two = np.where(place > 1, np.concatenate([[_STARTS] * 2, token[:-2]])[: len(token)], _STARTS)
        contexts = [mixed(one + _SALTS[0]), mixed(mixed(two + _SALTS[1]) + one)]
        contexts = [(c >> np.uint64(32)).astype(np.uint32) for c in contexts]
        return cls(code, doc, place, word, symbol, contexts)

    @cached_property
    def groups(self) -> np.ndarray:
        """log10 of how likely each group is, by the tokens before in the same text."""
        found = np.empty((len(self.code.shares), len(self.doc)), np.float32)
        starts = np.arange(len(self.doc)) - self.place
        odds = self.code.odds.take(self.symbol, axis=0)
        for g, share in enumerate(self.code.shares):
            before = np.cumsum(np.concatenate([[0.0], odds[:, g]]))
            found[g] = before[:-1] - before.take(starts) + share
        return found


def texts_of(code: Code, hashes, sequence, n_words, chosen) -> Iterator[tuple[np.ndarray, Texts]]:
    """The chosen documents of a slice, some ``TOKENS_AT_ONCE`` tokens or a single text at a time.

    Texts of like length come together, so that few blocks are left to a text or two.
    About ``TEXTS_AT_ONCE`` are the most, so that what a block works with stays in the cache.
    """
    symbols = code.symbols_of(hashes)
    chosen = chosen[np.argsort(-n_words[chosen], kind="stable")]
    sizes = np.maximum(n_words[chosen] + 1, TOKENS_AT_ONCE // TEXTS_AT_ONCE)
    for lo, hi in pieces(sizes, TOKENS_AT_ONCE):
        yield chosen[lo:hi], Texts.of(code, hashes, symbols, sequence, n_words, chosen[lo:hi])


def salted_nodes(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What stands for a stretch of nodes, and the place of the node in it."""
    node = node.astype(np.uint32)
    return ((node >> LINE_BITS) + np.uint32(1)) * _SALT_32, node & np.uint32((1 << LINE_BITS) - 1)


def context_slots(context: np.ndarray, salted: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A context's slots of nodes in one stretch stand together, dealt by the hash among their places."""
    found = context ^ salted[0]
    found *= np.uint32(0x85EBCA6B)
    found >>= np.uint32(32 - CONTEXT_BITS)
    found ^= salted[1]
    return found.astype(np.int64)


def paths(code: Code, symbol: np.ndarray):
    """(bits of each symbol's path, node and turn of every bit)."""
    first = code.first.take(symbol)
    size = code.first.take(symbol + 1) - first
    at = np.repeat((first - (np.cumsum(size) - size)).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    step = taken(code.steps, at)
    return size, step >> 1, (step & 1).astype(np.uint8)


def _slices_of(batches: Iterator[pa.RecordBatch]):
    """(hashes, sequence, words by document, held out) of each slice."""
    for batch in batches:
        for r in range(batch.num_rows):
            yield (
                _hashes(_array(batch, "words", np.uint8, r), _array(batch, "lengths", np.int32, r)),
                _unplaned(batch.column("sequence")[r].as_buffer()),
                _array(batch, "n_words", np.int32, r),
                _array(batch, "held_out", bool, r),
            )


def _count_contexts(send):
    """Zeros and ones after each hashed context of the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*send.value)
        tables = [np.zeros(2 << CONTEXT_BITS, np.uint32) for _ in range(2)]
        for hashes, sequence, n_words, held in _slices_of(batches):
            for _, texts in texts_of(code, hashes, sequence, n_words, np.flatnonzero(~held)):
                for lo in range(0, len(texts.doc), COUNTED_AT_ONCE):
                    own = slice(lo, lo + COUNTED_AT_ONCE)
                    size, node, turn = paths(code, texts.symbol[own])
                    salted = salted_nodes(node)
                    for table, context in zip(tables, texts.contexts):
                        slot = context_slots(np.repeat(context[own], size), salted)
                        slot *= 2
                        slot += turn
                        np.add.at(table, slot, np.uint32(1))
        for p, table in enumerate(tables):
            rows = [
                {"kind": str(p), "i": i, "values": _planes(x)}
                for i, x in enumerate(_chunks(table))
                if x.any()
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_BLOB)

    return run


def _add_contexts(table: pa.Table) -> pa.Table:
    """Log odds of a stretch of slots, both counts of a slot lowered alike until 16 bits hold them.

    They are worked out here, since the counts would take the driver several times their room.
    """
    total = 0
    for r in range(table.num_rows):
        total = total + _unplaned(table.column("values")[r].as_buffer()).astype(np.int64)
    total = total.reshape(-1, 2)
    most = np.maximum(total.max(1, keepdims=True), 65535)
    total = np.minimum(np.ceil(total * (65535 / most)), 65535)
    row = {"kind": table.column("kind")[0].as_py(), "i": table.column("i")[0].as_py()}
    return pa.Table.from_pylist([row | {"values": known_odds(*total.T).tobytes()}], schema=_BLOB)


def _log_odds(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    prior = np.float32(PRIOR)
    return np.clip(np.log((one + prior) / (zero + prior)), -STRETCH_LIMIT, STRETCH_LIMIT)


@dataclass
class Mixer:
    """Reads texts bit by bit: mixes the predictors' log odds, refines, then learns.

    Predictors: the node's counts in the group that the text so far is likeliest in,
    those after the hash of the word before and of the two before, and the text's own
    counts so far. The own counts stand in hashed slots too, ``OWN_SLOTS`` a token.
    Every text begins with ``START_WEIGHTS`` and a refining table that leaves the mixed
    probability as it is. Weights, table and own counts follow the text from one block
    of words to the next, so that nothing of another row enters a score.
    """

    tables: list[np.ndarray]

    def read(self, code: Code, texts: Texts) -> np.ndarray:
        """log10 probability of each token's path."""
        size = np.bincount(texts.doc) if len(texts.doc) else np.zeros(0, np.int64)
        # Long texts first: those that still go on at a block are the first ones.
        order = np.argsort(-size, kind="stable")
        size, first = size[order], (np.cumsum(size) - size)[order]
        room = 1 << np.ceil(np.log2(np.maximum(size * OWN_SLOTS, 1))).astype(np.int64)
        begin, mask = np.cumsum(room) - room, (room - 1).astype(np.int32)
        counts = np.zeros(room.sum(), np.uint32)
        weights = np.tile(np.array(START_WEIGHTS, np.float32), (len(size) * CONTEXT_GATES, 1))
        hits = np.zeros((len(size), REFINE_STEPS, 2), np.float32)
        centers = np.linspace(-STRETCH_LIMIT, STRETCH_LIMIT, REFINE_STEPS)
        start = (1 / (1 + np.exp(-centers))).astype(np.float32)
        refined = np.tile(start, (len(size), 1))
        start *= np.float32(REFINE_PRIOR)
        scores = np.zeros(len(texts.doc))
        inner = code.counts.shape[1]
        likely = texts.groups.argmax(0).astype(np.int32) * np.int32(inner)
        grouped = _log_odds(code.counts[:, :, 0], code.counts[:, :, 1]).ravel()
        longest = int(np.diff(code.first).max())
        most = place = 0
        while place < int(size.max(initial=0)):
            # What does not depend on learning is looked up for some blocks at once.
            alive = int(np.searchsorted(-size, -place))
            places = place + BLOCK * np.arange(max(1, TEXTS_AT_ONCE // alive))
            reads = np.clip(size[:alive] - places[:, None], 0, BLOCK)
            own = positions(reads.ravel(), (first[:alive] + places[:, None]).ravel())
            reader = np.tile(np.arange(alive, dtype=np.int32), len(places))
            reader = np.repeat(reader, reads.ravel())
            size_of, node, turn = paths(code, texts.symbol.take(own))
            salted = salted_nodes(node)
            at = np.repeat(likely.take(own), size_of)
            at += node
            fixed = [taken(grouped, at)]
            levels = np.int16(0)
            for table, context, shift in zip(self.tables, texts.contexts, (0, 2)):
                known = taken(table, context_slots(np.repeat(context.take(own), size_of), salted))
                fixed.append((known >> 2) * np.float32(0.001))
                levels = levels + ((known & 3) << shift)
            slots = np.repeat(begin.take(reader), size_of)
            slots += node & np.repeat(mask.take(reader), size_of)
            spots = np.repeat(reader * np.int32(CONTEXT_GATES), size_of)
            keys = (spots + levels).astype(np.int64)
            spots *= np.int32(REFINE_STEPS // CONTEXT_GATES)
            ones = turn * np.uint32(0xFFFF) + np.uint32(1)
            found = np.empty(len(turn), np.float32)
            ends = np.cumsum(size_of)
            lo = 0
            for tokens, texts_left in zip(np.cumsum(reads.sum(1)), (reads > 0).sum(1)):
                hi = int(ends[tokens - 1])
                if hi == lo:
                    break
                slot, key, come = slots[lo:hi], keys[lo:hi], turn[lo:hi]
                inputs = [x[lo:hi] for x in fixed]
                inputs.append(_log_odds(*_halves(taken(counts, slot))))
                used = taken(weights, key, 0)
                odds = used[:, 0] * inputs[0]
                for k in range(1, len(inputs)):
                    odds += used[:, k] * inputs[k]
                np.clip(odds, -STRETCH_LIMIT, STRETCH_LIMIT, out=odds)
                mix = 1 / (1 + np.exp(-odds))
                spot = spots[lo:hi] + steps(odds)
                p = (mix + taken(refined.reshape(-1), spot)) * np.float32(0.5)
                # The distance from what did not come is the probability of what did.
                found[lo:hi] = np.abs(p - (come ^ 1))
                wrong = (come - mix) * np.float32(ONLINE_RATE)
                held = int(texts_left) * CONTEXT_GATES
                for k, x in enumerate(inputs):
                    weights[:held, k] += np.bincount(key, wrong * x, minlength=held)
                np.add.at(counts, slot, ones[lo:hi])
                # Both counts of a slot are halved before either runs over.
                most += BLOCK * longest
                if most >= 0x8000:
                    full = slot[(taken(counts, slot) & np.uint32(0x80008000)) > 0]
                    counts[full] = (counts[full] >> np.uint32(1)) & np.uint32(0x7FFF7FFF)
                spot *= 2
                spot += come
                seen = hits[:texts_left]
                seen += np.bincount(spot, minlength=seen.size).reshape(seen.shape)
                refined[:texts_left] = (start + seen[..., 1]) / (
                    np.float32(REFINE_PRIOR) + seen[..., 0] + seen[..., 1]
                )
                lo = hi
            scores[own] = np.add.reduceat(np.log(found), ends - size_of, dtype=np.float64)
            place += BLOCK * len(places)
        return scores / math.log(10)


def _halves(packed: np.ndarray) -> list[np.ndarray]:
    """Zeros and ones from the low and the high 16 bits."""
    return [
        (packed & np.uint32(0xFFFF)).astype(np.float32),
        (packed >> np.uint32(16)).astype(np.float32),
    ]


def trained_mixer(gathered: DataFrame, code: Code, parts: int) -> Mixer:
    """The mixer with its tables of contexts, counted over all training rows."""
    spark = gathered.sparkSession
    rows = gathered.select("words", "lengths", "sequence", "n_words", "held_out")
    kinds = schema("kind string, i long, values binary")
    send = spark.sparkContext.broadcast(_values(code))
    counted = (
        # A task's sums take the same room for one slice as for many.
        rows.coalesce(max(1, parts // COUNT_PARTS))
        .mapInArrow(_count_contexts(send), kinds)
        .groupBy("kind", "i")
        .applyInArrow(_add_contexts, kinds)
        .collect()
    )
    # Where nothing was counted the log odds are zero and the level too.
    tables = [np.zeros(1 << CONTEXT_BITS, np.int16) for _ in range(2)]
    for r in counted:
        values = np.frombuffer(r["values"], np.int16)
        tables[int(r["kind"])][r["i"] * len(values) : (r["i"] + 1) * len(values)] = values
    return Mixer(tables)


def known_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A slot's log odds in thousandths, above two bits that tell how well it is known."""
    zeros, ones = zeros.astype(np.float32), ones.astype(np.float32)
    level = np.minimum(np.log2(zeros + ones + 1), 3).astype(np.int16)
    return np.rint(_log_odds(zeros, ones) * 1000).astype(np.int16) * np.int16(4) + level


# Scoring


@dataclass
class Totals:
    """Of the training rows: tokens; by group, words seen once and words without a code."""

    tokens: int
    vocabulary: int
    ends: int
    once: int
    group_once: list[int]
    group_others: list[int]

    def word_odds(self, counts: np.ndarray, spelled_scores: np.ndarray) -> np.ndarray:
        """Probability in each group of words without a code, of counts by group and spelling."""
        once = max(self.once, 1)
        every = (counts.sum(1) + once * 10.0**spelled_scores) / (sum(self.group_others) + once)
        once = np.maximum(self.group_once, 1)
        return (counts + once * every[:, None]) / (np.array(self.group_others) + once)


def _scored(send, totals: Totals, parts: int):
    numbers = vars(totals)
    groups = len(totals.group_once)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        speller, code, mixer = send.value
        speller, code, mixer = Speller(*speller), Code(*code), Mixer(*mixer)
        known = Totals(**numbers)
        below = math.log10(known.tokens + BASE_PRIOR * (known.vocabulary + 1))
        found = _hashes(_array(left, "words", np.uint8), _array(left, "lengths", np.int32))
        counts = np.zeros((len(found), groups), np.int64)
        place, done = np.argsort(part_of(found, parts), kind="stable"), 0
        # Answers come by part, in the order in which the slice has asked.
        sizes, asked = right.column("size").to_numpy(), right.column("part").to_numpy()
        for r in np.argsort(asked):
            own = _numbers(right, "counts", sizes[r] * groups, r).reshape(groups, -1)
            counts[place[done : done + sizes[r]]] = own.T
            done += sizes[r]
        total = counts.sum(1)
        tables = []
        for r in range(left.num_rows):
            lengths = _array(left, "lengths", np.int32, r)
            stop = np.cumsum(lengths, dtype=np.int64)
            n_words = _array(left, "n_words", np.int32, r)
            sequence = _unplaned(left.column("sequence")[r].as_buffer())
            ids = _array(left, "ids", np.int64, r)
            # A word without a code: its counts and spelling, in the groups as they are likely there.
            data = _array(left, "words", np.uint8, r)
            rare = np.flatnonzero(code.symbols_of(found) == OTHER)
            odds = np.zeros((len(found), groups), np.float64)
            spelling = speller.word_scores(data, (stop - lengths)[rare], stop[rare])
            odds[rare] = known.word_odds(counts[rare], spelling)
            score = np.zeros(len(ids))
            for docs, texts in texts_of(code, found, sequence, n_words, np.arange(len(ids))):
                scores = mixer.read(code, texts)
                at = np.flatnonzero(texts.symbol == OTHER)
                likely = 10.0 ** (texts.groups[:, at] - texts.groups[:, at].max(0, initial=-np.inf))
                likely = likely / likely.sum(0)
                scores[at] += np.log10((likely * odds[texts.word[at]].T).sum(0))
                score[docs] = np.bincount(texts.doc, scores, minlength=len(docs))
            doc = np.repeat(np.arange(len(ids)), n_words)

            def per_document(values):
                return np.bincount(doc, values[sequence], minlength=len(ids))

            size = per_document(lengths + 1) + 1
            base = np.log10(total + BASE_PRIOR) - below
            base_end = math.log10(known.ends + BASE_PRIOR) - below
            tables.append(
                pa.table(
                    {
                        "doc_id": pa.array(ids, mask=_array(left, "id_null", bool, r)),
                        "held_out": pa.array(_array(left, "held_out", bool, r)),
                        "n_tokens": pa.array(n_words.astype(np.int64) + 1),
                        "n_known": pa.array(
                            per_document(total > 0).astype(np.int64) + int(known.ends > 0)
                        ),
                        "base_score": pa.array(per_document(base) + base_end),
                        "score": pa.array(score),
                        "bits_per_byte": pa.array(-score * math.log2(10) / size),
                    }
                )
            )
        return pa.concat_tables(tables)

    return run


def _tally(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = 2 + 2 * groups
        found = np.zeros(plain + COUNT_STEPS, np.int64)
        for _, _, _, counts in _word_lists(batches):
            found[0] += len(counts)
            found[1] += (counts.sum(1) == 1).sum()
            found[2 : 2 + groups] += counts.sum(0)
            found[2 + groups : plain] += (counts == 1).sum(0)
            found[plain:] += np.bincount(count_step(counts.sum(1)), minlength=COUNT_STEPS)
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(found)), "n": found})

    return run


def language_scores(
    docs: DataFrame, held_out, group: str | None = "lang", groups: int = MOST_GROUPS
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    ``held_out`` is a column of ``docs`` telling which rows are not learned from; a
    null counts as held out. ``group`` names the column whose ``groups - 1`` most
    frequent training values have a model of their own, the rest sharing one; with
    None there is one group. It is read in training rows only. Scores are log10
    probabilities; A-Z are lower-cased. A null or empty text is its end alone.
    Every row is scored on its own, repeated rows alike, and learned from as often
    as it stands there. Without rows to learn from all words are unknown and bits
    about even. An empty table gives an empty result. bits_per_byte divides by the
    bytes of the words, a space after each, and the end.

    Slices of documents are written out once with their words. A hot word is one
    entry per slice, so no part grows with the documents that use it.
    """
    spark = docs.sparkSession
    label = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        label.alias("_label"),
        F.col("text"),
    )
    frequent = (
        narrow.filter("NOT held_out")
        .groupBy("_label")
        .count()
        .orderBy(F.desc("count"), "_label")
        .limit(groups - 1)
        .collect()
    )
    order = F.lit(len(frequent))
    for i, row in enumerate(frequent):
        order = F.when(F.col("_label") == row["_label"], i).otherwise(order)
    number = len(frequent) + 1
    narrow = narrow.select("doc_id", "held_out", order.cast("int").alias("group"), "text")
    ends = {
        row["group"]: row["count"]
        for row in narrow.filter("NOT held_out").groupBy("group").count().collect()
    }
    group_ends = [ends.get(g, 0) for g in range(number)]
    size = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))
    gathered = saved(narrow.mapInArrow(_gathered(number), schema(_SLICE)), "slices")
    counted = saved(
        gathered.select("slice", "trained", "words", "lengths")
        .mapInArrow(_requests(parts, number), schema(_REQUEST))
        .groupBy("part")
        .applyInArrow(_totals(number), schema(_GROUP)),
        "counted",
    )
    words = counted.filter("slice IS NULL").select("counts", "words", "lengths")
    rows = words.mapInArrow(_tally(number), schema("i long, n long")).groupBy("i").sum("n").collect()
    sums = {row[0]: row[1] for row in rows}
    every = sum(group_ends)
    seen = [sums.get(2 + g, 0) for g in range(number)]
    once = [sums.get(2 + number + g, 0) for g in range(number)]
    known = sums.get(0, 0) + (every > 0)
    tokens = sum(seen) + every
    speller = train(words, every)
    steps_seen = np.array([sums.get(2 + 2 * number + i, 0) for i in range(COUNT_STEPS)])
    frequent = words.mapInArrow(
        _coded(least_coded(steps_seen)), schema("hashes binary, counts binary")
    ).collect()
    hashes = np.frombuffer(b"".join(r["hashes"] for r in frequent), np.uint64)
    coded = np.frombuffer(b"".join(r["counts"] for r in frequent), np.int64).reshape(-1, number)
    others = [seen[g] - int(coded[:, g].sum()) for g in range(number)]
    totals = Totals(tokens, known, every, sums.get(1, 0), once, others)
    code = Code.of(hashes, coded, others, group_ends)
    mixer = trained_mixer(gathered, code, parts)
    send = spark.sparkContext.broadcast(tuple(_values(x) for x in (speller, code, mixer)))
    answers = counted.filter("slice IS NOT NULL").select("slice", "part", "size", "counts")
    scored = (
        gathered.drop("trained")
        .groupBy("slice")
        .cogroup(answers.groupBy("slice"))
        .applyInArrow(
            _scored(send, totals, parts),
            schema(
                "doc_id long, held_out boolean, n_tokens long, n_known long, "
                "base_score double, score double, bits_per_byte double"
            ),
        )
    )
    return scored.withColumn("train_tokens", F.lit(totals.tokens).cast("long"))
