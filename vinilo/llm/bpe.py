"""Byte-level BPE by monoid tree reduction.

Sequences of tokens form a monoid: two encoded halves are joined by encoding
again a window of tokens around the seam. A sequence is the encoding of its
bytes if and only if every two neighbours are the encoding of theirs, so when
the window comes back with the same first and last token, all outside stands;
else it grows. Texts are cut into pieces in the same way, and decoding joins
bytes up the tree.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import schema, unused
from vinilo.llm.wordarrays import slices

LEAF_BYTES = 24
LEAF_CHARS = 1 << 15
LEAF_TOKENS = 1 << 12
LONG_BYTES = 256
NEVER = 1 << 62
CACHED_PIECES = 400_000
# How far past its start a match of the pattern can look beyond its own end.
LOOK = 3


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Encodes and decodes texts by the ranks of a vocabulary file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Encoding of a short sequence: the lowest rank first, the leftmost on ties."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > LONG_BYTES:
            return self._merge_long(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while pairs:
            least = min(pairs)
            if least == NEVER:
                break
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
        return [ranks[part] for part in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """As ``merge``, with a heap of the pairs."""
        ranks = self.ranks
        n = len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = ranks.get(data[i : after[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, j, after[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, end = heapq.heappop(heap)
            if not alive[i] or after[i] != j or j >= n or not alive[j] or after[j] != end:
                continue
            alive[j] = False
            after[i] = end
            if end < n:
                before[end] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[data[i : after[i]]] for i in range(n) if alive[i]]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of two encoded sequences one after the other."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = left[len(left) - i :] + right[:j]
            again = self.merge(b"".join([self.tokens[t] for t in window]))
            starts = i == len(left) or again[0] == window[0]
            stops = j == len(right) or again[-1] == window[-1]
            if starts and stops:
                return left[: len(left) - i] + again + right[j:]
            i, j = i if starts else i * 2, j if stops else j * 2

    def encode_bytes(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def pieces(self, text: str) -> list[str]:
        """Matches of the pattern, of halves joined around the seam.

        A match depends only on the text from its start to LOOK characters past
        its start or one past its end. So the left half's matches that end LOOK
        characters before the seam stand, and once a match found again starts
        where one of the right half starts, the right half's go on from there.
        """
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        half = len(text) // 2
        left, right = self.pieces(text[:half]), self.pieces(text[half:])
        tail: list[str] = []
        while left and sum(map(len, tail)) < LOOK:
            tail.append(left.pop())
        seam = sum(map(len, tail))
        window, taken, more = "".join(reversed(tail)), 0, 4
        while taken < len(right):
            starts = {}
            window += "".join(right[taken : taken + more])
            taken = min(taken + more, len(right))
            at = seam
            for i in range(taken):
                starts[at] = i
                at += len(right[i])
            again, at = self.pattern.findall(window), 0
            for n, match in enumerate(again):
                if at in starts and at <= len(window) - LOOK:
                    return left + again[:n] + right[starts[at] :]
                at += len(match)
            more *= 2
        return left + self.pattern.findall(window)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit numbers."""
        cache = self.cache
        parts = []
        for piece in self.pieces(text):
            ids = cache.get(piece)
            if ids is None:
                if len(cache) >= CACHED_PIECES:
                    cache.clear()
                ids = np.array(self.encode_bytes(piece.encode()), "<u4").tobytes()
                cache[piece] = ids
            parts.append(ids)
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.tokens[t] for t in ids.tolist()])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _encode(path: str, pattern: str, text: str, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(path), pattern)
        for batch in slices(batches, text):
            ids = [encoder.encode(t or "") for t in batch.column(text).to_pylist()]
            made = {"ids": ids}
            if back:
                made["decoded"] = [encoder.decode(np.frombuffer(x, "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(v, pa.binary()) for v in made.values()]],
                [*batch.schema.names[:-1], *made],
            )

    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(path), pattern)
        for batch in batches:
            found = [
                encoder.decode(np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else None
                for x in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return run


def encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    carry: list[str] | None = None,
    back: bool = False,
) -> DataFrame:
    """``carry`` columns of ``docs`` (by default all) with ``ids`` and ``n_tokens``.

    ids is a binary of little-endian unsigned 32-bit numbers; a null or empty
    text has none. Row by row and in place: no shuffle, ids and repeated rows do
    not matter, and an empty table stays empty. Columns named ids or n_tokens
    are replaced. ``path`` is the vocabulary's place on every executor. With
    ``back`` the same worker also decodes the ids, into ``decoded``, which spares
    the second worker per task that ``decoded`` after ``encoded`` would take.
    """
    made = ["ids", "decoded"] if back else ["ids"]
    keep = [c for c in (carry or docs.columns) if c.lower() not in ("n_tokens", *made)]
    text = unused(keep, "text")
    own = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(text))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    binaries = ", ".join(f"{c} binary" for c in made)
    found = own.mapInArrow(_encode(path, pattern, text, back), schema(f"{fields}{binaries}"))
    return found.withColumn("n_tokens", F.expr("octet_length(ids) div 4").cast("long"))


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes of its ``ids``; null stays null."""
    own = tokens.drop("decoded")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields)
    return own.mapInArrow(_decode(path, pattern), schema(f"{fields}decoded binary"))
