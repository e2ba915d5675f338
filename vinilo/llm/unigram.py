"""Token counts of a unigram vocabulary by a Viterbi pass that keeps no path.

An Aho-Corasick automaton lists the vocabulary's matches in a piece of text.
Dynamic programming carries the best score up to each place and the number of
tokens it takes, so a count needs no back-tracking.

Tie rule of the tokenizer: starts are taken from left to right, and a place
keeps its first best score, so of equal scores the longer last piece stays. A
character that starts no vocabulary piece of one character is unknown: it scores
ten below the lowest piece. Runs of unknown characters are counted by their
UTF-8 bytes where the vocabulary has byte pieces, else as one token.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import schema, unused
from vinilo.llm.wordarrays import slices

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_PIECES = 400_000


def load_pieces(path: str) -> tuple[dict[str, float], bool]:
    """(piece -> score, whether bytes are pieces) of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, has_bytes = {}, False
    for i in range(model.vocab_size()):
        if model.IsByte(i):
            has_bytes = True
        elif not (model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i)):
            pieces[model.IdToPiece(i)] = model.GetScore(i)
    return pieces, has_bytes


class Counter:
    def __init__(self, pieces: dict[str, float], has_bytes: bool):
        self.pieces, self.has_bytes = pieces, has_bytes
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.known = {piece for piece in pieces if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.cache: dict[str, tuple[float, int]] = {}
        # Text may be cut in front of a space mark that follows another character,
        # if no piece spans such a place: then no token does.
        inner = regex.compile(f"[^{SPACE}]{SPACE}")
        self.cut = None
        if not any(inner.search(piece) for piece in pieces):
            self.cut = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")

    def best(self, text: str) -> tuple[float, int]:
        """Best score of a piece of text, and the number of its tokens."""
        if not self.known.issuperset(text):
            return self._best_with_unknown(text)
        scores: list = [0.0] + [None] * len(text)
        counts = [0] * (len(text) + 1)
        # Matches come by their end, the longest and so the earliest start first.
        for end, (length, score) in self.automaton.iter(text):
            total = scores[end + 1 - length] + score
            best = scores[end + 1]
            if best is None or total > best:
                scores[end + 1] = total
                counts[end + 1] = counts[end + 1 - length] + 1
        return scores[-1], counts[-1]

    def _best_with_unknown(self, text: str) -> tuple[float, int]:
        n = len(text)
        ending: list[list] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(text):
            ending[end].append(match)
        scores, counts, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            found = None
            for length, score in ending[end]:
                at = end + 1 - length
                total = scores[at] + score
                if found is None or total > found:
                    found, count, missed = total, counts[at] + 1, False
            if text[end] not in self.known:
                total = scores[end] + self.unknown
                if found is None or total > found:
                    found, missed = total, True
                    if self.has_bytes:
                        count = counts[end] + len(text[end].encode())
                    else:
                        count = counts[end] + (not unknown[end])
            scores[end + 1], counts[end + 1], unknown[end + 1] = found, count, missed
        return scores[n], counts[n]

    def count(self, text: str) -> tuple[float, int]:
        """Score and number of tokens of a whole text; an empty text has none."""
        if not text:
            return 0.0, 0
        marked = SPACE + text.replace(" ", SPACE)
        if self.cut is None:
            return self.best(marked)
        cache = self.cache
        score, tokens = 0.0, 0
        for piece in self.cut.findall(marked):
            found = cache.get(piece)
            if found is None:
                if len(cache) >= CACHED_PIECES:
                    cache.clear()
                found = cache[piece] = self.best(piece)
            score += found[0]
            tokens += found[1]
        return score, tokens


def _count(path: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*load_pieces(path))
        for batch in slices(batches, text):
            found = [counter.count(t or "") for t in batch.column(text).to_pylist()]
            scores = np.array([f[0] for f in found], float)
            tokens = np.array([f[1] for f in found], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(tokens), pa.array(scores)],
                [*batch.schema.names[:-1], "n_tokens", "best_score"],
            )

    return run


def token_counts(docs: DataFrame, path: str, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns of ``docs`` (by default all) with n_tokens and best_score.

    Spaces become space marks and one is put in front; everything else counts as
    it stands. Null and empty texts have no tokens and score 0. Row by row and in
    place: ids and repeated rows do not matter, and an empty table stays empty.
    Columns named n_tokens or best_score are replaced.
    """
    keep = [c for c in (carry or docs.columns) if c.lower() not in ("n_tokens", "best_score")]
    text = unused(keep, "text")
    own = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(text))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    return own.mapInArrow(_count(path, text), schema(f"{fields}n_tokens long, best_score double"))
