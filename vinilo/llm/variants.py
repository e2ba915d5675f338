"""Spelling variants: words one edit apart, by an index of variable-length grams.

A word stands between marks. A gram dictionary holds the grams that occur often
in the vocabulary, pruned to those above a share of all grams, which bounds it.
Every place of a word has one gram: the shortest that the dictionary does not
hold, of ``SHORTEST`` to ``LONGEST`` letters, or what is left of the word. A gram
thus depends on its own letters alone, and an edit affects just the grams that
cover its place.

The bound of a word tells, for each place of an edit, which grams it affects.
Lists are merged for the fewest rare grams that no edit affects together: two
grams side by side near the middle. If the edit lies behind the first gram, the near
word has that gram too, with the same letters before it; else it has the second with
the same letters after it. The gram's lists are divided by the letters on that side,
and by the letters at the word's other edge. Edits at an edge are found by the last
gram before it, divided by all letters on the other side. So a word is looked up in
four lists, one for each stretch where the edit may lie. What is met there is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import saved, schema
from vinilo.llm.wordarrays import mixed, positions, powers, slices

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_LETTERS = 7
LEAST = 2
DROP_ONE_IN = 31
FACTOR = 10
SHORTEST, LONGEST = 3, 6
# A mark with two letters: what a word's edges are, and how far from the middle cuts may be, twice.
EDGE, UNEVEN = 3, 4
# A gram is frequent above this share of the grams of its length, so fewer than so many are.
MOST_FREQUENT = 1 << 17
LEAST_FREQUENT = 64
_BASE = 0x9E3779B97F4A7C15 | 1
_MARK = np.uint32(1)


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, least: int = LEAST) -> DataFrame:
    """(word, n): lower-cased runs of letters in whole texts, some with a letter dropped.

    A run loses one code point where 31 divides the crc32 of ``<doc_id>:<run>``,
    the one at that number modulo the run's length. Null texts have no runs; a
    null id counts as no digits. Rows count as often as they stand in the table.
    Runs too short to end as a word are passed over by the pattern already.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    runs = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{min_letters},}}"), F.lit(0))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    run = F.translate("_run", UPPER, UPPER.lower())
    at = (F.col("h") % F.length("run")).cast("int")
    dropped = F.concat(F.expr("left(run, _at)"), F.expr("substring(run, _at + 2)"))
    words = (
        docs.select(ident.alias("_id"), F.explode(runs).alias("_run"))
        .select("_id", run.alias("run"))
        .select("run", F.crc32(F.concat_ws(":", "_id", "run").cast("binary")).alias("h"))
        .withColumn("_at", at)
        .select(F.when(F.col("h") % DROP_ONE_IN == 0, dropped).otherwise(F.col("run")).alias("word"))
        .filter(F.length("word") >= min_letters)
    )
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


class Marked:
    """The words of a batch between marks, as one array of code points."""

    def __init__(self, words: pa.Array):
        text = "\x01" + "\x01\x01".join(words.to_pylist()) + "\x01"
        self.letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        places = np.flatnonzero(self.letters == _MARK)
        self.start, self.stop = places[::2], places[1::2] + 1
        self.length = self.stop - self.start
        values = mixed(self.letters.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        self.sums = np.append(np.uint64(0), np.cumsum(values * powers(_BASE, len(values))))

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Of letters[start:stop], by differences of a running sum."""
        inverse = powers(pow(_BASE, -1, 1 << 64), len(self.sums))
        found = (self.sums[stop] - self.sums[start]) * inverse[start]
        return mixed(found + (stop - start).astype(np.uint64))

    def places(self, width: int) -> np.ndarray:
        """Where a gram of that width begins, word by word."""
        return positions(np.maximum(self.length - width + 1, 0), self.start)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "word"):
        words = Marked(batch.column("word"))
        for width in range(SHORTEST, LONGEST):
            at = words.places(width)
            gram, n = np.unique(words.hashes(at, at + width), return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"width": np.full(len(gram), width, np.int32), "gram": gram.view(np.int64), "n": n}
            )


def gram_dictionary(
    words: DataFrame, most: int = MOST_FREQUENT, least: int = LEAST_FREQUENT
) -> np.ndarray:
    """Hashes of the frequent grams, sorted.

    A gram has to stand in more than ``least`` places and in more than one of
    ``most`` places that have a gram of its length, so at most ``most`` are
    frequent for each of three lengths, whatever the vocabulary.
    """
    counts = saved(
        words.mapInArrow(_count_grams, schema("width int, gram long, n long"))
        .groupBy("width", "gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    total = counts.groupBy("width").agg(F.sum("n").alias("total"))
    frequent = (
        counts.filter(F.col("n") > least)
        .join(F.broadcast(total), "width")
        .filter(F.col("n") * most > F.col("total"))
        .select("gram")
    )
    return np.sort(frequent.toPandas()["gram"].to_numpy(np.int64).view(np.uint64))


def gram_ends(words: Marked, dictionary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and rarity (0: not in the dictionary) of the gram at every place of every word."""
    begin = words.places(SHORTEST)
    last = np.repeat(words.stop, np.maximum(words.length - SHORTEST + 1, 0))
    end = begin + SHORTEST
    growing = np.arange(len(begin))
    common = np.zeros(len(begin), np.int8)
    for width in range(SHORTEST, LONGEST):
        grams = words.hashes(begin[growing], begin[growing] + width)
        place = np.minimum(np.searchsorted(dictionary, grams), len(dictionary) - 1)
        growing = growing[dictionary[place] == grams] if len(dictionary) else growing[:0]
        stuck = begin[growing] + width == last[growing]
        common[growing[stuck]] = 1  # the word ends before the gram turns rare
        growing = growing[~stuck]
        end[growing] = begin[growing] + width + 1
    common[growing] = 1  # as long as grams may be
    return begin, end, common


def best_cuts(words: Marked, begin: np.ndarray, end: np.ndarray, common: np.ndarray):
    """For each word the end of a gram near the middle where another begins, both rare if there
    are such, and the last end of a gram before the last letters.

    No edit affects both grams at the cut: it would have to lie before it and behind it.
    """
    count = np.maximum(words.length - SHORTEST + 1, 0)
    head = np.cumsum(count) - count
    own = np.repeat(np.arange(len(count)), count)
    next_gram = np.minimum(head[own] + end - words.start[own], len(common) - 1)
    uneven = np.abs(2 * (end - words.start[own]) - words.length[own])
    score = (common + common[next_gram]).astype(np.int64) * (1 << 40) + uneven
    order = np.lexsort((begin, np.where(uneven <= UNEVEN, score, 1 << 60), own))
    late = np.where(end <= words.stop[own] - EDGE, end, 0)
    return end[order[head]], np.maximum.reduceat(late, head)


def _named(kind: int, *parts: np.ndarray) -> np.ndarray:
    """One number for a kind of list and the hashes of letters that it is divided by."""
    name = np.full(len(parts[0]), kind + 1, np.uint64)
    for part in parts:
        name = mixed(name * np.uint64(_BASE) + part)
    return name


def _lists(words: Marked, own: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """(word, list) of the lists that words stand on, for the grams that a near word may ask by.

    A near word is at most a letter longer or shorter, which widens each range by one.
    """
    start, stop, length = words.start[own], words.stop[own], words.length[own]
    head, tail = (
        words.hashes(words.start, words.start + EDGE)[own],
        words.hashes(words.stop - EDGE, words.stop)[own],
    )
    before, after = words.hashes(start, end), words.hashes(begin, stop)
    near_end = np.abs(2 * (end - start) - length) <= UNEVEN + 1
    near_begin = np.abs(2 * (begin - start) - length) <= UNEVEN + 1
    late = (end <= stop - EDGE + 1) & (end >= stop - EDGE - LONGEST + SHORTEST - 1)
    early = np.abs(begin - start - EDGE) <= 1
    kinds = (
        (near_end, _named(0, before, tail)),
        (near_begin, _named(1, after, head)),
        (late, _named(2, before)),
        (early, _named(3, after)),
    )
    return np.unique(
        np.concatenate([np.stack([own[at].astype(np.uint64), name[at]], 1) for at, name in kinds]),
        axis=0,
    )


def _asked(words: Marked, cut: np.ndarray, late: np.ndarray) -> np.ndarray:
    """The four lists that each word is looked up in, by where the edit may lie."""
    head = words.hashes(words.start, words.start + EDGE)
    tail = words.hashes(words.stop - EDGE, words.stop)
    return np.stack(
        [
            _named(0, words.hashes(words.start, cut), tail),
            _named(1, words.hashes(cut, words.stop), head),
            _named(2, words.hashes(words.start, late)),
            _named(3, words.hashes(words.start + EDGE, words.stop)),
        ],
        1,
    )


def _entries(dictionary: np.ndarray):
    """Each word with the lists it stands on and those it is looked up in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word"):
            words = Marked(batch.column("word"))
            begin, end, common = gram_ends(words, dictionary)
            own = np.repeat(np.arange(batch.num_rows), np.maximum(words.length - SHORTEST + 1, 0))
            stands = _lists(words, own, begin, end)
            offsets = np.searchsorted(stands[:, 0], np.arange(batch.num_rows + 1, dtype=np.uint64))
            asked = _asked(words, *best_cuts(words, begin, end, common))
            ends = np.arange(0, asked.size + 1, asked.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "word": batch.column("word"),
                    "n": batch.column("n"),
                    "lists": pa.ListArray.from_arrays(
                        pa.array(offsets.astype(np.int32)), pa.array(stands[:, 1].view(np.int64).copy())
                    ),
                    "looked": pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(asked.reshape(-1).view(np.int64))
                    ),
                }
            )

    return run


def near_words(counts: DataFrame, most: int = MOST_FREQUENT, least: int = LEAST_FREQUENT) -> DataFrame:
    """(word, n, near, near_n): all pairs of words one edit apart, both ways round."""
    dictionary = gram_dictionary(counts, most, least)
    entries = saved(
        counts.mapInArrow(
            _entries(dictionary), schema("word string, n long, lists array<long>, looked array<long>")
        ),
        "entries",
    )
    index = entries.select(
        F.explode("lists").alias("list"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    asked = entries.select(F.explode("looked").alias("list"), "word", "n")
    # Either word of a pair finds the other, so one of the two ways is enough.
    pairs = (
        asked.hint("merge")
        .join(index, "list")
        .filter(F.col("word") < F.col("near"))
        .filter(F.abs(F.length("word") - F.length("near")) <= 1)
        .filter(F.levenshtein("word", "near", 1) == 1)
        .select("word", "n", "near", "near_n")
        .distinct()
    )
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(
            F.col("near").alias("word"),
            F.col("near_n").alias("n"),
            F.col("word").alias("near"),
            F.col("n").alias("near_n"),
        ),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each (word, form): where following forms ends.

    Steps double, and every form is at least ``FACTOR`` times as frequent as its
    word, so a few rounds reach the end of any chain.
    """
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = saved(
            now.join(ahead, "root", "left").select(
                "word",
                F.coalesce("_next", "root").alias("root"),
                F.col("_next").isNotNull().alias("_moved"),
            ),
            "roots",
        )
        now = further.select("word", "root")
        if further.filter("_moved").isEmpty():
            return now


def spelling_variants(
    counts: DataFrame,
    factor: int = FACTOR,
    most: int = MOST_FREQUENT,
    least: int = LEAST_FREQUENT,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``counts`` (word, n).

    Words are near if one code point inserted, deleted or replaced makes one of
    the other. The form is the near word of largest n, the smallest of them in
    code-point order, if its n is at least ``factor`` times the word's; the root is
    where following forms ends, the word itself without one. Words have to be
    distinct and of at least ``MIN_LETTERS`` letters; an empty table stays empty.
    """
    own = saved(counts.select("word", "n"), "words")
    best = (
        near_words(own, most, least)
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("b"),
        )
        .select("word", "n_near", F.col("b.form").alias("best"), (-F.col("b.less")).alias("best_n"))
    )
    large = F.col("best_n") >= factor * F.col("n")
    formed = saved(
        own.join(best, "word", "left").select(
            "word",
            F.when(large, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
