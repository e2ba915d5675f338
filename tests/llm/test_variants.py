"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vinilo.llm import variants

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute_variants(counts):
    forms, n_near = {}, {}
    for w in counts:
        others = [v for v in counts if near(w, v)]
        n_near[w] = len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    rows = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, n_near[w], counts.get(forms[w])))
    return rows


def edited(pick, word, letters):
    at = pick.randrange(len(word))
    kind = pick.randrange(3)
    if kind == 0:
        return word[:at] + word[at + 1 :]
    return word[:at] + pick.choice(letters) + word[at + (kind == 1) :]


def vocabulary(seed, size=700, letters="abcdeéß×"):
    """Words and edits of them, many sharing syllables or halves, some of one letter."""
    pick = random.Random(seed)
    syllables = ["".join(pick.choice(letters) for _ in range(pick.randint(2, 4))) for _ in range(12)]
    words = {"a" * n for n in range(7, 14)} | {"abcdefgabcdefg", "abcdefgabcdefga"}
    while len(words) < size:
        word = "".join(pick.choice(syllables) for _ in range(pick.randint(3, 7)))
        words.add(word)
        for _ in range(pick.randint(0, 4)):
            word = edited(pick, word, letters)
            words.add(word)
    words = sorted(w for w in words if len(w) >= 7)
    return {w: pick.choice([2, 2, 3, 21, 200, 200, 2100]) for w in words}


def columns(rows):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows}


# A small ``least`` makes many grams frequent, a small ``most`` none.
@pytest.mark.parametrize("seed, most, least", [(1, 1 << 17, 2), (2, 1 << 17, 64), (3, 1, 0), (4, 500, 0)])
def test_variants_equal_brute_force(spark, seed, most, least):
    counts = vocabulary(seed)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = variants.spelling_variants(frame, most=most, least=least).collect()
    assert len(found) == len(counts)
    assert columns(found) == brute_variants(counts)


def test_counts_equal_brute_force(documents, odd_columns):
    pick = random.Random(5)
    words = list(vocabulary(6, 150)) + ["Ünter-Suchung", "naïvement", "x1y", "ABCDEFGHIJ", "abcdef"]
    rows = [(i if i % 9 else None, " ".join(pick.choices(words, k=80)).title()) for i in range(60)]
    rows += [(7, None), (8, ""), (9, "!?"), (3, "abcdefgh " * 40_000), (3, "abcdefgh " * 40_000)]
    rows += [(10, "q" * 200_000), (11, "q" * 200_000)]
    frame = variants.word_counts(odd_columns(documents(*rows)))
    assert {r["word"]: r["n"] for r in frame.collect()} == brute_counts(rows)


def test_empty_tables(documents):
    counts = variants.word_counts(documents())
    assert counts.count() == 0
    assert variants.spelling_variants(counts).count() == 0


def test_chains_and_ties(spark):
    """Forms lead on; of equally frequent near words the smaller one is taken."""
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 5000, "abcdefx": 20}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = {r["word"]: r for r in variants.spelling_variants(frame).collect()}
    assert rows["abcdefg"]["form"] == "abcdefgh" and rows["abcdefg"]["root"] == "abcdefghij"
    assert rows["abcdefg"]["n_near"] == 2 and rows["abcdefghij"]["form"] is None
    assert rows["abcdefghij"]["root"] == "abcdefghij"


def test_grams_depend_on_their_letters_alone(spark):
    """Equal letters at two places of two words give equal grams, frequent or not."""
    counts = vocabulary(8, 300)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    dictionary = variants.gram_dictionary(frame, least=5)
    assert len(dictionary) > 20
    words = variants.Marked(pa.array(sorted(counts)))
    begin, end, common = variants.gram_ends(words, dictionary)
    letters = "".join(map(chr, words.letters))
    ends = {}
    for a, b, c in zip(begin.tolist(), end.tolist(), common.tolist()):
        assert variants.SHORTEST <= b - a <= variants.LONGEST
        assert ends.setdefault(letters[a:b], c) == c
    grams = sorted(ends)
    # None is the beginning of another: each is the first rare one.
    assert not any(y.startswith(x) for x, y in zip(grams, grams[1:]))
    for cut in variants.best_cuts(words, begin, end, common):
        assert set(cut.tolist()) <= set(end.tolist()) and (np.diff(cut) > 0).all()
        assert ((words.start < cut) & (cut <= words.stop - variants.EDGE)).all()


def test_the_dictionary_is_bounded(spark):
    counts = vocabulary(9, 400)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert len(variants.gram_dictionary(frame, most=10, least=0)) <= 3 * 10
    exact = Counter(f"\1{w}\1"[i : i + 3] for w in counts for i in range(len(w)))
    kept = variants.gram_dictionary(frame, least=6)
    width_3 = sum(n > 6 for n in exact.values())
    assert width_3 <= len(kept)
