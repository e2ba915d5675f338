"""Near duplicates and repeated passages against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from vinilo.llm import neardup, repeats
from vinilo.llm.common import components
from vinilo.llm.wordarrays import Words


def split(text):
    return (text or "").encode().split()


def sets(text, width):
    words = split((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, width, percent):
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(i, sets(t, width)) for i, t in rows if i is not None]
    for i, a in known:
        for j, b in known:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_copies(seed, groups=6, copies=14):
    """Groups of texts with ever more words changed, some upper-cased, some equal."""
    pick = random.Random(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{pick.randint(0, 400)}" for _ in range(pick.randint(30, 120))]
        for n in range(copies):
            if n % 3:
                words = list(words)
                words[pick.randrange(len(words))] = f"n{pick.randint(0, 9999)}"
            text = " ".join(words)
            rows.append((len(rows), text.upper() if n % 5 == 0 else text))
    return rows


@pytest.mark.parametrize("width, percent, block", [(3, 85, 1024), (5, 80, 5)])
def test_components_equal_brute_force(documents, width, percent, block):
    rows = near_copies(width)
    found = neardup.near_duplicates(documents(*rows), width, percent, block=block).collect()
    want = brute_components(rows, width, percent)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    texts = dict(rows)
    assert all(r["n_shingles"] == len(sets(texts[r["doc_id"]], width)) for r in found)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_short_null_repeated_and_foreign_columns(documents, odd_columns):
    rows = [
        (1, "one two"), (2, "ONE\ttwo"), (3, "one"), (4, ""), (5, None), (6, " \n"), (None, "one two"),
        (7, "a b c d e"), (7, "f g h i j"), (8, "f g h i j"), (3, "one"),
    ]
    found = neardup.near_duplicates(odd_columns(documents(*rows)), 3, 85).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"]} == {
        1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7,
    }
    nobody = [r for r in found if r["doc_id"] is None][0]
    assert nobody["kept"] and nobody["component_id"] is None
    assert neardup.near_duplicates(documents(), 3, 85).count() == 0


def test_band_count_bounds_the_miss():
    for percent in (50, 80, 85, 99):
        bands = neardup.band_count(percent)
        assert (1 - (percent / 100) ** neardup.BAND_VALUES) ** bands <= neardup.MISS
    assert neardup.band_count(100) == 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in found} == {
        **{i: 0 for i in range(41)},
        **{i: 100 for i in range(100, 130)},
    }


def test_words_equal_split():
    texts = ["a  bc\x0b\td", "", None, "é\xa0x  y", " lead", "trail ", "\r\n", "x" * 100_000]
    words = Words(pa.array(["skipped", *texts]).slice(1))
    assert words.count.tolist() == [len(split(t)) for t in texts]
    got = [bytes(words.data[a:b]) for a, b in zip(words.start, words.stop)]
    assert got == [w for t in texts for w in split(t)]
    hashes = words.hashes()
    assert len(set(got)) == len(np.unique(hashes))


def brute_removed(rows, window):
    """Kept words by row; the first place of each window among (doc_id, start)."""
    last = float("inf")
    first = {}
    for i, text in rows:
        words, key = split(text), last if i is None else i
        for at in range(len(words) - window + 1):
            spot = tuple(words[at : at + window])
            first[spot] = min(first.get(spot, (key, at)), (key, at))
    kept = []
    for i, text in rows:
        words, key = split(text), last if i is None else i
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (key, at):
                gone.update(range(at, at + window))
        kept.append((i, b" ".join(w for n, w in enumerate(words) if n not in gone).decode(), len(gone)))
    return sorted(kept, key=str)


def passages(seed):
    pick = random.Random(seed)
    shared = [[f"s{pick.randint(0, 99)}" for _ in range(pick.randint(4, 30))] for _ in range(8)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(pick.randint(0, 5)):
            words += pick.choice(shared) if pick.random() < 0.6 else [f"u{pick.random()}"] * 3
        rows.append((i * 7 % 60, " ".join(words)))
    return rows + [(3, "r " * 30), (None, rows[5][1]), (100, None), (101, ""), (102, rows[7][1])]


@pytest.mark.parametrize("window, seed, group_bytes", [(6, 3, 10_000_000), (5, 2, 400)])
def test_removal_equals_brute_force(documents, monkeypatch, window, seed, group_bytes):
    monkeypatch.setattr(repeats, "SEED_WORDS", seed)
    rows = passages(window)
    docs = documents(*rows).repartition(5)
    spans = repeats.repeated_spans(docs, window, seed, group_bytes)
    assert spans.count()
    monkeypatch.setattr(
        repeats, "repeated_spans", lambda d, w: spans
    )
    found = repeats.remove_repeats(docs, window).collect()
    got = sorted(((r["doc_id"], r["kept_text"] or "", r["n_removed"]) for r in found), key=str)
    assert got == brute_removed(rows, window)


def test_windows_of_a_frequent_phrase_are_dealt_to_many_groups(documents, monkeypatch):
    pick = random.Random(5)
    fresh = lambda n: [f"u{pick.random()}" for _ in range(n)]
    # A phrase that deals the windows around it, since hardly a prefix has a smaller hash.
    phrases = (["a", "b", f"c{n}"] for n in range(10_000))
    low = lambda p: repeats.sequence_hashes(Words(pa.array([" ".join(p)])).hashes(), np.zeros(1, int), 3)[0] < 2**57
    phrase = next(p for p in phrases if low(p))
    rows = [(i, " ".join(fresh(6) + phrase + fresh(6))) for i in range(300)]
    rows += [(300 + i, rows[i * 7][1]) for i in range(30)]
    subtree, most = repeats._subtree, 500

    def small_only(window, buckets):
        run = subtree(window, buckets)

        def checked(table):
            windows = sum(len(x.as_py()) // 8 for x in table.column("nodes"))
            assert windows <= most, f"{windows} windows in a group"
            return run(table)

        return checked

    monkeypatch.setattr(repeats, "_subtree", small_only)
    # Within slices of one text, nothing is settled ahead.
    cut = repeats.slices
    monkeypatch.setattr(repeats, "slices", lambda batches, *column: cut(batches, *column, most=1))
    docs = documents(*rows).repartition(5)
    spans = repeats.repeated_spans(docs, 6, 3, 8000)
    monkeypatch.setattr(repeats, "repeated_spans", lambda d, w: spans)
    found = repeats.remove_repeats(docs, 6).collect()
    got = sorted(((r["doc_id"], r["kept_text"] or "", r["n_removed"]) for r in found), key=str)
    assert got == brute_removed(rows, 6)


def test_equal_rows_layout_and_foreign_columns(documents, odd_columns):
    text = "a b\nc  d e"
    docs = odd_columns(documents((1, text), (1, text), (2, f"x\n{text} y"), (2, "a b c d z")))
    found = repeats.remove_repeats(docs, 4, layout=True).collect()
    assert sorted((r["doc_id"], r["kept_text"]) for r in found) == [
        (1, text), (1, text), (2, "x\ny"), (2, "z"),
    ]
    assert found[0]["kept"] == "x"
    assert repeats.remove_repeats(documents(), 4).count() == 0


def test_cut_words_without_layout_joins_by_one_space():
    assert repeats.cut_words(b" a  b\tc d ", [1], [3], False) == (b"a d", 4, 2)
    assert repeats.cut_words(b" a  b\tc d ", [0], [4], True) == (b" ", 4, 4)
