"""Texts rearranged for filling in the middle, against a plain version."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vinilo.llm import infill

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text, rate=50):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("n", [0, 1, 2, 5, 63, 4000])
def test_every_rank_is_reached(n):
    pick = random.Random(n)
    widths = np.array([pick.randint(1, 9) for _ in range(n)], np.int64)
    units = infill.SkipList(widths)
    before = [0, *np.cumsum(widths).tolist()]
    ranks = range(n + 1) if n < 100 else pick.sample(range(n + 1), 300)
    assert all(units.points_before(r) == before[r] for r in ranks)


def test_lanes_thin_out():
    units = infill.SkipList(np.ones(10_000, np.int64))
    sizes = [len(lane[0]) for lane in units.lanes]
    assert sizes[0] == 10_000 and all(2 * b < a for a, b in zip(sizes, sizes[1:-3]))
    for lengths, widths in units.lanes[1:]:
        assert lengths == widths  # every unit is one code point wide


def texts():
    pick = random.Random(4)
    blanks = [" ", "\n", "\t ", "  ", "\x0b\x0c\r", " ", " "]
    words = ["the", "é", "ßà", "日本語", "🙂🙂", "a-b", "<", "<S", "P>", "<p>", "<<"]
    made = []
    for i in range(300):
        made.append("".join(pick.choice(words + blanks * 2) for _ in range(pick.randint(0, 60))))
    made += [None, "", " ", "\n\n", "word", " word ", "x <P> y", "<M>", "long " * 60_000, "z" * 300_000]
    return made


def test_equals_a_plain_version(documents, odd_columns):
    rows = [(i * 7 if i % 11 else None, t) for i, t in enumerate(texts())]
    rows += [(5, "same words twice")] * 2 + [(9, "long " * 9000 + "<S>")]
    docs = odd_columns(documents(*rows))
    back = infill.restored(F.col("output"), F.col("form")).alias("back")
    got = infill.fill_in_middle(docs).select("*", back).collect()
    assert len(got) == len(rows)
    seen = {
        repr((r["doc_id"], r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]))
        for r in got
    }
    assert seen == {repr((i, *plain_version(i, t))) for i, t in rows}
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    for r in got:
        assert r["back"] == (r["text"] or "") and r["kept"] == "x" and r["node"] == "x"


def test_rate_and_empty_table(documents):
    docs = documents(*[(i, f"some words of text {i}") for i in range(60)])
    every = infill.fill_in_middle(docs, rate=100, spm_share=0, carry=["doc_id"])
    assert {r["form"] for r in every.collect()} == {"psm"}
    assert every.columns == ["doc_id", *infill.NEW]
    assert infill.fill_in_middle(documents()).count() == 0
