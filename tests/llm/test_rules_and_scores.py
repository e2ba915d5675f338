"""Quality rules, the classifier and language-model scores against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vinilo.llm import classifier, langmodel, rules


def measures(text):
    text = text or ""
    words = text.encode().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def odd_texts():
    pick = random.Random(5)
    texts = [None, "", " \n\n", "a", "a b a b a b a", "é#ü * | <x>\nline\nline\n \nline ", "a\xa0b"]
    for _ in range(40):
        words = [pick.choice("the of and x y zz".split()) for _ in range(pick.randint(1, 90))]
        texts.append("".join(w + pick.choice([" ", "  ", "\n", "\t"]) for w in words))
    texts.append("w " * 20_000)
    texts.append(" ".join(f"w{i}" for i in range(20_000)))
    return texts


def test_measures_equal_brute_force(documents, odd_columns):
    texts = odd_texts()
    docs = odd_columns(documents(*enumerate(texts)))
    found = {r["doc_id"]: r for r in rules.quality_rules(docs).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        want = measures(text)
        assert tuple(found[i][n] for n in names) == want, text
        assert found[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert found[0]["slot"] == "x" and found[0]["kept"] is False
    assert rules.quality_rules(documents()).count() == 0


def test_rules_are_a_table(documents):
    clean = " ".join(["the", *[f"word{i}" for i in range(80)], "of"])
    docs = documents((1, clean), (2, clean.replace("word", "#|")), (None, clean), (1, clean))
    rows = rules.quality_rules(docs).select("kept", "failed_rules").collect()
    assert [r["kept"] for r in rows] == [True, False, True, True]
    assert rows[1]["failed_rules"] == ["symbol_ratio"]
    strict = rules.quality_rules(docs, [rules.Rule("n_words", 1000)])
    assert not strict.filter("kept").count()


def test_function_words_in_any_case(documents):
    body = [f"word{i}" for i in range(100)]
    mixed = " ".join([*body, *"The Of AND tO iN Is".split()])
    rows = rules.quality_rules(documents((1, mixed), (2, mixed.lower()), (3, " ".join(body)))).collect()
    assert [(r["n_stop_words"], r["kept"]) for r in rows] == [(6, True), (6, True), (0, False)]


def test_word_rules_bind_covered_languages_only(spark, documents):
    plain = " ".join(f"slovo{i}" for i in range(80))
    cyrillic = " ".join("слово" + "абвгд"[i % 5] * (i % 7) + str(i) for i in range(80))
    unspaced = " ".join("字" * 30 + str(i) for i in range(60))
    tags = [("en", plain), ("sk", plain), ("pt-BR", plain), ("EN_us", plain), (None, plain), (" ", plain)]
    tags += [(None, cyrillic), ("ru", cyrillic), ("ja", unspaced), (None, unspaced), (None, None)]
    docs = spark.createDataFrame(
        [(i, x[1], x[0]) for i, x in enumerate(tags)], "doc_id long, text string, lang string"
    )
    want = [False, True, True, False, False, False, True, True, True, True, False]
    assert [r["kept"] for r in rules.quality_rules(docs).collect()] == want
    want = [False] * 6 + [True] * 4 + [False]
    assert [r["kept"] for r in rules.quality_rules(docs.drop("lang")).collect()] == want
    # Symbols and repeats count in every language.
    noise = spark.createDataFrame([(1, " ".join(["a#b"] * 99), "ru")], docs.schema)
    assert not rules.quality_rules(noise).filter("kept").count()


def test_very_long_texts_are_judged_like_others(documents):
    long = " ".join(["the of and", *[f"w{i} the" for i in range(520_000)]])
    row = rules.quality_rules(documents((1, long))).drop("text").collect()[0]
    assert row["n_words"] == 1_040_003 and row["kept"]


def test_filter_on_the_verdict_is_cheap(documents):
    docs = documents(*[(i, " ".join(f"w{j}" for j in range(3000))) for i in range(20)])
    assert rules.quality_rules(docs).filter("NOT kept").select("doc_id", "text").count() == 20


def labelled(spark, documents, n=400):
    pick = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = pick.random() < 0.7
        words = [pick.choice("the of anble onre thion and erst".split()) for _ in range(60)]
        text = " ".join(words) if good else "!! ".join(words).upper()
        rows.append((i, text))
        labels.append((i, int(good)))
    return documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_classifier_ranks_held_out_rows(spark, documents):
    docs, labels, truth = labelled(spark, documents)
    rest = F.col("doc_id") % 4
    use = {"fit": rest < 2, "calibrate": rest == 3}
    found = classifier.quality_scores(docs, labels, use).collect()
    assert len(found) == len(truth)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    right = [r["predicted"] == truth[r["doc_id"]] for r in found if r["doc_id"] % 4 == 2]
    assert sum(right) >= 0.95 * len(right)
    # Labels outside fit and calibrate must not matter.
    flipped = labels.withColumn("quality", F.expr("CASE WHEN doc_id % 4 = 2 THEN 1 - quality ELSE quality END"))
    again = classifier.quality_scores(docs, flipped, use).collect()
    key = lambda r: r["doc_id"]
    for a, b in zip(sorted(found, key=key), sorted(again, key=key)):
        assert a["score"] == pytest.approx(b["score"])


def test_scores_equal_brute_force(spark, documents):
    docs, labels, truth = labelled(spark, documents)
    rest = F.col("doc_id") % 4
    use = {"fit": rest < 2, "calibrate": rest == 3}
    found = {r["doc_id"]: r["score"] for r in classifier.quality_scores(docs, labels, use).collect()}
    rows = sorted(classifier.document_statistics(docs, ["doc_id"]).collect(), key=lambda r: r["doc_id"])
    x = np.array([r["_statistics"] for r in rows])
    y = np.array([truth[r["doc_id"]] for r in rows])
    part = np.array([r["doc_id"] % 4 for r in rows])
    fit = x[part < 2]
    spread = np.where(fit.std(0) > 1e-9, fit.std(0), 1.0)
    random_ = np.random.default_rng(classifier.SEED)
    directions = random_.normal(size=(x.shape[1], classifier.FEATURES)) / classifier.WIDTH
    phases = random_.uniform(0, 2 * np.pi, classifier.FEATURES)
    scaled = np.clip((x - fit.mean(0)) / spread, -8, 8)
    mapped = np.cos(scaled @ directions + phases) * (2 / classifier.FEATURES) ** 0.5
    mapped = np.hstack([mapped, np.ones((len(x), 1))])
    # Ridge as least squares with a row per weight.
    root = np.diag([classifier.RIDGE**0.5] * classifier.FEATURES + [1e-9**0.5])
    above = np.vstack([mapped[part < 2], root])
    weights = np.linalg.lstsq(above, np.append(y[part < 2], np.zeros(len(root))), rcond=None)[0]
    cells = np.clip(((mapped @ weights + 0.5) / 2 * classifier.GRID).astype(int), 0, classifier.GRID - 1)
    ids = [r["doc_id"] for r in rows]
    fitted, target = cells[part == 3], y[part == 3].astype(float)
    places = np.unique(fitted)
    rate = np.array([target[fitted == c].mean() for c in places])
    weight = np.array([(fitted == c).sum() for c in places])
    # Isotonic: the largest, over starts up to a cell, of the least mean to an end beyond it.
    def mean(a, b):
        return np.average(rate[a : b + 1], weights=weight[a : b + 1])

    n = len(places)
    curve = [max(min(mean(a, b) for b in range(k, n)) for a in range(k + 1)) for k in range(n)]
    want = np.interp(cells, places, curve)
    differs = [i for i, w in zip(ids, want) if abs(found[i] - w) > 1e-6]
    # A raw score at the edge of a cell may fall on either side of it.
    assert len(differs) <= 2


def test_packed_sums_equal_whole_ones(spark):
    size = (classifier.FEATURES + 1) * (classifier.FEATURES + 2)
    parts = [np.random.default_rng(i).normal(size=size) for i in range(5)]
    rows = [
        (p, x.tobytes())
        for whole in parts
        for p, x in enumerate(np.array_split(whole, classifier.PIECES))
    ]
    packed = spark.createDataFrame(rows, "piece long, sums binary").repartition(7)
    assert np.allclose(classifier._total(packed).ravel(), sum(parts))
    assert not classifier._total(packed.limit(0)).any()


def test_classifier_edges(spark, documents, odd_columns):
    docs = odd_columns(documents((1, ""), (2, None), (None, "a b"), (3, "x" * 100_000), (3, "a")))
    none = spark.createDataFrame([], "doc_id long, quality int")
    use = {"fit": F.lit(True), "calibrate": F.lit(True)}
    found = classifier.quality_scores(docs, none, use).collect()
    assert len(found) == 5 and all(r["score"] == pytest.approx(0.5, abs=0.01) for r in found)
    odd = spark.createDataFrame([(1, 5), (None, 1), (2, None), (3, 1)], "doc_id long, quality int")
    assert classifier.quality_scores(docs, odd, use).count() == 5
    assert classifier.quality_scores(documents(), none, use).count() == 0


def test_isotonic_is_the_least_squares_curve():
    pick = np.random.default_rng(1)
    totals = pick.integers(0, 5, 40)
    positives = pick.binomial(totals, np.linspace(0.1, 0.9, 40))
    curve = classifier.isotonic(positives.astype(float), totals.astype(float))
    assert (np.diff(curve) >= -1e-12).all()
    seen = totals > 0
    rates, weights = positives[seen] / totals[seen], totals[seen]
    # The max-min formula.
    n = len(rates)
    for k in range(n):
        best = max(
            min(np.average(rates[i : j + 1], weights=weights[i : j + 1]) for j in range(k, n))
            for i in range(k + 1)
        )
        assert curve[seen][k] == pytest.approx(best)


def words_of(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def test_base_scores_equal_brute_force(documents, odd_columns):
    pick = random.Random(7)
    vocabulary = "the The of anble ANBLE onre thion é x".split()
    rows = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(0, 40)))) for i in range(80)]
    rows += [(80, None), (90, "unseen words"), (None, "left out"), (81, rows[1][1]), (81, rows[1][1])]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    found = langmodel.language_scores(odd_columns(documents(*rows)), held).collect()
    learned = [
        w for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10 for w in [*words_of(t), 0]
    ]
    counts, n = Counter(learned), len(learned)
    below = math.log10(n + 0.1 * (len(counts) + 1))
    want = sorted(
        (
            str(i),
            len(words_of(t)) + 1,
            sum(counts[w] > 0 for w in [*words_of(t), 0]),
            round(sum(math.log10(counts[w] + 0.1) - below for w in [*words_of(t), 0]), 6),
        )
        for i, t in rows
    )
    got = sorted(
        (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found
    )
    assert got == want
    assert {r["train_tokens"] for r in found} == {n}
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in found)


def test_model_is_a_distribution_over_bytes(spark, documents):
    """The probabilities of all one-byte words, each with its closing, add up to below one."""
    docs = documents(*[(i, "a b ab ba the of the a") for i in range(20)])
    frame = langmodel.saved(
        docs.limit(0).selectExpr("cast(null as binary) counts", "cast(null as binary) words", "cast(null as binary) lengths"),
        "none",
    )
    speller = langmodel.train(frame, 0)
    data = np.arange(256, dtype=np.uint8)
    starts = np.arange(256)
    scores = speller.word_scores(data, starts, starts + 1)
    end = speller.word_scores(data[:0], np.zeros(1, int), np.zeros(1, int))
    assert 0 < (10.0**scores).sum() + (10.0**end).sum() < 1
    # With nothing learned every bit is about even.
    assert scores == pytest.approx(np.full(256, -16 * math.log10(2)), abs=0.5)


def test_model_learns_spelling(documents):
    pick = random.Random(8)
    parts = "an ble on re thi ing er st tion ly".split()
    rows = [
        (i, " ".join("".join(pick.choices(parts, k=pick.randint(1, 4))) for _ in range(60)))
        for i in range(300)
    ]
    strange = " ".join("".join(pick.choices("qxzkwv", k=6)) for _ in range(60))
    scored = langmodel.language_scores(documents(*rows, (300, strange)), F.col("doc_id") % 5 == 0)
    found = {r["doc_id"]: r["bits_per_byte"] for r in scored.collect()}
    held = [found[i] for i in range(0, 300, 5)]
    # Words of one to four parts of ten take about 1.6 bits a byte.
    assert 1.4 < sum(held) / len(held) < 2.2
    assert found[300] > 2 * max(held)


def test_model_edges(documents):
    assert langmodel.language_scores(documents(), F.lit(False)).count() == 0
    assert langmodel.language_scores(documents((1, "a")), F.lit(True)).first()["n_known"] == 0


def scores_of(documents, texts, held_from):
    rows = [(i, t) for i, t in enumerate(texts)]
    scored = langmodel.language_scores(documents(*rows), F.col("doc_id") >= held_from)
    return {r["doc_id"]: r["score"] for r in scored.collect()}


def test_words_are_scored_in_their_order(documents):
    """The words before a word foresee it, so that a text and its words reversed score apart."""
    pick = random.Random(9)
    pairs = [(f"left{i}", f"right{i}") for i in range(12)]
    learned = [" ".join(w for p in pick.choices(pairs, k=30) for w in p) for _ in range(60)]
    new = [w for p in pick.choices(pairs, k=30) for w in p]
    found = scores_of(documents, [*learned, " ".join(new), " ".join(new[::-1])], 60)
    assert found[60] > found[61] + 10


def test_a_text_that_repeats_itself_gets_likelier_as_it_goes(documents):
    """Counts and weights follow the text; another row of the same slice does not enter."""
    pick = random.Random(10)
    words = [f"w{i}" for i in range(200)]
    learned = [" ".join(pick.choices(words, k=50)) for _ in range(80)]
    once = " ".join(pick.sample(words, 40))
    again = scores_of(documents, [*learned, once, " ".join([once] * 8)], 80)
    assert again[81] > 8 * again[80] * 0.9
    alone = scores_of(documents, [*learned, once], 80)
    assert alone[80] == pytest.approx(again[80], abs=1e-9)


def small_mixer(texts):
    """A code over the words of some texts, and their tokens, with hashed counts of them all."""
    words = sorted({w for t in texts for w in t.split()})
    hashes = np.arange(7, 7 + len(words), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.array([[sum(t.split().count(w) for t in texts)] for w in words])
    code = langmodel.Code.of(hashes, counts, [3], [len(texts)])
    sequence = np.array([words.index(w) for t in texts for w in t.split()], np.int64)
    n_words = np.array([len(t.split()) for t in texts])
    ((order, tokens),) = langmodel.texts_of(code, hashes, sequence, n_words, np.arange(len(texts)))
    size, node, turn = langmodel.paths(code, tokens.symbol)
    tables = []
    for context in tokens.contexts:
        slot = langmodel.context_slots(np.repeat(context, size), langmodel.salted_nodes(node))
        seen = np.zeros((2, 1 << langmodel.CONTEXT_BITS))
        np.add.at(seen, (turn, slot), 1)
        tables.append(langmodel.known_odds(*seen))
    return code, tokens, langmodel.Mixer(tables), order


def symbols_before(tokens, d, back):
    """The symbol so many places before each token of a text, -1 before its first."""
    return ([-1] * back + tokens.symbol[tokens.doc == d].tolist())[: (tokens.doc == d).sum()]


def test_mixed_scores_equal_brute_force():
    """Bit by bit in plain Python, with dictionaries of a single text's counts."""
    pick = random.Random(11)
    texts = [" ".join(pick.choices("a b c d e f g".split(), k=k)) for k in (0, 1, 9, 30, 70)]
    code, tokens, mixer, order = small_mixer(texts)
    texts = [texts[i] for i in order]
    found = np.bincount(tokens.doc, mixer.read(code, tokens))
    limit, width = langmodel.STRETCH_LIMIT, langmodel.REFINE_STEPS

    def odds_of(zero, one):
        return min(max(math.log((one + langmodel.PRIOR) / (zero + langmodel.PRIOR)), -limit), limit)

    contexts = {1: Counter(), 2: Counter()}
    for d in range(len(texts)):
        for before in contexts:
            past = list(zip(*[symbols_before(tokens, d, b) for b in range(before, 0, -1)]))
            for here, s in zip(past, tokens.symbol[tokens.doc == d]):
                for e in range(code.first[s], code.first[s + 1]):
                    contexts[before][here, int(code.nodes[e]), int(code.turns[e])] += 1
    for d, text in enumerate(texts):
        weights, hits, own = {}, Counter(), Counter()
        room = 1
        while room < (len(text.split()) + 1) * langmodel.OWN_SLOTS:
            room *= 2
        total, learn = 0.0, []
        for place, t in enumerate(np.flatnonzero(tokens.doc == d)):
            if place % langmodel.BLOCK == 0:
                for at, x, wrong, cell, turn, slot in learn:
                    weights[at] = [w + langmodel.ONLINE_RATE * wrong * i for w, i in zip(weights[at], x)]
                    hits[cell, turn] += 1
                    own[slot, turn] += 1
                learn = []
            s = tokens.symbol[t]
            for e in range(code.first[s], code.first[s + 1]):
                node, turn = int(code.nodes[e]), int(code.turns[e])
                pairs = [tuple(code.counts[0, node])]
                for before in (1, 2):
                    here = tuple(symbols_before(tokens, d, b)[place] for b in range(before, 0, -1))
                    pairs.append(tuple(contexts[before][here, node, v] for v in (0, 1)))
                slot = node & (room - 1)
                pairs.append((own[slot, 0], own[slot, 1]))
                one, two = (int(min(math.log2(sum(p) + 1), 3)) for p in pairs[1:3])
                gate = two * 4 + one
                x = [odds_of(*p) for p in pairs]
                used = weights.setdefault(gate, list(langmodel.START_WEIGHTS))
                mix = min(max(sum(w * i for w, i in zip(used, x)), -limit), limit)
                cell = int((mix + limit) * (width - 1) / (2 * limit) + 0.5)
                even = 1 / (1 + math.exp(limit - cell * 2 * limit / (width - 1)))
                p = 1 / (1 + math.exp(-mix))
                prior, seen = langmodel.REFINE_PRIOR, hits[cell, 0] + hits[cell, 1]
                q = (p + (even * prior + hits[cell, 1]) / (prior + seen)) / 2
                total += math.log10(q if turn else 1 - q)
                learn.append((gate, x, turn - p, cell, turn, slot))
        assert found[d] == pytest.approx(total, rel=2e-3, abs=2e-3)


def test_code_paths_are_a_distribution():
    """What may follow a text adds up to one, however its weights have moved."""
    code, tokens, mixer, order = small_mixer(["a b a c", "b b a", "d " * 30])
    size, total = len(code.first) - 1, 0.0
    for symbol in range(size):
        last = tokens.doc == list(order).index(2)
        tokens.symbol[np.flatnonzero(last)[-1]] = symbol
        total += 10 ** mixer.read(code, tokens)[last][-1]
    assert total == pytest.approx(1, abs=1e-5)


def test_log_odds_of_contexts_are_worked_out_before_the_driver():
    """The driver gets two bytes a slot, not the counts, which took several times its room."""
    pick = np.random.default_rng(12)
    counts = pick.integers(0, 90_000, (3, 64, 2)) * pick.integers(0, 2, (3, 64, 1))
    rows = [{"kind": "0", "i": 5, "values": langmodel._planes(c.ravel())} for c in counts]
    found = langmodel._add_contexts(pa.Table.from_pylist(rows, schema=langmodel._BLOB)).to_pylist()
    assert [(r["kind"], r["i"], len(r["values"])) for r in found] == [("0", 5, 64 * 2)]
    got = np.frombuffer(found[0]["values"], np.int16)
    total = counts.sum(0)
    odds = np.log((total[:, 1] + langmodel.PRIOR) / (total[:, 0] + langmodel.PRIOR))
    assert (got >> 2) / 1000 == pytest.approx(np.clip(odds, -8, 8), abs=2e-3)
    assert ((got & 3) == np.minimum(np.log2(total.sum(1) + 1), 3).astype(int)).all()


def test_slots_of_a_path_stand_together():
    """A path's bits after one context are read from a few stretches of the table, not one each."""
    counts = (np.arange(1, 3001)[:, None] ** 2) // 500 + 1
    hashes = langmodel.mixed(np.arange(1, 3001, dtype=np.uint64))
    code = langmodel.Code.of(hashes, counts, [3], [100])
    assert sorted(set(code.nodes.tolist())) == list(range(3001))
    symbol = np.arange(3002)
    size, node, turn = langmodel.paths(code, symbol)
    assert (node == code.nodes).all() and (turn == code.turns).all()
    context = np.repeat(langmodel.mixed(symbol.astype(np.uint64)).astype(np.uint32), size)
    slot = langmodel.context_slots(context, langmodel.salted_nodes(node))
    owner = np.repeat(symbol, size)
    assert len(set(zip(owner, node))) == len(set(zip(owner, slot)))
    assert len(set(zip(owner, slot >> langmodel.LINE_BITS))) < 0.5 * len(node)
