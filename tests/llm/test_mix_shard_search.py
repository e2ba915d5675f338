"""Sharding, mixing and nearest codes against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vinilo.llm import mixing, ranks, sharding, topk


def test_running_sums_do_not_depend_on_buckets(spark):
    pick = random.Random(1)
    rows = [(pick.choice(["a", "b", None]), pick.randint(0, 30), n) for n in range(300)]
    frame = spark.createDataFrame(rows, "g string, v int, n int")
    want, sums = {}, Counter()
    for g, v, n in rows:
        want[n] = sums[g]
        sums[g] += v
    for size in (1, 7, 1000):
        found = ranks.running(frame, ["g"], F.expr(f"n div {size}"), ["n"], F.col("v"), "ahead")
        assert {r["n"]: r["ahead"] for r in found.collect()} == want
    assert ranks.hex_digits(0) == ranks.hex_digits(100_000) == 0
    assert ranks.hex_digits(1_600_001) == 2


def shard_rows(documents):
    pick = random.Random(2)
    rows = [(i, "t" * (i % 7), pick.choice("aaaabbc")) for i in range(501)]
    return documents(*rows, (None, None, None), (None, "x", None), (5, "dup", "a"), (5, "dup", "a"))


@pytest.mark.parametrize("bucket_rows", [3, 100_000])
def test_shards_are_even_gapless_and_mixed(documents, odd_columns, bucket_rows):
    docs = odd_columns(shard_rows(documents))
    found = sharding.stratified_shards(docs, 8, identity=("doc_id", "text"), bucket_rows=bucket_rows)
    rows = found.collect()
    assert len(rows) == docs.count() and found.columns[-2:] == ["shard", "slot"]
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    assert sorted(by_shard) == list(range(8))
    sizes = [len(x) for x in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    whole = Counter(r["source"] for r in rows)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        mixture = Counter(r["source"] for r in own)
        # A contiguous cut of evenly spread ranks is at most one row off.
        assert all(abs(mixture[s] - n / 8) <= 2 for s, n in whole.items())


def test_shards_repeat_and_handle_empty(documents):
    docs = shard_rows(documents)
    runs = [
        sharding.stratified_shards(d, 4, identity=("doc_id", "text")).collect()
        for d in (docs, docs.repartition(7))
    ]
    a, b = (sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in x) for x in runs)
    assert a == b
    assert sharding.stratified_shards(documents(), 8).count() == 0


def brute_targets(sizes):
    names = sorted({s for s, _ in sizes}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for x, n in sizes if x == s) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(total.values()), set()
    while True:
        left = budget - sum(2 * total[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * left / rest > 2 * total[s]}
        if not over:
            return {s: 2.0 * total[s] if s in full else weight[s] * left / rest for s in names}
        full |= over


def mix_rows(spark):
    pick = random.Random(3)
    rows = [(i, pick.choice(["a", "b", "c", "ä", "d", None]), pick.choice([0, 1, 5, 90])) for i in range(400)]
    rows += [(None, "a", 7), (4, "b", 3), (4, "b", 3), (999, "tiny", 1), (998, "none", 0), (997, "e", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, size long")


@pytest.mark.parametrize("block, bucket_rows", [(64, 100_000), (7, 5), (1, 100_000)])
def test_mix_meets_its_targets(spark, odd_columns, block, bucket_rows):
    rows, frame = mix_rows(spark)
    want = brute_targets([(s, n or 0) for _, s, n in rows])
    frame = frame.withColumn("slot", F.lit("x")).withColumn("rank", F.lit("x"))
    line, mixed = mixing.mix(frame, block=block, bucket_rows=bucket_rows)
    found = mixing.words_taken(line, mixed).collect()
    assert len(found) == len(rows)
    for source, target in want.items():
        own = [r for r in found if r["source"] == source]
        assert own[0]["target"] == pytest.approx(target)
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert sum(r["taken"] for r in own) == int(target + 1e-6)
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    pieces = mixed.collect()
    # Slots hold a block each, and no two pieces share words of a pass.
    used = Counter()
    for p in pieces:
        used[p["slot"]] += p["to_word"] - p["from_word"]
    assert max(used.values()) <= block
    spots = [(p["source"], p["line_start"], p["pass"], w) for p in pieces for w in range(p["from_word"], p["to_word"])]
    assert len(spots) == len(set(spots))
    again = mixing.mix(frame.repartition(5), block=block, bucket_rows=bucket_rows)
    key = lambda x: sorted((str(r["doc_id"]), str(r["source"]), r["size"], r["taken"]) for r in x)
    assert key(mixing.words_taken(*again).collect()) == key(found)


def test_small_sources_are_taken_whole_from_a_large_corpus(spark):
    rows = [(i, "abc"[i % 3], 500) for i in range(300)]
    rows += [(1000 + i, f"small {i // 2:02}" if i > 1 else None, 20 + i) for i in range(60)]
    want = brute_targets([(s, n) for _, s, n in rows])
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    line, mixed = mixing.mix(frame)
    found = mixing.words_taken(line, mixed).collect()
    for source, target in want.items():
        assert sum(r["taken"] for r in found if r["source"] == source) == int(target + 1e-6)
    used = Counter()
    for p in mixed.collect():
        used[p["slot"]] += p["to_word"] - p["from_word"]
    assert max(used.values()) <= mixing.BLOCK_WORDS


@pytest.mark.parametrize("words", [1_000_000, 10_900_000, 11_600_000])
def test_no_size_of_the_corpus_starves_a_source(spark, words):
    """One large source and twelve of 30 words, below and above a quarter million slots."""
    rows = [(i, "large", words // 40) for i in range(40)]
    rows += [(100 + i, f"tiny {i:02}", 30) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    want = brute_targets([(s, n) for _, s, n in rows])
    taken = Counter()
    for r in mixing.words_taken(*mixing.mix(frame)).collect():
        taken[r["source"]] += r["taken"]
    assert taken == {s: int(t + 1e-6) for s, t in want.items()}
    assert all(taken[f"tiny {i:02}"] == 60 for i in range(12))


def test_points_stay_exact(spark):
    """A slot far along the sequence has the point that exact arithmetic gives."""
    goals = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, target double")
    rows = mixing.schedule(spark, goals, 3000).collect()
    assert len(rows) == 3000
    for r in rows:
        point = (r["slot"] + 1) * mixing.GOLDEN % 2**64 / 2**64
        assert r["source"] == ("a" if point < 0.25 else "b")


def test_every_stretch_of_the_schedule_is_mixed(spark):
    goals = spark.createDataFrame(
        [("a", 0, 600.0), ("b", 0, 300.0), (None, 0, 100.0)], "source string, source_size long, target double"
    )
    rows = mixing.schedule(spark, goals, 1000).orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(1000))
    for source, share in (("a", 0.6), ("b", 0.3), (None, 0.1)):
        own = [r for r in rows if r["source"] == source]
        assert [r["rank"] for r in own] == list(range(len(own)))
        for cut in (100, 500, 900):
            assert abs(sum(r["slot"] < cut for r in own) - share * cut) <= 5


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.words_taken(*mixing.mix(empty)).count() == 0
    nothing = spark.createDataFrame([(1, "a", 0)], "doc_id long, source string, size long")
    assert [r["taken"] for r in mixing.words_taken(*mixing.mix(nothing)).collect()] == [0]


def brute_nearest(codes, queries, k):
    return {
        q: [
            (i, d)
            for d, i in sorted(
                ((c ^ code) & (2**64 - 1)).bit_count() * 10**6 + i for i, c in codes if i != q
            )[:k]
            for d, i in [divmod(d, 10**6)]
        ]
        if False
        else [
            (i, d)
            for d, i in sorted((((c ^ code) & (2**64 - 1)).bit_count(), i) for i, c in codes if i != q)[:k]
        ]
        for q, code in queries
    }


def test_nearest_codes_equal_brute_force(spark):
    pick = random.Random(4)
    base = [pick.getrandbits(64) for _ in range(6)]
    codes = []
    for i in range(400):
        code = pick.choice(base)
        for _ in range(pick.choice([0, 0, 1, 3, 9])):
            code ^= 1 << pick.randrange(64)
        codes.append((i, code - (1 << 64) if code >> 63 else code))
    index = spark.createDataFrame(codes, "id long, code long")
    queries = [codes[n] for n in range(0, 400, 40)] + [(5000, 0)]
    for k in (1, 10):
        found = topk.nearest_codes(
            index.union(index.limit(3)), spark.createDataFrame(queries, "id long, code long"), k
        ).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append((r["id"], r["distance"]))
        assert got == brute_nearest(codes, queries, k)


def test_nearest_codes_edges(spark):
    few = spark.createDataFrame([(1, 3), (2, 1), (3, 3)], "id long, code long")
    found = topk.nearest_codes(few, few, 10, bits=8, segment_bits=4).collect()
    assert sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in found) == [
        (1, 1, 3, 0), (1, 2, 2, 1), (2, 1, 1, 1), (2, 2, 3, 1), (3, 1, 1, 0), (3, 2, 2, 1),
    ]
    assert topk.nearest_codes(few, few.limit(0), 10, bits=8, segment_bits=4).count() == 0
    assert topk.nearest_codes(few.limit(0), few, 10, bits=8, segment_bits=4).count() == 0


def test_sign_codes(spark):
    rows = [(1, [0.5, -1.0, 0.0]), (2, [None, 2.0, 3.0]), (3, None), (4, [1.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "v long, e array<double>")
    assert {r["id"]: r["code"] for r in topk.sign_codes(frame, "v", "e", 3).collect()} == {1: 4, 2: 3}


@pytest.mark.parametrize("bits, wanted", [(64, 16), (64, 10), (64, 1), (8, 9), (10, 4)])
def test_segments_cover_the_code(bits, wanted):
    widths = topk.segment_widths(bits, wanted)
    assert sum(widths) == bits and widths[0] - widths[-1] in (0, 1)
    assert sorted(widths, reverse=True) == widths


def test_default_segments_equal_brute_force(spark):
    pick = [random.Random(i).randrange(-(2**62), 2**62) for i in range(400)]
    codes = spark.createDataFrame(list(enumerate(pick)), "id long, code long")
    exact = {}
    for q in range(20):
        away = ((((pick[q] ^ c) % 2**64).bit_count(), i) for i, c in enumerate(pick) if i != q)
        exact[q] = sorted(away)[:3]
    found = {}
    for r in topk.nearest_codes(codes, codes.filter("id < 20"), 3).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["distance"], r["id"]))
    assert found == exact
