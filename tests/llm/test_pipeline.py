"""The queries against their SQL, and the pipeline against a brute-force version."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from vinilo.llm import mixing, rules
from vinilo.llm.oracle import ORACLE
from vinilo.llm.queries import REGISTRY

from test_near_and_repeats import brute_components, brute_removed

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def shown(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows
    )


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    cursor = connection.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    result = REGISTRY[name](spark, str(DATA))
    assert sorted(columns) == sorted(result.columns)
    rows = result.collect()
    assert rows and shown(result.columns, rows) == shown(columns, cursor.fetchall())


WORDS_QUERY = "op11_spelling_variants"


def test_words_come_once_each(spark):
    rows = REGISTRY[WORDS_QUERY](spark, str(DATA)).collect()
    known = {r["word"]: r for r in rows}
    assert len(known) == len(rows) > 1000
    for r in rows:
        assert r["form"] is None or known[r["form"]]["n"] == r["form_n"] >= 10 * r["n"]


@pytest.mark.parametrize("name", sorted(REGISTRY.keys() - ORACLE.keys() - {WORDS_QUERY}))
def test_other_queries_return_a_row_per_document(spark, name):
    rows = REGISTRY[name](spark, str(DATA)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(200))
    if name == "op4_byte_bpe":
        import hashlib

        texts = spark.read.parquet(f"{DATA}/documents.parquet").collect()
        want = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in texts}
        assert {r["doc_id"]: r["decoded_sha256"] for r in rows} == want


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    start = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.saved(stage(spark, docs, str(DATA)), name.replace(" ", "-"))
        if name != "token ids":
            assert docs.columns == start.columns
        kept[name] = (before, docs.collect())

    before, after = kept["quality rules"]
    verdicts = {r["doc_id"] for r in rules.quality_rules(start).filter("kept").collect()}
    assert {r["doc_id"] for r in after} == verdicts < {r["doc_id"] for r in before}

    before, after = kept["near duplicates"]
    roots = brute_components([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert sorted(r["doc_id"] for r in after) == sorted(set(roots.values()))

    before, after = kept["repeated passages"]
    want = brute_removed([(r["doc_id"], r["text"]) for r in before], 20)
    got = sorted(((r["doc_id"], " ".join(r["text"].split()), None) for r in after), key=str)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = kept["source mix"]
    sizes = spark.createDataFrame(
        [(r["doc_id"], r["source"], len(r["text"].split())) for r in before],
        "doc_id long, source string, size long",
    )
    taken = mixing.words_taken(*mixing.mix(sizes)).collect()
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in taken if r["size"]}
    assert Counter(r["doc_id"] for r in after) == Counter({i: n for i, n in times.items() if n})

    before, after = kept["token ids"]
    assert len(before) == len(after) and all(r["round_trip"] for r in after)


def test_pipeline_of_nulls_repeats_and_nothing(spark, documents):
    clean = " ".join(["the", *[f"word{i}" for i in range(80)], "of"])
    docs = documents((1, clean), (1, clean), (2, clean.upper() + " the of"), (None, clean + " x"), (3, None))
    result = docs
    for _, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.saved(stage(spark, result, ""), "stage")
    assert {r["doc_id"] for r in result.collect()} <= {1, 2, None}
    result = documents()
    for _, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.saved(stage(spark, result, ""), "stage")
    assert result.count() == 0


def test_rows_of_one_id_go_only_for_their_own_text(spark, documents):
    def text(tag):
        return " ".join(["the", *[f"{tag}{i}" for i in range(80)], "of"])

    docs = documents(
        (1, text("a")), (1, text("b")), (1, text("b")), (2, text("c")), (2, text("a") + " x"),
        (3, text("d")), (4, text("d") + " y"), (None, text("e")), (None, text("e")), (None, text("d")),
        (None, text("f")), (5, None), (5, ""), (6, " "), (7, text("f")),
    )
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    texts = Counter(r["text"].split()[1] for r in kept if r["text"] and r["text"].strip())
    assert texts == Counter("a0 b0 c0 d0 e0 f0".split())
    ids = {r["text"].split()[1]: r["doc_id"] for r in kept if r["text"] and r["text"].strip()}
    assert ids["d0"] == 3 and ids["e0"] is None and ids["f0"] == 7 and ids["c0"] == 2
    assert sum(not (r["text"] or "").strip() for r in kept) == 3
    assert corpus_pipeline.near_duplicates(spark, documents(), "").count() == 0


def test_long_and_short_texts_pass_all_stages(spark, documents):
    long = " ".join(["the of and", *[f"w{i} the" for i in range(60_000)]])
    docs = documents((1, long), (2, " ".join(["the", *[f"v{i}" for i in range(80)]])), (3, "short"), (4, ""))
    result = docs
    for _, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.saved(stage(spark, result, ""), "stage")
    assert {r["doc_id"] for r in result.collect()} <= {1, 2}
