"""Quality classifier on random Fourier features of document statistics.

Statistics are standardised and mapped by cosines of random directions, which
approximates a Gaussian kernel. Every task sums its share of the normal
equations; their sum, of fixed size, gives the ridge weights. Raw scores are
calibrated by isotonic regression over a fixed grid, on rows the weights have
not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import saved, schema
from vinilo.llm.wordarrays import LOWER, Words, sequence_hashes, slices

FEATURES = 256
WIDTH = 3.0
RIDGE = 1.0
GRID = 2000
SEED = 20
PIECES = 16
FIRST_SUMS = 256
# Bytes by class: capitals, small letters, digits, stops, other ASCII marks, beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[[0x20, *range(9, 14)]] = 0
_CLASS[0x41:0x5B] = 1
_CLASS[0x61:0x7B] = 2
_CLASS[0x30:0x3A] = 3
_CLASS[[ord(c) for c in ".,;:?'\"-"]] = 4
_CLASS[0x80:] = 5
STATISTICS = 18


def statistics(words: Words) -> np.ndarray:
    """A row of statistics per document, of its bytes, words and lines; zeros for an empty text."""
    n = words.documents
    data, bounds = words.data, words.bounds
    size = np.diff(bounds)
    owner = np.repeat(np.arange(n), size)
    classes = np.bincount(owner * 7 + _CLASS[data], minlength=7 * n).reshape(n, 7)
    newline = np.bincount(owner[data == 0x0A], minlength=n)
    length = (words.stop - words.start).astype(float)
    word_of = words.document

    def mean(values) -> np.ndarray:
        total = np.bincount(word_of, values, minlength=n)
        return total / np.maximum(words.count, 1)

    hashes = words.hashes()
    follows = np.append(False, word_of[1:] == word_of[:-1])[: len(hashes)]
    again = follows & np.append(False, hashes[1:] == hashes[:-1])[: len(hashes)]

    def distinct(values, of) -> np.ndarray:
        if not len(values):
            return np.zeros(n)
        order = np.lexsort((values, of))
        values, of = values[order], of[order]
        new = np.append(True, (values[1:] != values[:-1]) | (of[1:] != of[:-1]))
        return np.bincount(of[new], minlength=n)

    pairs = np.flatnonzero(follows) - 1
    pair_count = np.maximum(words.count - 1, 0)
    first = data[words.start] if len(hashes) else data[:0]
    last = data[words.stop - 1] if len(hashes) else data[:0]
    average = mean(length)
    with np.errstate(divide="ignore"):
        columns = [
            np.log1p(words.count),
            np.log1p(size),
            average,
            np.sqrt(np.maximum(mean(length**2) - average**2, 0)),
            *(classes / np.maximum(size, 1)[:, None]).T[1:],
            mean(again),
            distinct(hashes, word_of) / np.maximum(words.count, 1),
            distinct(sequence_hashes(hashes, pairs, 2), word_of[pairs]) / np.maximum(pair_count, 1),
            mean((first >= 0x41) & (first <= 0x5A)),
            mean((last == ord(".")) | (last == ord(","))),
            mean(length <= 3),
            mean(_CLASS[last] == 6),
            newline / np.maximum(words.count, 1),
        ]
    return np.stack(columns, axis=1).astype(float)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text"):
        found = statistics(Words(batch.column("_text")))
        ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(found.ravel()))],
            [*batch.schema.names[:-1], "_statistics"],
        )


def document_statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    own = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    return own.mapInArrow(_statistics, schema(f"{fields}_statistics array<double>"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("_statistics").flatten().to_numpy()
    return values.reshape(batch.num_rows, -1)


@dataclass
class Scorer:
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    grid: np.ndarray | None = None

    def features(self, statistics: np.ndarray) -> np.ndarray:
        """Random Fourier features, from a fixed seed, and a constant."""
        random = np.random.default_rng(SEED)
        directions = random.normal(size=(statistics.shape[1], FEATURES)) / WIDTH
        phases = random.uniform(0, 2 * np.pi, FEATURES)
        standard = np.clip((statistics - self.center) / self.spread, -8, 8)
        cosines = np.cos(standard @ directions + phases) * np.sqrt(2 / FEATURES)
        return np.hstack([cosines, np.ones((len(cosines), 1))])

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.features(statistics) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        """Calibrated probability, by place on the grid."""
        return self.grid[cell(self.raw(statistics))]


def cell(raw: np.ndarray) -> np.ndarray:
    """Raw scores lie about 0 to 1; the grid spans -0.5 to 1.5."""
    return np.clip(((raw + 0.5) / 2 * GRID).astype(np.int64), 0, GRID - 1)


def isotonic(positives: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Non-decreasing rates closest to positives / totals; cells without rows interpolate."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(totals):
        blocks.append([positives[i], totals[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, t, _, last = blocks.pop()
            blocks[-1][0] += p
            blocks[-1][1] += t
            blocks[-1][3] = last
    if not blocks:
        return np.linspace(0, 1, len(totals))
    places = [x for block in blocks for x in block[2:]]
    rates = [block[0] / block[1] for block in blocks for _ in range(2)]
    return np.interp(np.arange(len(totals)), places, rates)


def _equations(send):
    """The sums over a task's rows, packed into PIECES rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, total = Scorer(*send), np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x = scorer.features(_matrix(batch))
            y = batch.column("_label").to_numpy().astype(float)
            total += x.T @ np.hstack([x, y[:, None]])
        pieces = np.array_split(total.ravel(), PIECES)
        yield pa.RecordBatch.from_pydict(
            {"piece": np.arange(PIECES), "sums": [p.tobytes() for p in pieces]}
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    sums = sum(np.frombuffer(x.as_buffer()) for x in table.column("sums"))
    return pa.table({"piece": table.column("piece").slice(0, 1), "sums": [sums.tobytes()]})


def _total(equations: DataFrame) -> np.ndarray:
    """Pieces of all tasks added up, first within FIRST_SUMS groups of tasks each."""
    packed = schema("piece long, sums binary")
    some = equations.withColumn("_of", F.pmod(F.spark_partition_id(), F.lit(FIRST_SUMS)))
    first = some.groupBy("piece", "_of").applyInArrow(
        lambda table: _added(table.drop_columns("_of")), packed
    )
    rows = first.groupBy("piece").applyInArrow(_added, packed).collect()
    sums = [np.frombuffer(bytes(r["sums"])) for r in sorted(rows, key=lambda r: r["piece"])]
    flat = np.concatenate(sums) if sums else np.zeros((FEATURES + 1) * (FEATURES + 2))
    return flat.reshape(FEATURES + 1, FEATURES + 2)


def _cells(send):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, found = Scorer(*send), np.zeros((2, GRID), np.int64)
        for batch in batches:
            at = cell(scorer.raw(_matrix(batch)))
            y = batch.column("_label").to_numpy()
            found += [np.bincount(at, y, minlength=GRID).astype(np.int64), np.bincount(at, minlength=GRID)]
        yield pa.RecordBatch.from_pydict(
            {"i": np.arange(GRID), "positives": found[0], "total": found[1]}
        )

    return run


def _scores(send):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*send)
        for batch in batches:
            scores = scorer.score(_matrix(batch))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "score"]
            )

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    use: dict[str, object],
    label: str = "quality",
    threshold: float = 0.7,
) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text, ...).

    ``labels`` is (doc_id, label, ...) and ``use`` holds two conditions on its
    doc_id, "fit" for the ridge weights and "calibrate" for the isotonic curve. A
    score looks at the text alone; a null text is an empty one. Labels that are
    neither 0 nor 1 and null ids teach nothing; a row per label is learned from,
    repeated ones alike. Without rows to learn from scores rise with nothing and
    are 0.5; without rows to calibrate raw scores are used. Empty tables give
    empty results. The sums that reach the driver have fixed sizes.
    """
    table = saved(
        document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]),
        "statistics",
    )
    known = saved(
        table.join(
            labels.filter(F.col(label).isin(0, 1)).select(
                F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("_label")
            ),
            "doc_id",
        ),
        "labelled",
    )
    spots = [F.col("_statistics")[i] for i in range(STATISTICS)]
    moments = known.filter(use["fit"]).agg(
        *[F.coalesce(F.avg(s), F.lit(0.0)) for s in spots],
        *[F.coalesce(F.stddev_pop(s), F.lit(0.0)) for s in spots],
    ).first()
    center, spread = np.array(moments[:STATISTICS]), np.array(moments[STATISTICS:])
    spread = np.where(spread > 1e-9, spread, 1.0)
    send = (center, spread, np.zeros(FEATURES + 1))
    equations = (
        known.filter(use["fit"])
        .select("_statistics", "_label")
        .mapInArrow(_equations(send), schema("piece long, sums binary"))
    )
    sums = _total(equations)
    ridge = np.eye(FEATURES + 1) * RIDGE
    ridge[-1, -1] = 1e-9
    weights = np.linalg.solve(sums[:, :-1] + ridge, sums[:, -1])
    if not sums[-1, -2]:
        weights[-1] = 0.5
    send = (center, spread, weights)
    rates = (
        known.filter(use["calibrate"])
        .select("_statistics", "_label")
        .mapInArrow(_cells(send), schema("i long, positives long, total long"))
        .groupBy("i")
        .agg(F.sum("positives").alias("positives"), F.sum("total").alias("total"))
        .collect()
    )
    grid = np.zeros((2, GRID))
    for row in rates:
        grid[:, row["i"]] = row["positives"], row["total"]
    if grid[1].any():
        curve = isotonic(*grid)
    else:
        curve = np.clip(np.linspace(-0.5, 1.5, GRID), 0, 1)
    scored = table.mapInArrow(
        _scores((center, spread, weights, curve)), schema("doc_id long, score double")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
