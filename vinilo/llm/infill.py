"""Texts rearranged for filling in the middle, cut by an indexable skip list.

A text is a row of units: words with the blanks before them, and blanks at the
end. Its skip list has a lane of all units and express lanes above, each of
about a quarter of the nodes below; every link carries how many units and how
many code points it passes. A cut at some unit is found by descending: along a
lane while its link stays within the rank, then one lane down.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import schema, unused
from vinilo.llm.wordarrays import SEPARATOR, Words, mixed, slices

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
RATE = 50
SPM_SHARE = 80
NEW = ("n_units", "form", "prefix_chars", "middle_chars", "output")

_towers = np.zeros(0, np.int64)


def towers(n: int) -> np.ndarray:
    """Heights of the first ``n`` nodes: each further lane takes one in four, by a hash of the rank."""
    global _towers
    if len(_towers) < n:
        x = mixed(np.arange(1, max(n, 1 << 14) + 1, dtype=np.uint64))
        lowest_bit = x & (~x + np.uint64(1))
        _towers = (np.log2(lowest_bit.astype(float)) // 2).astype(np.int64)
    return _towers[:n]


class SkipList:
    """Units of a text by rank; ``widths`` are their code points."""

    def __init__(self, widths: np.ndarray):
        self.size = len(widths)
        ranks, points, height = np.arange(1, self.size + 1), np.cumsum(widths), towers(self.size)
        self.lanes: list[tuple[list[int], list[int]]] = []
        self.below: list[list[int]] = []  # place of a lane's nodes in the lane under it
        while len(ranks):
            self.lanes.append(
                (np.diff(ranks, prepend=0).tolist(), np.diff(points, prepend=0).tolist())
            )
            up = np.flatnonzero(height >= len(self.lanes))
            self.below.append(up.tolist())
            ranks, points, height = ranks[up], points[up], height[up]

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        passed = points = link = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, widths = self.lanes[lane]
            while link < len(units) and passed + units[link] <= rank:
                passed += units[link]
                points += widths[link]
                link += 1
            if lane and link:
                link = self.below[lane - 1][link - 1] + 1
        return points


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers that depend on seed and id alone; a null id counts as no digits."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(name.encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _fill(seed: int, rate: int, spm_share: int, text: str, ident: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = Words(batch.column(text))
            points = np.append(0, np.cumsum((words.data & 0xC0) != 0x80))
            rows = []
            for i, (own, doc_id) in enumerate(
                zip(batch.column(text).to_pylist(), batch.column(ident).to_pylist())
            ):
                own = own or ""
                start, stop = words.bounds[i], words.bounds[i + 1]
                ends = words.stop[words.first[i] : words.first[i + 1]]
                if stop > start and SEPARATOR[words.data[stop - 1]]:
                    ends = np.append(ends, stop)
                n = len(ends)
                first, second, chance, order = draws(seed, doc_id)
                if not own or chance % 100 >= rate or any(m in own for m in MARKERS):
                    rows.append((n, "plain", None, None, own))
                    continue
                units = SkipList(np.diff(points[ends], prepend=points[start]))
                cuts = sorted((first % (n + 1), second % (n + 1)))
                a, b = (units.points_before(c) for c in cuts)
                prefix, middle, suffix = own[:a], own[a:b], own[b:]
                if order % 100 < spm_share:
                    form, out = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
                else:
                    form, out = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
                rows.append((n, form, a, b - a, out))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], *made], [*batch.schema.names[:-2], *NEW]
            )

    return run


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    rate: int = RATE,
    spm_share: int = SPM_SHARE,
    carry: list[str] | None = None,
) -> DataFrame:
    """``carry`` columns of ``docs`` (by default all) with n_units, form, prefix_chars, middle_chars, output.

    ``rate`` percent of the texts are rearranged, ``spm_share`` percent of them
    with the suffix first. Which ones and where they are cut depends on seed and
    doc_id, so rows of one id draw alike. Null and empty texts, and texts that
    hold a marker, stay plain; a plain text has null for the lengths. Cuts may
    leave any part empty. Row by row: repeated rows do not matter, an empty table
    stays empty, and a text, however long, needs memory for its own units only.
    Columns with the names of new ones are replaced.
    """
    keep = [c for c in (carry or docs.columns) if c.lower() not in NEW]
    text, ident = unused(keep, "text"), unused(keep, "doc_id")
    own = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("text").alias(text),
        F.col("doc_id").cast("long").alias(ident),
    )
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-2])
    return own.mapInArrow(
        _fill(seed, rate, spm_share, text, ident),
        schema(
            f"{fields}n_units long, form string, prefix_chars long, middle_chars long, output string"
        ),
    )


def restored(output: Column, form: Column) -> Column:
    """The text again. Texts in another form than plain hold no marker, so markers part them."""
    part = F.split(output, "|".join(map(re.escape, MARKERS)), -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
