"""Row order judged by summaries that merge: no row is sorted, shuffled or sent anywhere.

Each task reads its rows as they lie and sums up every run of ascending row ids: its first and last id and key, and the first
row whose key is lower than the one before. Two runs that follow each other merge into one, so runs merge in a tree,
range by range, and a table that lies in row order comes down to one run a task at once. Gaps between ids and empty
tasks change nothing. Only if runs overlap, because rows lie out of order in storage, do summaries not decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 32
SCHEMA = (
    "first long, last long, first_key array<long>, last_key array<long>, first_labels array<string>, "
    "late long, late_labels array<string>, overlap boolean"
)
_KINDS = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(),
          pa.list_(pa.string()), pa.bool_()]
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


@dataclass(frozen=True)
class Run:
    """Rows of ascending ids: ends, and the first row below its predecessor."""

    first: int
    last: int
    first_key: list[int]
    last_key: list[int]
    first_labels: list[str | None]
    late: int | None = None
    late_labels: list[str | None] | None = None
    overlap: bool = False

    def then(self, other: Run) -> Run:
        """Both as one; ``other`` must not begin earlier."""
        late, labels = self.late, self.late_labels
        if late is None:
            if other.first_key < self.last_key:
                late, labels = other.first, other.first_labels
            else:
                late, labels = other.late, other.late_labels
        overlap = self.overlap or other.overlap or other.first <= self.last
        return replace(self, last=other.last, last_key=other.last_key, late=late, late_labels=labels, overlap=overlap)


def _batch(runs: list[Run]) -> pa.RecordBatch:
    columns = [[getattr(r, n) for r in runs] for n in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _runs_of(batch: pa.RecordBatch, ranks: int) -> Iterator[Run]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    keys = np.stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(ranks)], axis=1)
    lower = np.zeros(len(ids), bool)
    equal = np.ones(max(len(ids) - 1, 0), bool)
    for k in range(ranks):  # first rank that differs decides
        lower[1:] |= equal & (keys[1:, k] < keys[:-1, k])
        equal &= keys[1:, k] == keys[:-1, k]
    starts = np.concatenate([[0], np.flatnonzero(ids[1:] <= ids[:-1]) + 1])

    def labels(i: int) -> list[str | None]:
        return [batch.column(c)[i].as_py() for c in range(1 + ranks, batch.num_columns)]

    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
        at = a + 1 + np.flatnonzero(lower[a + 1 : b])[:1]
        late = int(at[0]) if len(at) else None
        yield Run(int(ids[a]), int(ids[b - 1]), keys[a].tolist(), keys[b - 1].tolist(), labels(a),
                  None if late is None else int(ids[late]), None if late is None else labels(late))


def order_runs(df: DataFrame, row_id: str, ranks: list[Column], labels: list[str]) -> DataFrame:
    """Runs of every task, in the order they lie; null ranks come first."""
    least = F.lit(-(1 << 63)).cast("long")
    keyed = df.select(
        F.col(row_id).cast("long").alias("_id"), *(F.coalesce(r.cast("long"), least).alias(f"_r{k}") for k, r in enumerate(ranks)),
        *(F.col(c).cast("string").alias(f"_l{k}") for k, c in enumerate(labels)))
    n = len(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for found in _runs_of(batch, n) if batch.num_rows else ():
                if now is None or found.first <= now.last:
                    done += [now] if now else []
                    now = found
                else:
                    now = now.then(found)
            if len(done) > 10_000:
                yield _batch(done)
                done = []
        yield _batch(done + ([now] if now else []))

    return keyed.mapInArrow(run, SCHEMA)


def merged(runs: DataFrame, ranges: int) -> DataFrame:
    """One run for each of so many ranges of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for row in batch.to_pylist():
                found = Run(**row)
                now = found if now is None else now.then(found)
        yield _batch([now] if now else [])

    spread = runs.repartitionByRange(ranges, "first") if ranges > 1 else runs.repartition(1)
    return spread.sortWithinPartitions("first").mapInArrow(run, SCHEMA)


def first_late_row(df: DataFrame, row_id: str, ranks: list[Column], labels: list[str]) -> Run | None:
    """The table as one run, None if it is empty; see ``overlap`` before trusting ``late``."""
    found = merged(merged(order_runs(df, row_id, ranks, labels), RANGES), 1).first()
    return Run(**found.asDict()) if found else None
