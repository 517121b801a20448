"""CSV files with line breaks in cells, read by many tasks.

Spark splits a text file anywhere, and only a reader from the start knows whether a line break lies inside a cell. With doubled
quotes for quotes inside cells, a line break lies inside a cell if and only if the number of quotes before it is odd. So each
segment (the part of a file a task reads) reports its number of quotes, and what it would count under either
parity; a running sum over the segments of a file, a few numbers each, decides. With its parity every segment cuts its own
lines into records. Only a record that goes on into another segment is put together from its pieces by shuffle.

Quotes count wherever they stand, as writers quote every cell that holds one. Rows behind a quote that is never closed are
one record, as they are for a reader from the start. A header must end in the first segment of its file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenweave.session import materialize, new_run_dir

BROADCAST_ROWS = 100_000


def lines_of(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """value, file, block (where the segment starts): physical lines, in file order within a segment."""
    lines = spark.read.options(lineSep="\n", **options).text(paths)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Stretches of a batch that lie in one segment: its key, first row, number of rows."""
    files, blocks = batch.column("file"), batch.column("block").to_numpy()
    codes = files.dictionary_encode()
    code = codes.indices.to_numpy()
    change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (code[1:] != code[:-1])) + 1
    for low, high in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
        if high > low:
            yield (codes.dictionary[int(code[low])].as_py(), int(blocks[low])), low, high - low


def _quotes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Quotes of every line, and whether it is blank."""
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.or_(pc.equal(values, ""), pc.equal(values, "\r")).to_numpy(zero_copy_only=False)
    return quotes, blank


def summaries(lines: DataFrame) -> DataFrame:
    """file, block, quotes, ends_outside, ends_inside: a row a segment.

    The last two are the records that end in it if its first line starts outside or inside a cell.
    """
    names = ["file", "block", "quotes", "ends_outside", "ends_inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, [0, 0, 0]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, *total)], names=names)

        for batch in batches:
            for key, low, n in _runs(batch):
                if key != now:
                    if now is not None:
                        yield out()
                    now, total = key, [0, 0, 0]
                quotes, blank = _quotes(batch.column("value").slice(low, n))
                behind = (total[0] + np.cumsum(quotes)) & 1  # parity behind each line, had the segment started outside
                before = np.concatenate([[total[0] & 1], behind[:-1]])
                total[1] += int(((behind == 0) & ~(blank & (before == 0))).sum())
                total[2] += int(((behind == 1) & ~(blank & (before == 1))).sum())
                total[0] += int(quotes.sum())
        if now is not None:
            yield out()

    # A segment is one stretch of one task, so it has one row.
    return lines.mapInArrow(run, "file string, block long, quotes long, ends_outside long, ends_inside long")


def parities(found: DataFrame) -> DataFrame:
    """``summaries`` with ``inside``: whether the segment's first line starts inside a cell."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


def record_counts(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """file, rows: records of each file without its header. One pass, no line is shuffled."""
    known = parities(summaries(lines_of(spark, paths, **options)))
    ends = F.sum(F.when(F.col("inside"), F.col("ends_inside")).otherwise(F.col("ends_outside")))
    open_end = F.sum("quotes") % 2  # a record that the file's end closes
    return known.groupBy("file").agg(F.greatest(F.lit(0), ends + open_end - 1).alias("rows"))


def _records(lines: DataFrame) -> DataFrame:
    """file, block, part, text of records (part 0) and of pieces: 1 begins a record that the next segment goes on with, 2
    goes on with one. Headers are left out."""
    names = ["file", "block", "part", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parity, held, started = None, 0, [], False
        header = False
        out: list[tuple] = []

        def close(ended: bool) -> None:
            """One record, or what the segment holds of it."""
            nonlocal held, started, header
            text = "\n".join(held)
            if ended:
                text = text.removesuffix("\r")
            if header:
                header = False
            elif ended and started:
                out.append((*now, 0, text))
            else:
                out.append((*now, 1 if started else 2, text))
            held, started = [], True

        for batch in batches:
            inside = batch.column("inside").to_numpy(zero_copy_only=False)
            for key, low, n in _runs(batch):
                if key != now:
                    if held:
                        close(False)
                    now, parity = key, int(inside[low])
                    held, started, header = [], not parity, key[1] == 0
                values = batch.column("value").slice(low, n)
                quotes, blank = _quotes(values)
                for value, q, empty in zip(values.to_pylist(), quotes.tolist(), blank.tolist()):
                    if empty and not held and not parity:
                        continue
                    held.append(value)
                    parity ^= q & 1
                    if not parity:
                        close(True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out = []
        if held:
            close(False)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    return lines.mapInArrow(run, "file string, block long, part long, text string")


def records(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """text: the records of CSV files without their headers; a line break inside a cell stays in its record."""
    path = new_run_dir(spark)
    known = materialize(parities(summaries(lines_of(spark, paths, **options))), f"{path}/segments")
    start = known.select("file", "block", "inside")
    lines = lines_of(spark, paths, **options)
    if known.count() <= BROADCAST_ROWS:
        lines = lines.join(F.broadcast(start), ["file", "block"])
    else:  # a join by shuffle gives up the order, which the line's place restores
        place = lines.withColumn("place", F.monotonically_increasing_id())
        lines = place.join(start, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "place")
    found = materialize(_records(lines.select("value", "file", "block", "inside")), f"{path}/records")
    whole = found.where("part = 0").select("text")
    # Pieces: two a segment at most. The piece that goes on comes first in its segment, and belongs to the last begin before.
    order = Window.partitionBy("file").orderBy("block", F.desc("part"))
    pieces = found.where("part > 0").withColumn("nth", F.count_if(F.col("part") == 1).over(order))
    joined = pieces.groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct("block", -F.col("part"), "text"))).alias("p"))
    text = F.array_join(F.transform("p", lambda p: p["text"]), "\n")
    return whole.union(joined.select(F.regexp_replace(text, r"\r\z", "").alias("text")))
