"""Near duplicates: an exact join in the metric space of shingle sets under Jaccard distance.

Distance 1 - |A n B| / |A u B| is a metric; two documents link at a distance of at most 1 - ``MIN_SIMILARITY``.

1. Pivots and regions over the whole corpus. Documents of a corpus are at distance 1 from nearly every other, so whole
   documents make useless first pivots. The first pivots are single shingles {s}: a set lies at distance 1 - 1/n of
   those it holds and at 1 of all others. Their order decides between equally near ones, rare before common, so that
   regions stay small. A set's home is the region of its first pivot. A linked set may miss at most
   n - ceil(0.75 n) of a set's shingles, so each set is also placed into the regions of that many pivots after the
   first, and of k - 1 more, k = ``least_meetings(n)``: two linked sets meet in at least min(k, k') regions, and no other
   replication is needed.
2. Linked sets differ in size by a quarter of the larger at most. In a region of few sets all pairs whose sizes allow a link
   have met. In other regions, which grow with the corpus, pairs are not listed; there only the number of such regions
   is known for each set, and two sets meet in no more of them than the one in fewer. Pairs that, with these,
   meet too seldom are no candidates. A linked pair that meets in no region of few sets meets in enough others, so
   sets in as many others as that are ordered by size in each, and neighbours in that order are connected unless they
   differ by more. Texts that only share a passage are in too few. What is connected forms a candidate group.
   Only these texts are read again.
3. Inside a group, documents are pivots. Groups that no task should hold fall apart as Spark rows (``metric_rounds``): sets
   linked to a pivot are connected at once, and only what the triangle inequality leaves is compared on. Within a task
   every set goes to its nearest pivot's region, and also to any other pivot's region no more than twice the radius
   farther, recursively, until a region is small or no longer shrinks. There pairs are compared exactly, except those
   already known to be connected.

Equal sets are one row a task in step 2, and one from step 3 on. Hot first-level pivots are salted by count.

The order of pivots only affects speed. It comes from counts over all documents: word frequencies and shingles that
repeat within a batch (lossy counting); both tables are bounded by a constant before they are sent to the tasks.

Texts without words, null texts and empty texts have an empty set and link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.llm.common import (
    bit_table, id_and_text, maybe_in, md5, most_frequent, rows_that_stay, utf8, windows, word_hashes, words,
)
from evenweave.llm.components import components
from evenweave.llm.metric_rounds import UNIT_COLUMNS, blocks_of, regions_to_compare, whole_regions
from evenweave.session import materialize, new_run_dir

SHINGLE = 5
MIN_SIMILARITY = 75  # percent
HOT_SHINGLES = 1 << 18
COMMON_WORDS = 1 << 16
BATCH_SHINGLES = 2_000_000
FEW = 16  # sets of a region whose pairs are listed
MEETING = 32  # shingles for each further meeting that a pair must have
DONE = 200_000  # sets a task of step 2 remembers
PIVOTS = 8
LEAF = 48
SALT_ABOVE = 4096
BROADCAST_ROWS = 250_000  # candidates up to this number are sent to the texts, beyond it the texts are shuffled


def shingles_of(text: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, where each first occurs, and the hashes of the words."""
    hashes = word_hashes(words(text.lower()))
    unique, first = np.unique(windows(hashes, size), return_index=True)
    return unique, first, hashes


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


SIZE_SHIFT = 43
_LARGEST = (1 << 20) - 1


def near_key(key: bytes, n: int) -> int:
    """What regions carry of a set: its size, then 43 bits of its key, so order by it is order by size.

    Sets that share it by chance share a node in the search for candidates, no more. Sizes beyond a million count as
    that, which only lets more pairs meet.
    """
    return min(n, _LARGEST) << SIZE_SHIFT | int.from_bytes(key[:8], "big") >> (64 - SIZE_SHIFT)


# --- pass 1: one row per document, and counts for the order of the pivots --------------------------------------------

def _survey(docs: DataFrame, size: int) -> DataFrame:
    id_field = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    schema = T.StructType([
        id_field, *T.StructType.fromDDL("kind string, key long, n long, set_key binary, text_md5 binary, n_bytes int").fields
    ])

    def counts(kind: str, parts: list[np.ndarray], least: int, nulls: pa.Array) -> pa.RecordBatch:
        value, n = np.unique(np.concatenate(parts), return_counts=True)
        value, n = value[n >= least].view(np.int64), n[n >= least]
        none = pa.nulls(len(n), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(n), nulls.type), pa.array([kind] * len(n), pa.string()), pa.array(value), pa.array(n), none, none,
             pa.nulls(len(n), pa.int32())],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen, held, ids = [], [], 0, None
        for batch in batches:
            ids, keys, sizes, digests, lengths = batch.column(0), [], [], [], []
            for text in utf8(batch.column(1)):
                unique, _, hashes = shingles_of(text, size)
                keys.append(set_key(unique)), sizes.append(len(unique)), digests.append(md5(text))
                lengths.append(len(text))
                sets.append(unique), seen.append(hashes)
                held += len(hashes)
            near = list(map(near_key, keys, sizes))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(["d"] * len(keys), pa.string()), pa.array(near, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(digests, pa.binary()), pa.array(lengths, pa.int32())], names=schema.names)
            if held >= BATCH_SHINGLES:
                yield counts("s", sets, 2, ids)
                yield counts("w", seen, 16, ids)
                sets, seen, held = [], [], 0
        if sets:
            yield counts("s", sets, 2, ids)
            yield counts("w", seen, 16, ids)

    return docs.mapInArrow(run, schema)


def _table(survey: DataFrame, kind: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the highest counts as sorted keys and counts."""
    counts = survey.where(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("n"))
    rows = most_frequent(counts, "n", most).collect()
    keys = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    n = np.array([r[1] for r in rows], np.int64)
    order = np.argsort(keys)
    return keys[order], n[order]


def least_meetings(n):
    """Regions in which a set of ``n`` shingles meets every linked set of as many meetings or more."""
    return 1 + n // MEETING


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    known, n = table
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, n[at], 0)


# --- pass 2: first-level regions --------------------------------------------------------------------------------------

def prefix(unique, first, hashes, hot, common, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A set's home pivot and those of its window, and the counts of the hot ones among them."""
    n = len(unique)
    if not n:
        return unique, np.zeros(0, np.int64)
    width = min(size, len(hashes))
    weight = np.log2(1.0 + _look_up(common, hashes))
    total = np.concatenate([[0.0], np.cumsum(np.round(weight * 16).astype(np.int64))]).astype(np.int64)
    frequent = total[first + width] - total[first]
    counts = _look_up(hot, unique)
    keep = n - -(-percent * n // 100) + least_meetings(min(n, _LARGEST))
    order = np.lexsort((unique, frequent, counts))[:keep]
    return unique[order], counts[order]


SALT_BITS = 12


def _salted(pivot: np.ndarray, n: np.ndarray, key: int) -> np.ndarray:
    """A pivot as regions carry it: even if it is one region, else its high bits, a salt by set, and a one."""
    parts = np.minimum(n // SALT_ABOVE + 1, (1 << (SALT_BITS - 1)) - 1)
    high = pivot >> np.uint64(SALT_BITS) << np.uint64(SALT_BITS)
    salted = high | (key % parts).astype(np.uint64) << np.uint64(1) | np.uint64(1)
    return np.where(n > SALT_ABOVE, salted, pivot & ~np.uint64(1))


def _regions(docs: DataFrame, hot, common, size: int, percent: int) -> DataFrame:
    """pivot, key: two numbers a row, as this is the largest shuffle"""
    shared = docs.sparkSession.sparkContext.broadcast((hot, common))
    schema = "pivot long, key long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (hot, common), done = shared.value, set()
        for batch in batches:
            pivots, keys = [], []
            if len(done) > DONE:
                done.clear()
            for text in utf8(batch.column(1)):
                unique, first, hashes = shingles_of(text, size)
                key = near_key(set_key(unique), len(unique))
                if not len(unique) or key in done:
                    continue
                done.add(key)
                pivot, n = prefix(unique, first, hashes, hot, common, size, percent)
                pivots.append(_salted(pivot, n, key))
                keys.append(np.full(len(pivot), key, np.int64))
            if pivots:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(pivots).view(np.int64)), pa.array(np.concatenate(keys))], names=["pivot", "key"])

    return docs.mapInArrow(run, schema)


def _candidate_edges(regions: DataFrame, run: str, percent: int) -> DataFrame:
    """Edges (a, b), b < a, that connect all sets that can be linked."""
    order = Window.partitionBy("pivot").orderBy("key")
    salted = F.col("pivot").bitwiseAND(F.lit(1)) == 1

    def size(key: str):
        return F.shiftright(key, SIZE_SHIFT)

    def near(low: str, high: str):
        return size(low) * 100 >= size(high) * percent

    def least(n):
        return 1 + F.floor(n / MEETING)

    once = regions.withColumn("before", F.lag("key").over(order)).where("before IS NULL OR before <> key")
    met = once.withColumns({"before": F.lag("key").over(order), "next": F.lead("key").over(order)})
    met = met.where(salted | near("before", "key") | near("key", "next"))
    met = met.withColumn("few", ~salted & (F.count("*").over(Window.partitionBy("pivot")) <= FEW))
    others = F.when(F.col("few"), F.collect_list("key").over(order.rowsBetween(-(FEW - 1), -1)))
    met = materialize(met.select("pivot", "key", "few", others.alias("others")), f"{run}/met")

    # Larger regions, and in how many of them a set is.
    crowded = met.where("NOT few").select("pivot", "key", F.count("*").over(Window.partitionBy("key")).alias("crowded"))
    crowded = materialize(crowded, f"{run}/crowded")
    counts = crowded.groupBy("key").agg(F.first("crowded").alias("crowded"))

    # Regions of few sets: pairs, how often they met, and how often they may have met in larger ones.
    pairs = met.where("few").select(F.col("key").alias("a"), F.explode("others").alias("b"))
    pairs = pairs.where(near("b", "a")).groupBy("a", "b").agg(F.count("*").alias("n"))
    for c in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("key").alias(c), F.col("crowded").alias(f"in_{c}")), c, "left")
    elsewhere = F.least(*(F.coalesce(f"in_{c}", F.lit(0)) for c in ("a", "b")))
    often = pairs.where(F.col("n") + elsewhere >= F.least(*(least(size(c)) for c in ("a", "b")))).select("a", "b")
    # Pairs that met in larger ones only: both sets are in as many as the smallest set linked to them meets others in.
    enough = crowded.where(F.col("crowded") >= least(F.ceil(size("key") * percent / 100)))
    chained = enough.select("pivot", "key", F.lag("key").over(order).alias("before"), F.when(
        salted, F.min("key").over(Window.partitionBy("pivot"))).alias("top"))
    chained = materialize(chained, f"{run}/chained")
    # Chains by size. Salted pivots: a star per salt, and a star of the stars.
    chains = chained.where(F.col("top").isNull() & near("before", "key")).select("key", "before")
    hot = chained.where("top IS NOT NULL")
    tops = hot.where("key = top").select(F.shiftright("pivot", SALT_BITS).alias("pivot"), "top").distinct()
    tops = tops.withColumn("first", F.min("top").over(Window.partitionBy("pivot")))
    return often.union(chains).union(hot.select("key", "top")).union(tops.select("top", "first")).where("a > b")


# --- pass 3: exact joins inside candidate groups ----------------------------------------------------------------------

class Groups:
    """Union-find over positions; the smallest position is the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    def join(self, i: int, others: np.ndarray) -> None:
        tops = {self.find(int(j)) for j in others} | {self.find(i)}
        low = min(tops)
        for t in tops:
            self.root[t] = low

    def all(self) -> np.ndarray:
        root = self.root
        while True:
            up = root[root]
            if np.array_equal(up, root):
                return root
            root = self.root = up


class Sets:
    """Shingle sets of one task as one array of codes, for the overlap of one set with many at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        vocabulary, codes = np.unique(flat, return_inverse=True)
        self.codes = codes.astype(np.int32)
        self.mark = np.zeros(len(vocabulary) + 1, bool)

    def of(self, i: int) -> np.ndarray:
        return self.codes[self.ends[i] : self.ends[i + 1]]

    def overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        mine = self.of(i)
        self.mark[mine] = True
        hits = np.array([np.count_nonzero(self.mark[self.of(j)]) for j in others.tolist()], np.int64)
        self.mark[mine] = False
        return hits

    def distances(self, i: int, others: np.ndarray) -> np.ndarray:
        hits = self.overlaps(i, others)
        return 1.0 - hits / (self.sizes[i] + self.sizes[others] - hits)


def metric_join(sets: Sets, members: np.ndarray, side: np.ndarray | None, groups: Groups, percent: int) -> None:
    """Connects all linked pairs of ``members``; pairs of one side are skipped if there are sides."""
    radius = 1 - percent / 100
    if len(members) > LEAF:
        pivots = members[np.linspace(0, len(members) - 1, PIVOTS).astype(int)]
        far = np.stack([sets.distances(int(p), members) for p in pivots], axis=1)
        home = far.argmin(axis=1)
        near = far.min(axis=1)
        inside = far <= near[:, None] + 2 * radius + 1e-9
        regions = [members[inside[:, j]] for j in range(PIVOTS) if (home == j).any()]
        if max(len(r) for r in regions) < len(members) and sum(len(r) for r in regions) < 2 * len(members):
            for region in regions:
                metric_join(sets, region, side, groups, percent)
            return
    for k in range(len(members) - 1):
        i, later = int(members[k]), members[k + 1 :]
        n = sets.sizes[i]
        fits = (100 * np.minimum(n, sets.sizes[later]) >= percent * np.maximum(n, sets.sizes[later]))
        if side is not None:
            fits &= side[later] != side[i]
        later = later[fits]
        if len(later):
            later = later[groups.all()[later] != groups.find(i)]
        if len(later):
            hits = sets.overlaps(i, later)
            linked = later[100 * hits >= percent * (n + sets.sizes[later] - hits)]
            if len(linked):
                groups.join(i, linked)


def _links(units: DataFrame, percent: int) -> DataFrame:
    """Star edges (a, b) between set keys, b < a, for rows of ``UNIT_COLUMNS``."""
    units = units.select(*UNIT_COLUMNS).repartition("region", "low", "high").sortWithinPartitions("region", "low", "high")

    def solve(both: bool, rows: dict[bytes, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        keys = sorted(rows)
        sets = Sets([rows[k][1] for k in keys])
        side = np.array([rows[k][0] for k in keys], bool) if both else None
        groups = Groups(len(keys))
        metric_join(sets, np.arange(len(keys)), side, groups, percent)
        found = [(keys[i], keys[r]) for i, r in enumerate(groups.all()) if i != r]
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, {}
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for r, (*now, side, key) in enumerate(zip(*columns)):
                if now != unit:
                    if len(rows) > 1:
                        yield solve(unit[3], rows)
                    unit, rows = now, {}
                values = batch.column(6)[r].values.to_numpy(zero_copy_only=False)
                rows[key] = (side, values.view(np.uint64))
        if len(rows) > 1:
            yield solve(unit[3], rows)

    return units.mapInArrow(run, "a binary, b binary")


def _group_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """region, n_sets, n_all, set_key, shingles for one document of every set in a candidate group."""
    texts = docs.select(F.xxhash64("doc_id").alias("hid"), F.octet_length("text").alias("n_bytes"), "text")
    texts = maybe_in(texts, "hid", bit_table(members, "hid"))
    if members.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    met = texts.join(members, ["hid", "n_bytes"]).select("text", "text_md5", "region", "n_sets", "n_all", "set_key")
    schema = "region long, n_sets long, n_all long, set_key binary, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            good = [i for i, d in enumerate(batch.column(1).to_pylist()) if md5(texts[i]) == d]
            sets = [shingles_of(texts[i], size)[0].view(np.int64) for i in good]
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(take) for k in (2, 3, 4, 5)), pa.array(sets, pa.list_(pa.int64()))],
                names=["region", "n_sets", "n_all", "set_key", "shingles"])

    return met.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = MIN_SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id it is connected to), label, text_md5.

    ``label`` tells groups apart even where ids are null; it is null for documents without words.
    """
    spark = docs.sparkSession
    run = new_run_dir(spark)
    base = id_and_text(docs, id_col, text_col)
    survey = materialize(_survey(base, size), f"{run}/survey")
    hot, common = _table(survey, "s", HOT_SHINGLES), _table(survey, "w", COMMON_WORDS)
    rows = survey.where("kind = 'd'").select("doc_id", "key", "n", "set_key", "text_md5", "n_bytes")

    edges = _candidate_edges(_regions(base, hot, common, size, percent), run, percent)
    labels = materialize(components(edges, f"{run}/candidates"), f"{run}/labels")

    # one document of each set, by what its text can be found with again
    some = F.min(F.struct("text_md5", F.xxhash64("doc_id").alias("hid"), "n_bytes"))
    sets = rows.where("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"), F.first("key").alias("key"), F.first("n").alias("n"), some.alias("some"))
    sets = materialize(sets, f"{run}/sets")
    grouped = materialize(
        sets.join(labels.withColumnRenamed("node", "key"), "key").withColumnRenamed("label", "region"), f"{run}/grouped")
    shape = grouped.groupBy("region").agg(F.count("*").alias("n_sets"), F.sum("n").alias("n_all"))
    large = materialize(shape.where(blocks_of(F.col("n_sets"), F.col("n_all")) > 1), f"{run}/large")
    if large.count() <= BROADCAST_ROWS:  # at most one group in a thousand sets is
        large = F.broadcast(large)
    members = grouped.join(large, "region", "left").select(
        "region", F.coalesce("n_sets", F.lit(1)).alias("n_sets"), F.coalesce("n_all", F.lit(1)).alias("n_all"), "set_key", "some.*")
    members = materialize(members, f"{run}/members")

    fits = blocks_of(F.col("n_sets"), F.col("n_all")) == 1
    small = whole_regions(_group_sets(base, members.where(fits), size))
    stars, units, _ = regions_to_compare(_group_sets(base, members.where(~fits), size), f"{run}/rounds", percent)
    links = materialize(stars.union(_links(small.union(units), percent)), f"{run}/links")
    joined = components(links, f"{run}/components")

    labelled = sets.join(joined.withColumnRenamed("node", "set_key"), "set_key", "left").select(
        "set_key", "first_id", F.coalesce("label", "set_key").alias("label"))
    labelled = materialize(labelled, f"{run}/labelled")
    lowest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    ids = materialize(labelled.join(lowest, "label").select("set_key", "label", "component_id"), f"{run}/ids")
    return rows.join(ids, "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label", "text_md5",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each group does: that of the smallest id.

    Documents without words all stay; of rows alike in id and text, one.
    """
    found = near_duplicates(docs, id_col, text_col).select(
        F.xxhash64("doc_id").alias("hid"), F.col("text_md5").alias("digest"), "doc_id", "label")
    found = materialize(found, f"{new_run_dir(docs.sparkSession)}/found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", "hid")).alias("first")
    stay = found.where("label IS NOT NULL").groupBy("label").agg(first).select("first.hid", "first.digest").distinct()
    stay = stay.withColumn("first", F.lit(True))
    found = found.join(stay, ["hid", "digest"], "left")
    found = found.select("hid", "digest", (F.col("label").isNull() | F.col("first").isNotNull()).alias("stays"))
    return rows_that_stay(docs, found, md5, id_col, text_col)
