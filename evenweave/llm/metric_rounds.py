"""Large groups of shingle sets fall apart by pivots, as Spark rows: distances, balls, triangle windows, smaller regions.

A round over all regions that no task should hold:

1. ``PIVOTS`` sets of a region are its pivots: half by chance, half those nearest to the pivots of the round before, as central
   sets have the largest balls. They are sent to the region's sets, which are dealt out by salt; every set gets its exact
   distances. No set is sent twice.
2. A set linked to a pivot lies in its ball; that is a star edge. Balls that share a set are one component, and pairs inside
   a component are never compared.
3. Another set can link with one in the ball of pivot p only if it lies no farther than twice the radius from p, and no
   farther than the radius from the distance of that one. If there are such visitors, the sets of the ball inside that window and
   the visitors are a region of two sides. If there are none, the ball is done, whatever its size.
4. Sets in no ball are the region of the next round.

Regions that fit are compared exactly in one task. Regions of two sides that do not fit, and rests that do not shrink, are
dealt out in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenweave.llm.common import bit_table, maybe_in
from evenweave.session import materialize

PIVOTS = 16
BLOCK = 1024  # sets a task holds of either side
BLOCK_SHINGLES = 2_000_000
SHRINK = 0.75  # a rest larger than this share of its region is not worth another round
BROADCAST_ROWS = 100_000
_SLACK = 1e-9
UNIT_COLUMNS = ("region", "low", "high", "both", "side", "set_key", "shingles")


def blocks_of(count, shingles):
    """Number of blocks for so many sets with so many shingles."""
    return F.greatest(F.lit(1), F.ceil(count / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _small(df: DataFrame) -> DataFrame:
    """A written table with a row per region: sent to the tasks if it is small, else joined by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _pivots(big: DataFrame, turn: int, path: str) -> DataFrame:
    """region, salts, nth, set_key, shingles of the pivots."""
    half, hashed = PIVOTS // 2, F.xxhash64("set_key", F.lit(turn))
    lowest = [F.min(F.struct(F.xxhash64("set_key", F.lit(turn * PIVOTS + j)).alias("h"), "set_key")) for j in range(half)]
    central = F.struct("score", hashed.alias("h"), "set_key")
    lowest += [F.min(F.when(F.pmod(hashed, F.lit(half)) == j, central)) for j in range(PIVOTS - half)]
    lowest = [c.alias(f"p{j}") for j, c in enumerate(lowest)]
    chosen = big.select("region", "salts", "score", "set_key").groupBy("region").agg(F.first("salts").alias("salts"), *lowest)
    keys = F.array_distinct(F.array_compact(F.array(*(F.col(f"p{j}.set_key") for j in range(PIVOTS)))))
    keys = materialize(chosen.select("region", "salts", F.posexplode(keys).alias("nth", "set_key")), f"{path}-keys")
    met = big.select("region", "set_key", "shingles").join(_small(keys), ["region", "set_key"])
    return materialize(met.select("region", "salts", "nth", "set_key", "shingles"), path)


def _overlaps(pivots: list[np.ndarray]):
    """A function that gives the overlaps of a set with all pivots."""
    known = np.unique(np.concatenate(pivots))
    holds = np.zeros((len(known) + 1, len(pivots)), np.uint8)
    for j, p in enumerate(pivots):
        holds[np.searchsorted(known, p), j] = 1

    def hits(shingles: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        return holds[at[known[at] == shingles]].sum(axis=0, dtype=np.int64)

    return hits


def _distances(big: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """region, set_key, distances, balls (bits), nearest (-1 outside all balls), linked (keys of pivots) of every set."""
    own = big.select(
        "region", F.pmod(F.xxhash64("set_key"), F.col("salts")).cast("int").alias("salt"), F.lit(PIVOTS).alias("nth"),
        "set_key", "shingles")
    sent = pivots.select(
        "region", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "nth", "set_key", "shingles")
    rows = own.union(sent).repartition("region", "salt").sortWithinPartitions("region", "salt", "nth")
    names = ["region", "set_key", "distances", "balls", "nearest", "linked"]
    radius = 1 - percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, sets, hits = None, [], [], None
        for batch in batches:
            out: list[list] = [[] for _ in names]
            region, salt, nth, key = (batch.column(k).to_pylist() for k in range(4))
            for i in range(batch.num_rows):
                if (region[i], salt[i]) != part:
                    part, keys, sets, hits = (region[i], salt[i]), [], [], None
                shingles = batch.column(4)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                if nth[i] < PIVOTS:
                    keys.append(key[i]), sets.append(shingles)
                    continue
                if hits is None:
                    hits, sizes = _overlaps(sets), np.array([len(s) for s in sets])
                met = hits(shingles)
                union = sizes + len(shingles) - met
                far = 1 - met / union
                inside = 100 * met >= percent * union
                nearest = int(np.where(inside, far, 2).argmin()) if inside.any() else -1
                far = np.where(inside, np.minimum(far, radius), far)
                linked = [keys[j] for j in np.flatnonzero(inside) if keys[j] != key[i]]
                row = (region[i], key[i], far, int((1 << np.flatnonzero(inside)).sum()), nearest, linked)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    schema = "region long, set_key binary, distances array<double>, balls int, nearest int, linked array<binary>"
    return rows.mapInArrow(run, schema)


def _components_of_balls(found: DataFrame) -> DataFrame:
    """region, ball (array: the component of every pivot's ball); balls are connected by sets that lie in several."""
    masks = found.where("balls > 0").groupBy("region").agg(F.collect_set("balls").alias("masks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for masks in batch.column(1).to_pylist():
                ball = list(range(PIVOTS))
                for m in masks:
                    inside = [j for j in range(PIVOTS) if m >> j & 1]
                    tops = {ball[j] for j in inside}
                    ball = [min(tops) if b in tops else b for b in ball]
                out.append(ball)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["region", "ball"])

    return masks.mapInArrow(run, "region long, ball array<int>")


def _round(big: DataFrame, turn: int, path: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Star edges (a, b), b < a, and what is left to compare: parent, region, both, side, score, set_key.

    ``both``: only pairs of different sides are to be compared.
    """
    radius = 1 - percent / 100
    pivots = _pivots(big, turn, f"{path}/pivots")
    found = materialize(_distances(big, pivots, percent), f"{path}/distances")
    edges = found.select("set_key", F.explode("linked").alias("other")).select(
        F.greatest("set_key", "other").alias("a"), F.least("set_key", "other").alias("b"))

    balls = materialize(_components_of_balls(found), f"{path}/balls")
    met = found.join(_small(balls), "region")  # every pivot lies in its own ball, so no region is lost
    mine = F.when(F.col("nearest") >= 0, F.try_element_at("ball", F.col("nearest") + 1)).otherwise(-1)
    met = met.withColumn("mine", mine)
    at = [F.try_element_at("distances", F.lit(j + 1)) for j in range(PIVOTS)]
    visits = [
        (d > radius) & (d <= 2 * radius + _SLACK) & (F.col("mine") != F.try_element_at("ball", F.lit(j + 1)))
        for j, d in enumerate(at)]
    nearest_visit = met.groupBy("region").agg(*(F.min(F.when(v, d)).alias(f"low{j}") for j, (v, d) in enumerate(zip(visits, at))))
    lows = materialize(nearest_visit.select("region", F.array(*(F.col(f"low{j}") for j in range(PIVOTS))).alias("lows")), f"{path}/lows")
    met = met.join(_small(lows), "region")

    def child(j):
        return F.xxhash64("region", F.lit(turn), j).alias("region")

    none = F.lit(0.0).alias("score")
    low = F.try_element_at("lows", F.col("nearest") + 1)
    own = F.try_element_at("distances", F.col("nearest") + 1)
    natives = met.where((F.col("nearest") >= 0) & (own >= low - radius - _SLACK)).select(
        F.col("region").alias("parent"), child(F.col("nearest")), F.lit(True).alias("both"), F.lit(0).alias("side"),
        none, "set_key")
    places = F.array_compact(F.array(*(F.when(v, F.lit(j)) for j, v in enumerate(visits))))
    visitors = met.select("region", "set_key", F.explode(places).alias("j")).select(
        F.col("region").alias("parent"), child(F.col("j")), F.lit(True).alias("both"), F.lit(1).alias("side"),
        none, "set_key")
    total = F.aggregate("distances", F.lit(0.0), lambda x, d: x + d)
    rest = met.where("nearest < 0").select(
        F.col("region").alias("parent"), child(F.lit(-1)), F.lit(False).alias("both"), F.lit(0).alias("side"),
        total.alias("score"), "set_key")
    return edges, natives.union(visitors).union(rest)


def _units(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Units of rows (region, both, side, set_key, shingles): pairs of blocks as ``plan`` (region, blocks0, blocks1) says."""
    met = rows.join(_small(plan), "region")
    own = F.when(F.col("side") == 0, F.col("blocks0")).otherwise(F.col("blocks1"))
    against = F.when(~F.col("both") | (F.col("side") == 1), F.col("blocks0")).otherwise(F.col("blocks1"))
    met = met.withColumn("own", F.pmod(F.xxhash64("set_key"), own).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), against - 1)))
    swap = F.when(F.col("both"), F.col("side") == 1).otherwise(F.col("own") > F.col("other"))
    low, high = F.when(swap, F.col("other")).otherwise(F.col("own")), F.when(swap, F.col("own")).otherwise(F.col("other"))
    return met.select(
        "region", low.alias("low"), high.alias("high"), (F.col("both") | (low != high)).alias("both"),
        swap.cast("int").alias("side"), "set_key", "shingles")


def whole_regions(sets: DataFrame) -> DataFrame:
    """Units of regions that fit one task."""
    one = F.lit(0)
    return sets.select(
        "region", one.alias("low"), one.alias("high"), F.lit(False).alias("both"), one.alias("side"), "set_key", "shingles")


def regions_to_compare(sets: DataFrame, path: str, percent: int) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Star edges (a, b) and units (``UNIT_COLUMNS``) for ``sets`` (region, n_sets, n_all, set_key, shingles).

    ``n_sets`` and ``n_all`` are the sets of a region and their shingles. Every pair that may link and is not connected by star
    edges meets in a unit. The counts say how many rows went into rounds and into units of more than one pair of blocks.
    """
    salts = blocks_of(F.col("n_sets"), F.col("n_all")).alias("salts")
    all_big = materialize(
        sets.select("region", "n_sets", salts, F.lit(0.0).alias("score"), "set_key", "shingles"), f"{path}/large")
    sizes = materialize(all_big.groupBy("region").agg(F.first("n_sets").alias("n")), f"{path}/sizes-0")
    counts = {"rounds": 0, "in rounds": 0, "in block pairs": 0}
    units = [whole_regions(all_big.limit(0))]
    if sizes.isEmpty():
        return sets.sparkSession.createDataFrame([], "a binary, b binary"), units[0], counts

    big, edges, turn = all_big, [], 0
    while True:
        counts["rounds"] += 1
        counts["in rounds"] += sizes.agg(F.sum("n")).first()[0]
        stars, left = _round(big, turn, f"{path}/round-{turn}", percent)
        edges.append(stars)
        left = materialize(left.distinct(), f"{path}/left-{turn}")
        # The sets of what is left are fetched once more; nothing else is.
        hashed = F.xxhash64("set_key").alias("hash")
        some = maybe_in(all_big.select("set_key", "shingles", hashed), "hash", bit_table(left.select(hashed), "hash"))
        held = materialize(left.join(some.drop("hash"), "set_key"), f"{path}/held-{turn}")
        size = F.size("shingles")
        shape = held.groupBy("parent", "region", "both").agg(
            F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"),
            F.sum(F.when(F.col("side") == 0, size).otherwise(0)).alias("all0"),
            F.sum(F.when(F.col("side") == 1, size).otherwise(0)).alias("all1"))
        shape = shape.join(_small(sizes.select(F.col("region").alias("parent"), F.col("n").alias("whole"))), "parent")
        plan = shape.where("NOT both OR (n0 > 0 AND n1 > 0)").select(
            "region", "both", "n0", "n1", "all0", "whole", blocks_of(F.col("n0"), F.col("all0")).alias("blocks0"),
            blocks_of(F.col("n1"), F.col("all1")).alias("blocks1"))
        plan = materialize(plan, f"{path}/plan-{turn}")
        again = ~F.col("both") & (F.col("blocks0") > 1)
        if turn:  # the first pivots are all by chance
            again = again & (F.col("n0") <= F.col("whole") * SHRINK)
        units.append(_units(held.drop("parent", "score"), plan.where(~again).select("region", "blocks0", "blocks1")))
        pairs = F.when(F.col("both"), (F.col("blocks0") > 1) & (F.col("blocks1") > 1)).otherwise(F.col("blocks0") > 1)
        counts["in block pairs"] += plan.where(~again & pairs).agg(F.sum(F.col("n0") + F.col("n1"))).first()[0] or 0
        turn += 1
        next_sizes = plan.where(again).select("region", F.col("n0").alias("n"), F.col("blocks0").alias("salts"))
        sizes = materialize(next_sizes, f"{path}/sizes-{turn}")
        if sizes.isEmpty():
            break
        big = held.join(_small(sizes.select("region", "salts")), "region").select("region", "salts", "score", "set_key", "shingles")
    return reduce(DataFrame.union, edges), reduce(DataFrame.union, units), counts
