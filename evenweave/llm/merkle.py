"""Merkle manifest of a data set: a tree per source, a tree over the sources, and a proof for every row.

Leaves are the digests of whole rows, by source in the order of their ids. Levels are built by self-joins: every node
knows the indices of the other nodes of its run (``index XOR 1`` for runs of two, shifts of its slot for longer ones)
and is joined with them by equality; the row of slot zero then holds the whole run and emits the parent. The siblings a
node was joined with are its step of a proof, so proofs come from joining parents back, top down.

Every level is one set of rows with unique keys (source, index): no key is hot, however large a source is. The place of
a leaf in its source comes from a range partitioning and the first place of each source in each partition; no window
runs over a source. Levels are written, so a lost executor repeats one level at most.

Nulls in any column are part of the digest. A null source is a source, and comes first; a null id comes before all
others and is never tampered with. Rows that repeat an id follow each other by digest. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenweave.session import materialize, new_run_dir

ARITY = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_ROWS = 100_000
_PLACE = 33  # monotonically_increasing_id holds the partition above these bits


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 over the values: ``-`` for null, else byte count, colon, value."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text)), 256)


def _hashed(parts: list[Column]) -> Column:
    """Digest of digests, joined as hexadecimal text; they travel as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*(_hex(p) for p in parts)), 256))


def _hex(digest: Column) -> Column:
    return F.coalesce(F.lower(F.hex(digest)), F.lit(""))


def placed(rows: DataFrame, group: list[str], order: list[str], path: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0, by ``order`` inside its group) and ``n`` (rows of the group)."""
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    spread = materialize(spread.withColumn("place", F.monotonically_increasing_id()), path)
    # Where a group starts in a partition, and how many of its rows lie in partitions before: one row for both.
    part = F.shiftright("place", _PLACE).alias("part")
    runs = spread.groupBy(*group, part).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *(F.col(c).alias(f"_{c}") for c in group), F.col("part").alias("_part"),
        (F.col("first") - F.coalesce(F.sum("rows").over(earlier), F.lit(0))).alias("origin"),
        F.sum("rows").over(whole).alias("n"))
    starts = materialize(starts, f"{path}-starts")
    if starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group] + [F.shiftright("place", _PLACE) == F.col("_part")]
    return spread.join(starts, same).withColumn("idx", F.col("place") - F.col("origin")).drop(
        "place", "origin", "_part", *(f"_{c}" for c in group))


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes of one level (tree, idx, n, digest) with the digests before and after them in their run, and a parent's."""
    slot = F.col("idx") % arity
    met = nodes
    for shift in range(1, arity):
        there = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        others = nodes.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("digest").alias(f"s{shift}"))
        met = met.withColumn("there", there).join(others, (F.col("tree") == F.col("t")) & (F.col("there") == F.col("i")), "left")
        met = met.drop("t", "i", "there")
    # The sibling at slot k lies (k - slot) modulo the arity behind.
    def side(slots) -> Column:
        text = F.lit("")
        for mine in range(arity):
            found = [F.col(f"s{(k - mine) % arity}") for k in slots(mine)]
            text = F.when(slot == mine, F.concat(*(_hex(f) for f in found)) if found else F.lit("")).otherwise(text)
        return F.unhex(text)

    return met.select(
        "tree", "idx", "n", "digest", side(lambda mine: range(mine)).alias("left"),
        side(lambda mine: range(mine + 1, arity)).alias("right"),
        F.when(slot == 0, _hashed([F.col("digest"), *(F.col(f"s{k}") for k in range(1, arity))])).alias("parent"),
    )


def build(leaves: DataFrame, path: str, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """Levels (tree, idx, n, digest, left, right, parent) of the trees over ``leaves`` (tree, idx, n, digest), and tops.

    A level holds the trees that have more than one node there; ``tops`` is one row per tree: tree, digest.
    """
    nodes = leaves.select("tree", "idx", "n", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], nodes.where("n = 1").select("tree", "digest")
    while most > 1:
        level = materialize(_with_siblings(nodes.where("n > 1"), arity), f"{path}/level-{len(levels)}")
        levels.append(level)
        nodes = level.where(F.col("idx") % arity == 0).select(
            "tree", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
            F.col("parent").alias("digest"))
        tops = tops.union(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // arity)
    return levels, tops


def proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """tree, idx, subroot, path of the leaves: what ``tops`` (tree, subroot, path) holds is handed down level by level.

    A path is an array of (left, right), the digests on both sides joined, from the leaf to the root. Every level puts
    its own siblings before the path of the parent.
    """
    def below(rows: DataFrame, above: DataFrame) -> DataFrame:
        above = above.select(F.col("tree").alias("t"), F.col("idx").alias("i"), "subroot", F.col("path").alias("above"))
        met = rows.join(above, (F.col("tree") == F.col("t")) & (F.floor(F.col("idx") / arity) == F.col("i")))
        return met.select("tree", "idx", "subroot", F.concat(F.array(F.struct("left", "right")), "above").alias("path"))

    tops = tops.select("tree", F.lit(0).cast("long").alias("idx"), "subroot", "path")
    known = None
    for level in reversed(levels):
        last = below(level.where(F.col("n") <= arity), tops)  # trees whose parent is their top
        known = last if known is None else last.union(below(level.where(F.col("n") > arity), known))
    alone = leaves.where("n = 1").select("tree").join(tops, "tree").select("tree", "idx", "subroot", "path")
    return alone if known is None else known.union(alone)


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "source",
             arity: int = ARITY, tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path (proof), tampered_leaf.

    ``tampered`` names columns that are read otherwise for the second leaf, as they would be in a copy to verify.
    """
    run = new_run_dir(docs.sparkSession)
    changed = tampered or {}
    leaves = docs.select(
        F.col(id_col).alias("doc_id"), F.col(group_col).alias("source"),
        F.unhex(row_digest([F.col(c) for c in columns])).alias("digest"),
        F.unhex(row_digest([changed.get(c, F.col(c)) for c in columns])).alias("second"),
    )
    leaves = placed(materialize(leaves, f"{run}/digests"), ["source"], ["doc_id", "digest"], f"{run}/sorted")
    names = leaves.where("idx = 0").select("source")
    names = materialize(placed(names, [], ["source"], f"{run}/names"), f"{run}/sources").select(
        F.col("source").alias("name"), F.col("idx").alias("tree"), F.col("n").alias("trees"))
    if names.count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    leaves = leaves.join(names, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "tree", "idx", "n", "trees", "digest", "second")
    leaves = materialize(leaves, f"{run}/leaves")

    levels, subroots = build(leaves, f"{run}/trees", arity)
    subroots = materialize(subroots, f"{run}/subroots")
    above = subroots.join(leaves.where("idx = 0").select("tree", "trees"), "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("n"), "digest")
    above = materialize(above, f"{run}/above")
    upper, roots = build(above, f"{run}/upper", arity)
    top = roots.first()
    root = F.lit(bytes(top["digest"]) if top else None).cast("binary")
    nothing = F.expr("cast(array() as array<struct<left: binary, right: binary>>)")
    ways = proofs(above, upper, roots.select("tree", F.col("digest").alias("subroot"), nothing.alias("path")), arity)
    ways = ways.select(F.col("idx").alias("tree"), "path").join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    paths = proofs(leaves, levels, materialize(ways, f"{run}/ways"), arity)
    return leaves.join(paths, ["tree", "idx"]).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
        F.col("second").alias("tampered_leaf"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, step: _hashed([step["left"], node, step["right"]]))


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings, from the leaf to the root, left to right."""
    return F.sha2(F.aggregate(path, F.lit(""), lambda s, step: F.concat(s, _hex(step["left"]), _hex(step["right"]))), 256)


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, and the verdict on a copy in which texts of even id checksum lost their line breaks."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(docs, tampered={"text": text})
    result = found.withColumn("folded", folded(F.col("tampered_leaf"), F.col("path")))
    return result.select(
        "doc_id", *(F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")),
        proof_digest(F.col("path")).alias("proof_sha256"), F.lower(F.hex("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
