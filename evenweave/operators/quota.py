"""Exact quotas and global ranks without moving the rows.

Sort keys are md5 digests, so their leading hex digits cut any table into evenly filled buckets. A
histogram over the buckets (combined map-side, at most 16**digits rows) tells where every rank lies:

* a global rank is the bucket's offset plus the rank inside the bucket;
* an exact quota needs no rank at all, only the key of the first row of each value. Those few keys sit
  in at most one bucket each, so only these buckets are sorted, and the assignment itself is a
  comparison against a handful of keys - a map-only pass over the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenweave.functions.columns import let
from evenweave.functions.draws import draw_key
from evenweave.spec import Quota


def _bucket(key: Column, digits: int) -> Column:
    return F.substring(key, 1, digits)


def hash_rank(
    df: DataFrame, id_col: str, name: str, seed: int = 42, out: str = "rank", digits: int = 4
) -> DataFrame:
    """0-based rank of every row in md5 order, as ``row_number`` over the whole table would give."""
    keyed = df.withColumn("_key", draw_key(seed, name, F.col(id_col))).withColumn(
        "_bucket", _bucket(F.col("_key"), digits)
    )
    histogram = (
        df.select(_bucket(draw_key(seed, name, F.col(id_col)), digits).alias("_bucket"))
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # One small sort: the histogram has at most 16**digits rows whatever the table holds.
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = histogram.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_bucket").orderBy("_key", id_col)
    return (
        keyed.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_key", "_offset")
    )


def bucket_digits(rows: int, rows_per_bucket: int = 4096, at_most: int = 5) -> int:
    """Hex digits that cut ``rows`` into buckets of about the wanted size; bounds the histogram too."""
    digits = 1
    while digits < at_most and rows > rows_per_bucket * 16**digits:
        digits += 1
    return digits


def quota_cuts(
    df: DataFrame, id_col: str, quotas: dict[str, Quota], seed: int = 42, digits: int | None = None
) -> DataFrame:
    """First key of every quota value: rows ``(column, cuts)`` with cuts an ordered array of keys.

    A value that starts at rank 0 needs no cut; a value that starts behind the last row gets none.
    """
    spark = df.sparkSession
    if digits is None:
        digits = bucket_digits(max(sum(n for _, n in quota) for quota in quotas.values()))
    starts = []
    for column, quota in quotas.items():
        low = 0
        for position, (_, count) in enumerate(quota):
            if low:
                starts.append((column, position, low))
            low += count
    starts_df = spark.createDataFrame(starts, "column string, position int, low long")

    keyed = df.select(
        F.col(id_col).alias("id"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), draw_key(seed, c, F.col(id_col)).alias("key"))
                    for c in quotas
                ]
            )
        ).alias("k"),
    ).select("k.column", _bucket(F.col("k.key"), digits).alias("bucket"), "k.key", "id")

    histogram = keyed.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("column").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = histogram.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = (
        offsets.join(F.broadcast(starts_df), "column")
        .where((F.col("low") >= F.col("offset")) & (F.col("low") < F.col("offset") + F.col("n")))
        .select("column", "bucket", "position", (F.col("low") - F.col("offset") + 1).alias("nth"))
    )
    # At most one bucket per quota value reaches this sort; the broadcast has as many rows as quotas.
    inside = W.partitionBy("column", "bucket").orderBy("key", "id")
    hit_buckets = wanted.select("column", "bucket").distinct()
    ranked = keyed.join(F.broadcast(hit_buckets), ["column", "bucket"], "left_semi").withColumn(
        "nth", F.row_number().over(inside).cast("long")
    )
    cuts = ranked.join(F.broadcast(wanted), ["column", "bucket", "nth"])
    return cuts.groupBy("column").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", "key", "id"))),
            lambda c: F.struct(c["key"].alias("key"), c["id"].alias("id")),
        ).alias("cuts")
    )


def assign_quotas(
    df: DataFrame, id_col: str, quotas: dict[str, Quota], seed: int = 42, digits: int | None = None
) -> DataFrame:
    """K5-K8: give every column exactly the listed value counts, in hash-random order.

    ``id_col`` must be unique. The counts of each quota must add up to the number of rows, or the query fails.
    """
    cut_map = (
        quota_cuts(df, id_col, quotas, seed, digits)
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "cuts"))).alias("m"))
        .scalar()
    )
    # A count over no columns: a scan of the table's metadata where the source has it.
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    wrong = reduce(lambda a, b: a | b, [rows != sum(n for _, n in quota) for quota in quotas.values()], F.lit(False))
    message = F.concat(F.lit("quota counts do not add up to the number of rows: "), rows.cast("string"))
    out = df.withColumn("_cuts", F.when(wrong, F.raise_error(message)).otherwise(cut_map))
    for column, quota in quotas.items():
        me = F.struct(draw_key(seed, column, F.col(id_col)).alias("key"), F.col(id_col).alias("id"))
        cuts = F.try_element_at(F.col("_cuts"), F.lit(column))
        passed = F.coalesce(let(me, lambda m: F.size(F.filter(cuts, lambda c: c <= m))), F.lit(0))
        values = F.array(*[F.lit(v) for v, _ in quota])
        # Leading values with a zero count have no cut of their own; start behind them.
        first = next((i for i, (_, n) in enumerate(quota) if n), 0)
        out = out.withColumn(column, F.element_at(values, F.greatest(passed, F.lit(0)) + 1 + first))
    return out.drop("_cuts")


QUOTA_BLOCK = 1024  # ranks that meet the values of their stretch in one join key


def quota_ranges(quota: DataFrame, position: str, count: str, block: int = 4096) -> DataFrame:
    """``quota`` with ``low`` and ``high``: the ranks of each value, in the order of its dense 0-based ``position``.

    Sums in two levels, within blocks of positions and over the blocks, so any number of values is no single task.
    """
    part = F.call_function("div", F.col(position).cast("long"), F.lit(block).cast("long"))
    named = quota.withColumn("_part", part)
    totals = named.groupBy("_part").agg(F.sum(count).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row for 4,096 values
    totals = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("_part").orderBy(position).rowsBetween(W.unboundedPreceding, 0)
    ranged = named.join(totals, "_part").withColumn("high", F.col("_base") + F.sum(count).over(inside))
    return ranged.withColumn("low", F.col("high") - F.col(count)).drop("_part", "_base")


def assign_quota_table(
    df: DataFrame, id_col: str, quota: DataFrame, out: str, seed: int = 42, digits: int | None = None
) -> DataFrame:
    """K5-K8 for any number of values: ``quota`` has ``position`` (dense, from 0), ``value`` and ``count``.

    Same assignment as ``assign_quotas``. Rows get their global rank in hash order; a value's ranks fall into blocks of
    ``QUOTA_BLOCK``, and rows meet in their block the values that reach into it: an equality join on evenly filled keys,
    in which no table is broadcast. The counts must add up to the number of rows, or the query fails.
    """
    spread = quota_ranges(quota.select("position", "value", F.col("count").cast("long").alias("count")), "position", "count")
    spread = spread.where("count > 0").withColumn(
        "_block", F.explode(F.expr(f"sequence(low div {QUOTA_BLOCK}, (high - 1) div {QUOTA_BLOCK})")))
    spread = spread.select("_block", F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("value").alias("_value"))
    if digits is None:
        digits = bucket_digits(df.count())
    ranked = hash_rank(df, id_col, out, seed, "_rank", digits).withColumn("_block", F.expr(f"_rank div {QUOTA_BLOCK}"))
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    wanted = quota.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).scalar()
    message = F.concat(F.lit("quota counts do not add up to the number of rows: "), rows.cast("string"))
    met = ranked.join(spread, "_block", "left").where("_low IS NULL OR _rank >= _low AND _rank < _high")
    value = F.when(rows != wanted, F.raise_error(message)).otherwise(F.col("_value"))
    return met.select(*df.columns, value.alias(out))


def allocate(df: DataFrame, total: Column | str, values: list[str]) -> DataFrame:
    """K8 on a table of totals: rows ``(..., value, quota)`` by the remainder rule."""
    n = F.col(total) if isinstance(total, str) else total
    k = len(values)
    cells = F.array(*[F.struct(F.lit(v).alias("value"), F.lit(i).alias("rank")) for i, v in enumerate(values)])
    quota = F.call_function("div", n, F.lit(k)) + (F.col("_q.rank") < F.pmod(n, F.lit(k))).cast("long")
    return df.withColumn("_q", F.explode(cells)).select(
        *df.columns, F.col("_q.value").alias("value"), quota.cast("long").alias("quota")
    )


def expected_from_template(
    template: DataFrame, columns: list[str], weight: str, cycles: int = 1
) -> DataFrame:
    """K16 for specs kept in a table: ``(column, value, expected)``, all columns in one pass."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    long = template.select(F.explode(cells).alias("c"), F.col(weight).cast("long").alias("w"))
    return long.groupBy("c.column", "c.value").agg((F.sum("w") * cycles).alias("expected"))


def hierarchy_problems(df: DataFrame, group: str, item: str) -> DataFrame:
    """K17 for hierarchies kept in a table: groups with another number of items than the first group."""
    # distinct first: an item listed many times collapses map-side.
    sizes = df.select(group, item).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.agg(F.min_by("n", group).alias("n")).scalar()
    bad = sizes.where(F.col("n") != first)
    return bad.select(
        F.lit("equal_items_per_group").alias("rule"),
        F.concat(F.col(group).cast("string"), F.lit(": "), F.col("n").cast("string")).alias("detail"),
    )
