"""Balanced grids: every row's cell is arithmetic on its row id, so the grid needs no joins or shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.functions.draws import conditional_choice, uniform_choice
from evenweave.operators.quota import assign_quotas
from evenweave.spec import BalanceSpec


# A row emits at most this many copies at a time.
COPIES_PER_STEP = 10_000


def _number_copies(df: DataFrame, copies: Column, out: str, step: int = COPIES_PER_STEP) -> DataFrame:
    """Repeat every row ``copies`` times, numbered from 0 in ``out``.

    A row becomes one row per ``step`` copies, these are dealt out by the row and the step, and only then
    exploded: neither one task nor one array ever holds all copies of a heavy row, and many heavy rows
    do not meet. The number of partitions is given, because rows that are about to grow look small.
    """
    n = copies.cast("long")
    steps = F.sequence(F.lit(0).cast("long"), F.call_function("div", n - 1, F.lit(step).cast("long")))
    stepped = df.where(n > 0).withColumn("_n", n).withColumn("_step", F.explode(steps))
    hashable = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stepped.repartition(parts, *[F.col(f"`{c}`") for c in hashable], "_step")
    first = F.col("_step") * step
    return dealt.withColumn(
        out, F.explode(F.sequence(first, F.least(first + step, F.col("_n")) - 1))
    ).drop("_n", "_step")


def expand_by_weight(
    df: DataFrame, weight: Column | str, copy_col: str | None = None, step: int = COPIES_PER_STEP
) -> DataFrame:
    """K1: repeat every row ``weight`` times; weight 0 drops it. ``copy_col`` numbers the copies."""
    w = F.col(weight) if isinstance(weight, str) else weight
    out = _number_copies(df, w, copy_col or "_copy", step)
    return out if copy_col else out.drop("_copy")


def list_rank(c: Column | str, order: list[str], unknown: int = 99) -> Column:
    """K2: 0-based position of a value in a custom order; values not listed rank as ``unknown``."""
    column = F.col(c) if isinstance(c, str) else c
    position = F.array_position(F.array(*[F.lit(v) for v in order]), column)
    return F.when(position > 0, position.cast("int") - 1).otherwise(F.lit(unknown))


def sort_by_lists(df: DataFrame, orders: dict[str, list[str]]) -> DataFrame:
    """K2: order a table by custom value orders, one column after the other."""
    return df.orderBy(*[list_rank(c, order) for c, order in orders.items()])


def int_div(a: Column, b: int) -> Column:
    """Integer division that stays exact for large row ids."""
    return F.call_function("div", a.cast("long"), F.lit(b).cast("long"))


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def grid_columns(spec: BalanceSpec, row_id: Column, cycles: int | None = None) -> dict[str, Column]:
    """K3: group, item, label, tone and cycle of a row, decoded from its row id.

    Order is group, item, template row, cycle. ``cycles`` replaces the spec's number of cycles.
    """
    cycles = spec.cycles if cycles is None else cycles
    flat = [(g, i) for g, items in spec.hierarchy.items() for i in items]
    template = [(lab, ton) for lab, ton, w in spec.sorted_template() for _ in range(w)]

    block = len(template) * cycles
    item_index = F.pmod(int_div(row_id, block), F.lit(len(flat)))
    cell_index = int_div(F.pmod(row_id, F.lit(block)), cycles)
    return {
        spec.group_col: _pick([g for g, _ in flat], item_index),
        spec.item_col: _pick([i for _, i in flat], item_index),
        spec.label_col: _pick([e for e, _ in template], cell_index),
        spec.tone_col: _pick([s for _, s in template], cell_index),
        "cycle": F.pmod(row_id, F.lit(cycles)).cast("int"),
    }


def grid(spark: SparkSession, spec: BalanceSpec) -> DataFrame:
    """K3 + K4: the whole grid with a dense ``row_id``, produced in parallel from a range."""
    rows = spark.range(spec.total_rows).withColumnRenamed("id", "row_id")
    cells = grid_columns(spec, F.col("row_id"))
    return rows.select("row_id", *[c.alias(n) for n, c in cells.items()])


def expand_hierarchy(
    df: DataFrame, item_index: Column | str, spec: BalanceSpec, cycles: int | None = None
) -> DataFrame:
    """K3 for hierarchies kept in a table: each item row becomes its template rows times the cycles.

    ``item_index`` is the dense 0-based rank of the item; ``row_id`` follows from it by arithmetic (K4).
    """
    cycles = spec.cycles if cycles is None else cycles
    index = F.col(item_index) if isinstance(item_index, str) else item_index
    template = [(lab, ton) for lab, ton, w in spec.sorted_template() for _ in range(w)]
    block = len(template) * cycles
    out = _number_copies(df, F.lit(block), "_place")
    cell = int_div(F.col("_place"), cycles)
    return (
        out.withColumn("row_id", index.cast("long") * block + F.col("_place"))
        .withColumn(spec.label_col, _pick([e for e, _ in template], cell))
        .withColumn(spec.tone_col, _pick([s for _, s in template], cell))
        .withColumn("cycle", F.pmod(F.col("_place"), F.lit(cycles)).cast("int"))
        .drop("_place")
    )


def id_string(row_id: Column, pattern: str) -> Column:
    """K4: 1-based id text such as ``sample_0001.jpg``."""
    return F.format_string(pattern, row_id + 1)


def lookup(c: Column | str, mapping: dict[str, str | int]) -> Column:
    """Value of a small fixed dictionary, null for unknown or null keys."""
    column = F.col(c) if isinstance(c, str) else c
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.when(column.isNotNull(), F.try_element_at(F.create_map(*pairs), column))


def encode(df: DataFrame, codes: dict[str, dict[str, int]], suffix: str = "_num") -> DataFrame:
    """Add ``<column>_num`` for every coded column; unknown values become null."""
    return df.withColumns({f"{c}{suffix}": lookup(c, m) for c, m in codes.items()})


def add_draws(df: DataFrame, spec: BalanceSpec, seed: int = 42) -> DataFrame:
    """Conditional draws, uniform draws and blank columns of the spec."""
    rid = F.col("row_id")
    new = {
        c: conditional_choice(seed, c, rid, F.col(spec.tone_col), cases, rest)
        for c, (cases, rest) in spec.tone_draws.items()
    }
    new |= {c: uniform_choice(seed, c, rid, options) for c, options in spec.uniform_draws.items()}
    new |= {c: F.lit("") for c in spec.blank_columns}
    return df.withColumns(new) if new else df


def in_order(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Fixed column order; everything not listed (or kept) is dropped."""
    kept = [c for c in keep if c in df.columns and c not in columns]
    return df.select(*kept, *columns)


def complete_grid(df: DataFrame, spec: BalanceSpec, seed: int = 42, quotas: dict | None = None) -> DataFrame:
    """K4, K5-K14 on a table that already has ``row_id`` and the grid columns."""
    out = assign_quotas(df, "row_id", spec.quotas() if quotas is None else quotas, seed)
    out = out.withColumn(spec.id_column, id_string(F.col("row_id"), spec.id_pattern))
    out = out.withColumn(spec.implied_col, lookup(spec.tone_col, spec.implied))
    out = encode(add_draws(out, spec, seed), spec.codes)
    return in_order(out, spec.column_order) if spec.column_order else out


def build_skeleton(spark: SparkSession, spec: BalanceSpec, seed: int = 42) -> DataFrame:
    """The complete balanced table as one lazy plan."""
    return complete_grid(grid(spark, spec), spec, seed)
