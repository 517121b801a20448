"""Batches, gaps, and the assignment of generated items to the rows that wait for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenweave.functions.columns import let
from evenweave.functions.text import clean_text, digest, is_filled, strip
from evenweave.operators.bits import bit_table, maybe_in
from evenweave.spec import TaskSpec


def add_batches(df: DataFrame, row_id: str = "row_id", batch_rows: int = 30) -> DataFrame:
    """``batch_id`` and ``pos`` from a dense row id."""
    rid = F.col(row_id).cast("long")
    return df.withColumns(
        {
            "batch_id": F.call_function("div", rid, F.lit(batch_rows).cast("long")),
            "pos": F.pmod(rid, F.lit(batch_rows)).cast("int"),
        }
    )


def ensure_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add absent columns as blank text."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit("") for c in absent}) if absent else df


def fill_counts(df: DataFrame, column: str, min_length: int) -> list[Column]:
    """The aggregates ``total`` and ``filled``; an absent column counts as not filled."""
    filled = F.count_if(is_filled(column, min_length)) if column in df.columns else F.lit(0).cast("long")
    return [F.count(F.lit(1)).alias("total"), filled.alias("filled")]


def fill_status(df: DataFrame, column: str, min_length: int) -> DataFrame:
    """One row ``(filled, total, complete)``; an absent column counts as not filled."""
    out = df.agg(*fill_counts(df, column, min_length))
    complete = (F.col("filled") == F.col("total")) & F.lit(column in df.columns)
    return out.select("filled", "total", complete.alias("complete"))


def unfinished_batches(df: DataFrame, column: str, min_length: int) -> DataFrame:
    """E5: ids of batches with at least one unfilled row (``df`` has ``batch_id``)."""
    done = F.bool_and(is_filled(column, min_length)).alias("done")
    return df.groupBy("batch_id").agg(done).where(~F.col("done")).select("batch_id")


def find_gaps(df: DataFrame, column: str, min_length: int) -> DataFrame:
    """Unfilled rows, numbered from 0 within their batch in row order as ``gap``.

    A batch holds a fixed small number of rows, so the window sorts only that many at a time.
    """
    number = F.row_number().over(W.partitionBy("batch_id").orderBy("pos")) - 1
    return df.where(~is_filled(column, min_length)).withColumn("gap", number)


def micro_batches(gaps: DataFrame, micro_rows: int = 5) -> DataFrame:
    """Chunk number of a gap."""
    return gaps.withColumn("chunk", F.call_function("div", F.col("gap"), F.lit(micro_rows)).cast("int"))


def number_lines(lines: Column) -> Column:
    """Array of row lines as one block ``1. ...\\n2. ...``."""
    return F.array_join(
        F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n"
    )


def batch_prompts(df: DataFrame, task: TaskSpec, group: list[str], order: str) -> DataFrame:
    """One prompt per group of rows. Groups are batches or chunks, hence small."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), task.line().alias("line"))))
    out = df.groupBy(*group).agg(rows.alias("_rows"))
    lines = F.transform("_rows", lambda r: r["line"])
    prompt = task.batch_prompt(F.size("_rows").cast("string"), number_lines(lines))
    return out.select(*group, F.size("_rows").alias("n"), prompt.alias("prompt"))


def single_prompts(df: DataFrame, task: TaskSpec, variations: int = 6) -> DataFrame:
    """Every row with one prompt per variation."""
    prompts = F.array(
        *[
            F.struct(F.lit(v).alias("variation"), task.single_prompt(v).alias("prompt"))
            for v in range(variations)
        ]
    )
    return df.withColumn("_p", F.explode(prompts)).select(
        *df.columns, F.col("_p.variation").alias("variation"), F.col("_p.prompt").alias("prompt")
    )


def messages(system: Column, prompt: Column) -> Column:
    """Message list; the system message is left out when blank."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    both = F.array(message("system", system), message("user", prompt))
    return F.filter(both, lambda m: (m["role"] == "user") | (F.length(m["content"]) > 0))


def joined_input(system: Column, prompt: Column) -> Column:
    """System text and prompt as one string, separated by a blank line."""
    return F.concat_ws("\n\n", F.when(F.length(system) > 0, system), prompt)


def item_values(items: Column, columns: list[str]) -> Column:
    """Per item a struct of cleaned output values; absent or null values are blank."""
    def values(item: Column) -> Column:
        return F.struct(
            *[clean_text(F.coalesce(F.try_element_at(item, F.lit(c)), F.lit(""))).alias(c) for c in columns]
        )

    return F.transform(items, values)


def item_ids(items: Column) -> Column:
    """The integer each item gives as its ``id``; null if it gives none."""
    return F.transform(items, lambda item: strip(F.try_element_at(item, F.lit("id"))).try_cast("int"))


def pick_items(
    filled: Column, primaries: Column, min_length: int, deduplicate: bool = False, ids: Column | None = None
) -> Column:
    """Index of the item each row takes, -1 for none; by position, or by ``ids`` if they are given.

    ``filled`` has one flag per row, ``primaries`` one cleaned primary value per item. Row by row: filled
    rows take nothing; otherwise the item at the same position if it is long enough (even if an earlier
    row took it already); otherwise the first long enough item no row has taken. With ``deduplicate``, a
    value already taken by an earlier row is not taken again. A fold over at most one batch of rows.

    By id, prompts number their rows from 1 and items name them. First every unfilled row takes the first long
    enough item of its number. Then the rows left take, in order, the first long enough items that no row has taken:
    items without a number, of a number no row has, of a filled row, or of a number that another item had before.
    """
    if ids is not None:
        three = F.struct(filled.alias("filled"), primaries.alias("primaries"), ids.alias("ids"))
        return let(three, lambda b: _fold_ids(b["filled"], b["primaries"], b["ids"], min_length, deduplicate))
    both = F.struct(filled.alias("filled"), primaries.alias("primaries"))
    return let(both, lambda b: _fold_picks(b["filled"], b["primaries"], min_length, deduplicate))


def _fold_picks(filled: Column, primaries: Column, min_length: int, deduplicate: bool) -> Column:
    no_ints = F.array().cast("array<int>")
    indexes = F.when(F.size(primaries) > 0, F.sequence(F.lit(0), F.size(primaries) - 1)).otherwise(no_ints)
    start = F.struct(
        F.filter(indexes, lambda j: F.length(primaries[j]) >= min_length).alias("valid"),
        no_ints.alias("used"),
        no_ints.alias("picks"),
        F.array().cast("array<string>").alias("taken"),
    )

    def step(s: Column, i: Column) -> Column:
        free = F.array_except(s["valid"], s["used"])
        direct = F.array_contains(s["valid"], i)
        if deduplicate:
            free = F.filter(free, lambda j: ~F.array_contains(s["taken"], primaries[j]))
            direct = F.when(direct, ~F.array_contains(s["taken"], primaries[i])).otherwise(F.lit(False))
        pick = (
            F.when(filled[i], F.lit(-1))
            .when(direct, i)
            .otherwise(F.coalesce(F.try_element_at(free, F.lit(1)), F.lit(-1)))
        )
        return let(pick, lambda p: _take(s, p, primaries, deduplicate))

    folded = F.aggregate(F.sequence(F.lit(0), F.size(filled) - 1), start, step, lambda s: s["picks"])
    return F.when(F.size(filled) > 0, folded).otherwise(no_ints)


def _fold_ids(filled: Column, primaries: Column, ids: Column, min_length: int, deduplicate: bool) -> Column:
    no_ints = F.array().cast("array<int>")
    indexes = F.when(F.size(primaries) > 0, F.sequence(F.lit(0), F.size(primaries) - 1)).otherwise(no_ints)
    rows = F.sequence(F.lit(0), F.size(filled) - 1)
    start = F.struct(
        F.filter(indexes, lambda j: F.length(primaries[j]) >= min_length).alias("valid"), no_ints.alias("used"),
        no_ints.alias("picks"), F.array().cast("array<string>").alias("taken"))

    def first(s: Column, found: Column) -> Column:
        if deduplicate:
            found = F.filter(found, lambda j: ~F.array_contains(s["taken"], primaries[j]))
        return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(-1))

    def by_id(s: Column, i: Column) -> Column:
        mine = F.filter(s["valid"], lambda j: F.coalesce(ids[j] == i + 1, F.lit(False)))
        pick = F.when(filled[i], F.lit(-1)).otherwise(first(s, mine))
        return let(pick, lambda p: _take(s, p, primaries, deduplicate))

    def rest(named: Column) -> Column:
        begin = F.struct(
            F.array_except(named["valid"], named["used"]).alias("valid"), no_ints.alias("used"), no_ints.alias("picks"),
            named["taken"].alias("taken"))

        def step(s: Column, i: Column) -> Column:
            open_row = ~filled[i] & (named["picks"][i] < 0)
            pick = F.when(open_row, first(s, F.array_except(s["valid"], s["used"]))).otherwise(F.lit(-1))
            return let(pick, lambda p: _take(s, p, primaries, deduplicate))

        return F.aggregate(rows, begin, step, lambda s: F.zip_with(named["picks"], s["picks"], lambda a, b: F.greatest(a, b)))

    folded = let(F.aggregate(rows, start, by_id), rest)
    return F.when(F.size(filled) > 0, folded).otherwise(no_ints)


def _take(s: Column, p: Column, primaries: Column, deduplicate: bool) -> Column:
    taken = s["taken"]
    if deduplicate:
        taken = F.when(p >= 0, F.array_append(taken, primaries[p])).otherwise(taken)
    return F.struct(
        s["valid"].alias("valid"),
        F.when(p >= 0, F.array_append(s["used"], p)).otherwise(s["used"]).alias("used"),
        F.array_append(s["picks"], p).alias("picks"),
        taken.alias("taken"),
    )


def apply_fills(df: DataFrame, fills: DataFrame, columns: list[str], row_id: str = "row_id") -> DataFrame:
    """Overwrite all output columns of the rows that got values; new columns go right.

    ``fills`` has at most one row per row id, with a non-null ``phase``. A null value sets nothing: the row
    keeps what it has in that column.
    """
    new = fills.select(row_id, F.col("phase").alias("_phase"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = ensure_columns(df, columns).join(new, row_id, "left")
    order = [*df.columns, *[c for c in columns if c not in df.columns]]
    hit = F.col("_phase").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.coalesce(f"_new_{c}", c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in order
        ]
    )


def existing_values(df: DataFrame, column: str, min_length: int) -> DataFrame:
    """Digests of the long enough values a column already holds, one row each."""
    return df.where(is_filled(column, min_length)).select(digest(column).alias("d")).distinct()


def first_of_each_value(
    candidates: DataFrame, column: str, row_id: str = "row_id", used: DataFrame | None = None
) -> DataFrame:
    """Row ids of the candidates that keep their value: the first row of each value, and none
    whose value is in ``used`` (a table of digests ``d``).

    Row id order is batch and position order. One row per value leaves each task, so a value that a
    third of all rows share costs no more than any other, and the anti join sees every value once. Of ``used``,
    however large, only the values that a bit table of the candidates does not rule out are shuffled.
    """
    first = candidates.groupBy(digest(column).alias("d")).agg(F.min(row_id).alias(row_id))
    if used is not None:
        hits = maybe_in(used, F.xxhash64("d"), bit_table(candidates, F.xxhash64(digest(column))))
        first = first.join(hits, "d", "left_anti")
    return first.select(row_id)


def deduplicate(
    candidates: DataFrame, column: str, row_id: str = "row_id", used: DataFrame | None = None
) -> DataFrame:
    """Candidates that keep their value; the others stay gaps."""
    return candidates.join(first_of_each_value(candidates, column, row_id, used), row_id, "left_semi")
