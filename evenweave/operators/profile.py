"""Profiling reports as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenweave.functions.text import digest, word_count


def comparison(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """R2: ``(value, expected, actual, ok)`` for every expected value.

    Further columns of ``expected``, such as a rank to sort the report by, are kept.
    """
    actual = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("actual"))
    got = F.coalesce("actual", F.lit(0))
    out = expected.join(actual, "value", "left")
    return out.select(*expected.columns, got.alias("actual"), (got == F.col("expected")).alias("ok"))


def complete_comparison(df: DataFrame, columns: list[str], expected: DataFrame) -> DataFrame:
    """R1/R2 for all columns at once: ``(column, value, expected, actual, ok)`` from one scan of the table.

    ``expected`` has the rows ``(column, value, expected)`` of a spec. Values that are not expected count too,
    with an expectation of 0. Rows become one count per column and value in the tasks that read them.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ]))
    counts = df.select(cells.alias("c")).groupBy("c.column", "c.value").agg(F.count(F.lit(1)).alias("actual"))
    same = (F.col("e.column") == F.col("a.column")) & F.col("e.value").eqNullSafe(F.col("a.value"))
    both = expected.alias("e").join(counts.alias("a"), same, "full")
    wanted, got = F.coalesce("e.expected", F.lit(0)), F.coalesce("a.actual", F.lit(0))
    return both.select(
        F.coalesce("e.column", "a.column").alias("column"), F.coalesce("e.value", "a.value").alias("value"),
        wanted.alias("expected"), got.alias("actual"), (wanted == got).alias("ok"),
    )


def bar_length(actual: Column, total: Column | int) -> Column:
    """One block per fiftieth of the table, at least one."""
    n = F.lit(total) if isinstance(total, int) else total
    unit = F.greatest(F.lit(1), F.floor(n / 50))
    return F.greatest(F.lit(1), F.floor(actual / unit)).cast("int")


def marginal_report(df: DataFrame, column: str, expected: DataFrame, total_rows: int) -> DataFrame:
    """Comparison with bar. ``total_rows`` is the planned size, which sets the bar's unit."""
    bar = bar_length(F.col("actual"), total_rows)
    return comparison(df, column, expected).select(
        "*", bar.alias("bar_length"), F.repeat(F.lit("█"), bar).alias("bar")
    )


def cross_tab(
    df: DataFrame, row: str, column: str, values: list[str], expected: int | dict[str, int]
) -> DataFrame:
    """One row per row value with a count per listed column value, total and ok flag."""
    counts = df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0, values)
    want = expected if isinstance(expected, dict) else {v: expected for v in values}
    total, ok = F.lit(0).cast("long"), F.lit(True)
    for v in values:
        total, ok = total + F.col(f"`{v}`"), ok & (F.col(f"`{v}`") == want[v])
    return counts.withColumns({"total": total, "ok": ok})


def counts_per_group(
    df: DataFrame, column: str, members: DataFrame, expected: int
) -> DataFrame:
    """Per group the line ``member=count, ...`` in member order, and whether all are as expected.

    ``members(group, member, rank)`` is the hierarchy; counts look at the member column alone.
    """
    actual = df.groupBy(F.col(column).alias("member")).agg(F.count(F.lit(1)).alias("n"))
    joined = members.join(actual, "member", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("rank", "member", "n")))
    line = F.array_join(
        F.transform(parts, lambda p: F.concat(p["member"], F.lit("="), p["n"].cast("string"))), ", "
    )
    return joined.groupBy("group").agg(
        line.alias("counts"), F.bool_and(F.col("n") == expected).alias("ok")
    )


def word_statistics(df: DataFrame, column: str) -> DataFrame:
    """Min, mean (1 decimal), median (whole) and max number of words.

    Texts shrink to a histogram of word counts map-side; the exact median is read off the histogram.
    """
    histogram = df.groupBy(word_count(column).alias("words")).agg(F.count(F.lit(1)).alias("n"))
    return histogram.agg(
        F.min("words").alias("min_words"),
        F.round(F.sum(F.col("words") * F.col("n")) / F.sum("n"), 1).alias("avg_words"),
        F.bround(F.percentile("words", F.lit(0.5), F.col("n")), 0).cast("long").alias("median_words"),
        F.max("words").alias("max_words"),
    )


def text_counts(df: DataFrame, column: str, shorter_than: int = 5) -> DataFrame:
    """Rows that repeat an earlier text (null repeats null), and texts shorter than the bound."""
    length = F.coalesce(F.length(column), F.lit(0))
    per_text = df.groupBy(F.col(column).isNull().alias("missing"), digest(column).alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(length < shorter_than).alias("short")
    )
    return per_text.agg(
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates"), F.sum("short").alias("empty")
    )


def preview(
    df: DataFrame, row_id: str, levels: list[str], n: int, tail: bool = False, names: list[str] | None = None
) -> DataFrame:
    """First or last ``n`` rows with a marker where a group starts.

    The marker names the outermost level that changed; the innermost level's is "·". The tail leaves
    the outermost level out of the comparison's naming, so its change shows as the second level's.
    Top-n first, then the window over those n rows.
    """
    names = names or levels
    order = F.col(row_id).desc() if tail else F.col(row_id).asc()
    top = df.select(row_id, *levels).orderBy(order).limit(n)
    w = W.orderBy(row_id)
    prior = {c: F.coalesce(F.lag(c).over(w), F.lit("")) for c in levels}
    changed = {c: ~F.coalesce(F.col(c), F.lit("")).eqNullSafe(prior[c]) for c in levels}
    marker = None
    upper = F.lit(False)
    for i, (c, name) in enumerate(zip(levels, names)):
        upper = upper | changed[c]
        if tail and i == 0:
            continue
        text = F.lit("·") if i == len(levels) - 1 else F.lit(f"new {name}")
        marker = F.when(upper, text) if marker is None else marker.when(upper, text)
    return top.withColumn("marker", marker.otherwise(F.lit("")))


def throughput(ledger: DataFrame, rows: str, elapsed: str, filled: str, total: str) -> DataFrame:
    """``rows_per_s`` (0 without elapsed time) and ``pct`` filled (0 for an empty table)."""
    speed = F.when(F.col(elapsed) > 0, F.col(rows) / F.col(elapsed)).otherwise(F.lit(0.0))
    pct = F.when(F.col(total) > 0, F.col(filled) * 100.0 / F.col(total)).otherwise(F.lit(0.0))
    return ledger.withColumns({"rows_per_s": speed, "pct": pct})


def run_summary(runs: DataFrame, violations: DataFrame, path: str) -> DataFrame:
    """One row over the task runs ``(task, seq, rows, elapsed)``: tasks, rows, time, rate, valid."""
    tasks = F.sort_array(F.collect_list(F.struct("seq", "task")))
    summary = runs.agg(
        F.array_join(F.transform(tasks, lambda t: t["task"]), ", ").alias("tasks"),
        F.max_by("rows", "seq").alias("total_rows"),
        F.sum("elapsed").alias("total_time"),
    )
    bad = violations.agg(F.count(F.lit(1)).alias("n")).scalar()
    speed = F.when(F.col("total_time") > 0, F.col("total_rows") / F.col("total_time")).otherwise(F.lit(0.0))
    return summary.withColumns(
        {"rows_per_s": speed, "valid": bad == 0, "output_path": F.lit(path)}
    )


def usage_statistics(responses: DataFrame, key: str = "task") -> DataFrame:
    """Calls, reasoning characters and tokens per task.

    Input ``(key, reasoning, prompt_tokens, completion_tokens, total_tokens)``; a missing total is the
    sum of the two.
    """
    prompt, completion = F.coalesce("prompt_tokens", F.lit(0)), F.coalesce("completion_tokens", F.lit(0))
    return responses.groupBy(key).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(F.length(F.coalesce("reasoning", F.lit("")))).alias("reasoning_chars"),
        F.sum(prompt).alias("prompt_tokens"),
        F.sum(completion).alias("completion_tokens"),
        F.sum(F.coalesce("total_tokens", prompt + completion)).alias("total_tokens"),
    )
