"""Validation as tables of violations ``(check, key, expected, actual)``; an empty table means valid.

The composite checks read the data once: a grouping-sets aggregate shrinks it to a cell table whose
size depends on the number of distinct values, and every count check is derived from those cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenweave.functions.text import contains_any, digest, is_filled, stripped_length
from evenweave.operators.order import first_late_row
from evenweave.operators.skeleton import list_rank, lookup
from evenweave.operators.terms import flag_terms
from evenweave.spec import BalanceSpec

VIOLATION = "check string, key string, expected long, actual long"


def _violations(df: DataFrame, check: str, key: Column, expected: Column, actual: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        key.cast("string").alias("key"),
        expected.cast("long").alias("expected"),
        actual.cast("long").alias("actual"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("(null)"))


def _same(expected: Column, actual: Column) -> Column:
    """Equal and both known: an unknown source value or a missing target counts as a mismatch."""
    return F.coalesce(expected == actual, F.lit(False))


# ---------------------------------------------------------------- single checks


def missing_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """V1: required columns the table lacks. Looks at the schema only."""
    rows = [("V1", c, 1, 0) for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, VIOLATION)


def row_count(df: DataFrame, expected: int) -> DataFrame:
    """V2: total number of rows."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return _violations(n, "V2", F.lit("rows"), F.lit(expected), F.col("n")).where("expected <> actual")


def marginal(df: DataFrame, column: str, expected: DataFrame, strict: bool) -> DataFrame:
    """V3 (lenient) and V4 (strict): value counts against ``expected(value, expected)``.

    Strict also reports values that are not expected at all (expected count 0).
    """
    actual = df.groupBy(_text(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    how = "full" if strict else "right"
    joined = actual.join(expected.select("value", "expected"), "value", how)
    exp, act = F.coalesce(F.col("expected"), F.lit(0)), F.coalesce(F.col("n"), F.lit(0))
    key = F.concat(F.lit(f"{column}="), F.col("value"))
    return _violations(joined, "V4" if strict else "V3", key, exp, act).where("expected <> actual")


def implied_value(df: DataFrame, source: str, target: str, mapping: dict[str, str]) -> DataFrame:
    """V5: number of rows whose target is not the value implied by the source."""
    bad = ~_same(lookup(source, mapping), F.col(target))
    n = df.agg(F.count_if(bad).alias("n"))
    return _violations(n, "V5", F.lit(f"{source}->{target}"), F.lit(0), F.col("n")).where("actual > 0")


def forbidden_pairs(df: DataFrame, first: str, second: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """V6: number of rows that hold one of the forbidden value pairs."""
    hit = reduce(
        lambda a, b: a | b, [(F.col(first) == x) & (F.col(second) == y) for x, y in pairs], F.lit(False)
    )
    n = df.agg(F.count_if(hit).alias("n"))
    return _violations(n, "V6", F.lit(f"{first}x{second}"), F.lit(0), F.col("n")).where("actual > 0")


def cell_counts(df: DataFrame, check: str, keys: list[str], expected: DataFrame) -> DataFrame:
    """Counts per value combination against ``expected(<keys>, expected)``; absent cells are 0."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    joined = expected.join(counts, keys, "left")
    key = F.concat_ws("/", *[_text(k) for k in keys])
    actual = F.coalesce(F.col("n"), F.lit(0))
    return _violations(joined, check, key, F.col("expected"), actual).where("expected <> actual")


def grouping_order(
    df: DataFrame, row_id: str, ranks: list[Column], labels: list[str], chunk_rows: int = 1_000_000
) -> DataFrame:
    """First row, in ``row_id`` order, whose rank key is lower than its predecessor's.

    Reads the table once, by summaries that merge (see ``order``): no row is shuffled, whatever the number of keys. Only
    rows that lie out of order in storage are compared in chunks of row ids instead. Ranks are whole numbers.
    """
    found = first_late_row(df, row_id, ranks, labels)
    if found is None or not found.overlap:
        late = [] if found is None or found.late is None else [
            ("V12", "/".join("(null)" if v is None else v for v in found.late_labels), None, found.late)]
        return df.sparkSession.createDataFrame(late, VIOLATION)
    keyed = df.select(row_id, F.struct(*ranks).alias("_key"), *labels)
    first = _below_predecessor(keyed, row_id, chunk_rows).agg(
        F.min_by(F.struct(F.col(row_id), *labels), F.col(row_id)).alias("f")
    ).where("f is not null")
    key = F.concat_ws("/", *[F.coalesce(F.col(f"f.{c}").cast("string"), F.lit("(null)")) for c in labels])
    return _violations(first, "V12", key, F.lit(None), F.col(f"f.{row_id}"))


def _below_predecessor(keyed: DataFrame, row_id: str, chunk_rows: int) -> DataFrame:
    """Rows below their predecessor, for any number of keys: ``lag`` inside chunks of row ids.

    A chunk holds at most ``chunk_rows`` rows, whatever the keys are. The predecessor of a chunk's
    first row comes from a summary with one row per chunk.
    """
    chunked = keyed.withColumn(
        "_chunk", F.call_function("div", F.col(row_id).cast("long"), F.lit(chunk_rows).cast("long"))
    )
    inside = W.partitionBy("_chunk").orderBy(row_id)
    lagged = chunked.withColumn("_previous", F.lag("_key").over(inside))
    last = chunked.groupBy("_chunk").agg(F.max_by("_key", row_id).alias("_last"))
    before = last.select("_chunk", F.lag("_last").over(W.orderBy("_chunk")).alias("_carried"))
    # Only the first row of a chunk needs the carried key.
    starts = lagged.where(F.col("_previous").isNull()).join(before, "_chunk").where("_key < _carried")
    return lagged.where(F.col("_key") < F.col("_previous")).select(keyed.columns).unionByName(
        starts.select(keyed.columns)
    )


def code_mismatches(df: DataFrame, codes: dict[str, dict], suffix: str = "_num") -> DataFrame:
    """``(column, n)``: per coded column the number of rows whose code is not the one of the value; one pass."""
    bad = [
        F.count_if(~_same(lookup(c, m), F.col(f"{c}{suffix}"))).alias(f"n{i}")
        for i, (c, m) in enumerate(codes.items())
    ]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n")) for i, c in enumerate(codes)]
    )
    return df.agg(*bad).select(F.explode(pairs).alias("p")).select("p.column", "p.n")


def code_mapping(df: DataFrame, codes: dict[str, dict], suffix: str = "_num") -> DataFrame:
    """Coded columns with rows whose code is not the one of the value."""
    out = code_mismatches(df, codes, suffix)
    return _violations(out, "V13", F.col("column"), F.lit(0), F.col("n")).where("actual > 0")


def _per_text(df: DataFrame, **tests: Column) -> DataFrame:
    """Rows per distinct text with the outcome of tests that depend on the text alone.

    Groups by a 32-byte digest; repeated texts collapse map-side, however often one occurs.
    """
    flags = [c.alias(n) for n, c in tests.items()]
    rows = df.select(digest("_text").alias("d"), *flags)
    return rows.groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), *[F.bool_or(n).alias(n) for n in tests]
    )


def duplicate_texts(df: DataFrame, column: str, longer_than: int = 5) -> DataFrame:
    """Number of distinct texts that occur more than once and are longer than the bound."""
    texts = df.select(F.col(column).alias("_text")).where(stripped_length("_text") > longer_than)
    n = _per_text(texts).agg(F.count_if(F.col("n") > 1).alias("n"))
    return _violations(n, "V14", F.lit(column), F.lit(0), F.col("n")).where("actual > 0")


def _text_violations(counts: DataFrame, column: str, checks: dict[str, str]) -> DataFrame:
    cells = [F.struct(F.lit(k).alias("check"), F.col(c).alias("n")) for k, c in checks.items()]
    rows = counts.select(F.explode(F.array(*cells)).alias("r"))
    return rows.select(
        F.col("r.check").alias("check"),
        F.lit(column).alias("key"),
        F.lit(0).cast("long").alias("expected"),
        F.col("r.n").alias("actual"),
    ).where("actual > 0")


def text_rules(df: DataFrame, column: str, banned: list[str] | DataFrame, shorter_than: int = 5) -> DataFrame:
    """V15 and V16 in one pass: tiny texts, and texts with a banned term.

    A list of terms is searched term by term, which suits a few dozen. A DataFrame of terms (its first column) may hold
    any number: each group of terms that fits in memory reads every text once.
    """
    texts = df.select(F.col(column).alias("_text"))
    if isinstance(banned, DataFrame):
        texts = flag_terms(texts, "_text", banned, banned.columns[0])
    else:
        texts = texts.withColumn("banned", contains_any("_text", banned))
    counts = texts.agg(
        F.count_if(stripped_length("_text") < shorter_than).alias("tiny"), F.count_if("banned").alias("banned"),
    )
    return _text_violations(counts, column, {"V15": "tiny", "V16": "banned"})


def text_checks(
    df: DataFrame, column: str, banned: list[str], longer_than: int = 5, shorter_than: int = 5
) -> DataFrame:
    """V14, V15 and V16 in one pass over the texts: all three depend on the text alone, so they are
    judged once per row, and counted per distinct text."""
    length = stripped_length("_text")
    texts = _per_text(
        df.select(F.col(column).alias("_text")),
        long=length > longer_than,
        tiny=length < shorter_than,
        banned=contains_any("_text", banned),
    )
    counts = texts.agg(
        F.count_if((F.col("n") > 1) & F.col("long")).alias("repeated"),
        F.coalesce(F.sum(F.when(F.col("tiny"), F.col("n"))), F.lit(0)).alias("tiny"),
        F.coalesce(F.sum(F.when(F.col("banned"), F.col("n"))), F.lit(0)).alias("banned"),
    )
    return _text_violations(counts, column, {"V14": "repeated", "V15": "tiny", "V16": "banned"})


def fill_rate(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """``(column, filled, total)`` for several columns in one pass; absent columns count 0."""
    total = F.count(F.lit(1)).alias("total")
    present = [c for c in columns if c in df.columns]
    counts = [F.count_if(is_filled(c, columns[c])).alias(f"f{i}") for i, c in enumerate(present)]
    agg = df.agg(total, *counts)
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"f{present.index(c)}") if c in present else F.lit(0).cast("long")).alias("filled"),
        )
        for c in columns
    ]
    return agg.select(F.explode(F.array(*cells)).alias("c"), "total").select("c.column", "c.filled", "total")


# ---------------------------------------------------------------- composite checks


def observed_cells(df: DataFrame, spec: BalanceSpec) -> DataFrame:
    """One scan: joint cells of the grid columns plus one marginal per quota column.

    Rows ``(part, group, item, label, tone, implied, value, n)``; ``part`` is "joint" or the column.
    """
    joint = [spec.group_col, spec.item_col, spec.label_col, spec.tone_col, spec.implied_col]
    quota = list(spec.quota_values)
    columns = joint + quota
    # Null cells become text first, so a null from a grouping set is never mistaken for a value.
    flat = df.select(*[_text(c).alias(c) for c in columns])
    sets = [[F.col(c) for c in joint]] + [[F.col(c)] for c in quota]
    agg = flat.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    part, value = F.lit("joint"), F.lit(None).cast("string")
    for c in quota:
        part = F.when(F.col(c).isNotNull(), F.lit(c)).otherwise(part)
        value = F.coalesce(value, F.col(c))
    return agg.select(
        part.alias("part"),
        F.col(spec.group_col).alias("g"),
        F.col(spec.item_col).alias("i"),
        F.col(spec.label_col).alias("l"),
        F.col(spec.tone_col).alias("t"),
        F.col(spec.implied_col).alias("m"),
        value.alias("value"),
        "n",
    )


def expected_cells(spark: SparkSession, spec: BalanceSpec, total_rows: int, quotas=None) -> DataFrame:
    """Everything the spec demands of the cell counts: ``(check, key, expected)``. Spec-sized."""
    per_item = spec.rows_per_item * spec.cycles
    rows = [("V2", "rows", total_rows)]
    quotas = spec.quotas() if quotas is None else quotas
    rows += [
        ("V4", f"{c}={v}", n) for c, v, n in spec.expected_marginals() if c not in quotas
    ]
    rows += [("V4", f"{c}={v}", n) for c, q in quotas.items() for v, n in q]
    rows += [("V5", f"{spec.tone_col}->{spec.implied_col}", 0)]
    rows += [("V6", f"{spec.label_col}x{spec.tone_col}", 0)]
    for g, items in spec.hierarchy.items():
        for i in items:
            rows.append(("V7", f"{g}/{i}", per_item))
            for t in spec.tone_order:
                rows.append(("V8", f"{g}/{i}/{t}", spec.template_weight(tone=t) * spec.cycles))
            for e in spec.label_order:
                rows.append(("V8", f"{g}/{i}/{e}", spec.template_weight(label=e) * spec.cycles))
            for e, t, w in spec.template:
                rows.append(("V9", f"{g}/{i}/{e}/{t}", w * spec.cycles))
        for t in spec.tone_order:
            rows.append(("V10", f"{g}/{t}", spec.template_weight(tone=t) * len(items) * spec.cycles))
        for e in spec.label_order:
            rows.append(("V11", f"{g}/{e}", spec.template_weight(label=e) * len(items) * spec.cycles))
    return spark.createDataFrame(rows, "check string, key string, expected long")


def cells_to_checks(cells: DataFrame, spec: BalanceSpec) -> DataFrame:
    """Roll the cell table up to ``(check, key, actual)`` for V2 and V4-V11."""
    g, i, e, t, m = (
        F.col("g"), F.col("i"), F.col("l"), F.col("t"), F.col("m")
    )

    def entry(check: str, key: Column, when: Column = F.lit(True)) -> Column:
        return F.struct(F.lit(check).alias("check"), F.when(when, key).alias("key"))

    def named(column: str, c: Column) -> Column:
        return F.concat(F.lit(f"{column}="), c)

    wrong = ~_same(lookup(t, spec.implied), m)
    forbidden = reduce(
        lambda a, b: a | b, [(e == x) & (t == y) for x, y in spec.forbidden], F.lit(False)
    )
    from_joint = F.array(
        entry("V2", F.lit("rows")),
        entry("V4", named(spec.group_col, g)),
        entry("V4", named(spec.item_col, i)),
        entry("V4", named(spec.label_col, e)),
        entry("V4", named(spec.tone_col, t)),
        entry("V4", named(spec.implied_col, m)),
        entry("V5", F.lit(f"{spec.tone_col}->{spec.implied_col}"), wrong),
        entry("V6", F.lit(f"{spec.label_col}x{spec.tone_col}"), forbidden),
        entry("V7", F.concat_ws("/", g, i)),
        entry("V8", F.concat_ws("/", g, i, t)),
        entry("V8", F.concat_ws("/", g, i, e)),
        entry("V9", F.concat_ws("/", g, i, e, t)),
        entry("V10", F.concat_ws("/", g, t)),
        entry("V11", F.concat_ws("/", g, e)),
    )
    from_quota = F.array(entry("V4", F.concat_ws("=", F.col("part"), F.col("value"))))
    exploded = cells.select(
        F.explode(F.when(F.col("part") == "joint", from_joint).otherwise(from_quota)).alias("c"), "n"
    ).where("c.key is not null")
    return exploded.groupBy("c.check", "c.key").agg(F.sum("n").alias("actual"))


def judge_cells(
    cells: DataFrame, spec: BalanceSpec, checks: list[str], strict: bool, total_rows: int, quotas=None
) -> DataFrame:
    """Violations of the count checks from a cell table, whatever rows it was counted from."""
    actual = cells_to_checks(cells, spec).where(F.col("check").isin(checks))
    expected = expected_cells(cells.sparkSession, spec, total_rows, quotas).where(F.col("check").isin(checks))
    joined = expected.join(actual, ["check", "key"], "full").select(
        "check", "key", "expected", F.coalesce("actual", F.lit(0)).alias("actual")
    )
    # Cells the spec does not list: only the strict marginal check reports them, as expected 0.
    known = F.col("expected").isNotNull()
    if strict:
        known = known | (F.col("check") == "V4")
    bad = joined.where(known).withColumn("expected", F.coalesce("expected", F.lit(0)).cast("long"))
    return bad.where("expected <> actual")


def skip_cells_of_failed_items(bad: DataFrame) -> DataFrame:
    """V8/V9 are not judged for items whose total (V7) is already wrong.

    A window over the violations, not a join of them with themselves, so the data is scanned once.
    """
    item = F.when(F.col("check").isin("V7", "V8", "V9"), F.substring_index("key", "/", 2)).otherwise(
        F.concat_ws("/", "check", "key")
    )
    failed = F.max(F.col("check") == "V7").over(W.partitionBy(item))
    marked = bad.withColumn("_failed", failed)
    return marked.where(~(F.col("_failed") & F.col("check").isin("V8", "V9"))).drop("_failed")


def rank_columns(spec: BalanceSpec) -> list[Column]:
    """Rank key of V12: group, item within group, label, tone; unknown values rank 99."""
    pairs = [f"{g}\t{i}" for g, items in spec.hierarchy.items() for i in items]
    ranks = {f"{g}\t{i}": k for g, items in spec.hierarchy.items() for k, i in enumerate(items)}
    item_rank = F.coalesce(
        lookup(F.concat_ws("\t", spec.group_col, spec.item_col), {p: ranks[p] for p in pairs}), F.lit(99)
    )
    return [
        list_rank(spec.group_col, spec.groups).alias("r1"),
        item_rank.alias("r2"),
        list_rank(spec.label_col, spec.label_order).alias("r3"),
        list_rank(spec.tone_col, spec.tone_order).alias("r4"),
    ]


def verify_skeleton(
    df: DataFrame, spec: BalanceSpec, total_rows: int | None = None, quotas=None
) -> DataFrame:
    """V2, V4-V13 on a table with ``row_id``."""
    total = spec.total_rows if total_rows is None else total_rows
    checks = ["V2", "V4", "V5", "V6", "V7", "V8", "V9", "V10", "V11"]
    counts = skip_cells_of_failed_items(judge_cells(observed_cells(df, spec), spec, checks, True, total, quotas))
    labels = [spec.group_col, spec.item_col, spec.label_col, spec.tone_col]
    return _union(
        [
            counts,
            grouping_order(df, "row_id", rank_columns(spec), labels),
            code_mapping(df, spec.codes),
        ]
    )


def validate_dataset(
    df: DataFrame,
    spec: BalanceSpec,
    banned: list[str],
    text_col: str = "text",
    total_rows: int | None = None,
    quotas=None,
) -> DataFrame:
    """V1, V2, V3, V5, V6, V9-V11, V14-V16. Missing columns are reported alone."""
    lacking = [c for c in spec.column_order if c not in df.columns]
    if lacking:
        return missing_columns(df, spec.column_order)
    total = spec.total_rows if total_rows is None else total_rows
    checks = ["V2", "V4", "V5", "V6", "V9", "V10", "V11"]
    counts = judge_cells(observed_cells(df, spec), spec, checks, False, total, quotas)
    lenient = counts.withColumn("check", F.when(F.col("check") == "V4", "V3").otherwise(F.col("check")))
    return _union([lenient, text_checks(df, text_col, banned)])


def is_valid(violations: DataFrame) -> bool:
    return violations.isEmpty()
