"""R: profiling reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenweave.catalog.registry import SQL_WS, query, sql_text, table
from evenweave.operators import checks as C
from evenweave.operators import profile as P

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]
EXPECTED_EACH = 3003
PLANNED = 15000
_VALUES = "(VALUES " + ", ".join(f"({sql_text(p)})" for p in PRIORITIES) + ") e(value)"


def _expected(spark):
    return spark.createDataFrame([(p, EXPECTED_EACH) for p in PRIORITIES], "value string, expected long")


_COMPARISON = f"""
SELECT value, CAST({EXPECTED_EACH} AS BIGINT) AS expected, coalesce(n, 0) AS actual, coalesce(n, 0) = {EXPECTED_EACH} AS ok
FROM {_VALUES} LEFT JOIN (SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1) a USING (value)"""
_BAR = f"CAST(greatest(1, actual // greatest(1, {PLANNED} // 50)) AS INTEGER)"


@query("R1_marginal_report", f"SELECT *, {_BAR} AS bar_length, repeat('█', {_BAR}) AS bar FROM ({_COMPARISON})")
def r1(spark, sf_dir):
    return P.marginal_report(table(spark, sf_dir, "orders"), "o_orderpriority", _expected(spark), PLANNED)


@query("R1_R2_complete_report", """
WITH cells AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS value FROM orders
               UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders),
a AS (SELECT "column", value, count(*) AS actual FROM cells GROUP BY ALL),
e AS (SELECT * FROM (VALUES ('o_orderstatus', 'F', 700), ('o_orderstatus', 'none', 5), ('o_orderpriority', '1-URGENT', 300))
      AS t("column", value, expected))
SELECT coalesce(e."column", a."column") AS "column", coalesce(e.value, a.value) AS value,
       CAST(coalesce(expected, 0) AS BIGINT) AS expected, coalesce(actual, 0) AS actual,
       coalesce(expected, 0) = coalesce(actual, 0) AS ok
FROM e FULL JOIN a ON e."column" = a."column" AND e.value = a.value""")
def r1_r2_complete(spark, sf_dir):
    expected = [("o_orderstatus", "F", 700), ("o_orderstatus", "none", 5), ("o_orderpriority", "1-URGENT", 300)]
    table_of = spark.createDataFrame(expected, "column string, value string, expected long")
    return P.complete_comparison(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], table_of)


@query("R2_distribution_comparison", _COMPARISON)
def r2(spark, sf_dir):
    return P.comparison(table(spark, sf_dir, "orders"), "o_orderpriority", _expected(spark))


def _cross_sql(row: str, column: str, values: list, expected: int, source: str) -> str:
    def cell(v):
        return f"count(*) FILTER ({column} = {sql_text(v)})"

    cells = ", ".join(f'{cell(v)} AS "{v}"' for v in values)
    total = " + ".join(cell(v) for v in values)
    ok = " AND ".join(f"{cell(v)} = {expected}" for v in values)
    return f"SELECT {row}, {cells}, {total} AS total, {ok} AS ok FROM {source} GROUP BY {row}"


@query("R3_cross_tab_flag_status", _cross_sql("l_returnflag", "l_linestatus", ["F", "O", "X"], 10000, "lineitem"))
def r3(spark, sf_dir):
    return P.cross_tab(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O", "X"], 10000)


@query("R4_cross_tab_status_priority", _cross_sql("o_orderstatus", "o_orderpriority", PRIORITIES[:5], 1000, "orders"))
def r4(spark, sf_dir):
    return P.cross_tab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES[:5], 1000)


@query("R5_counts_per_group", """
SELECT r_name AS "group", string_agg(n_name || '=' || n, ', ' ORDER BY n_nationkey) AS counts, bool_and(n = 60) AS ok
FROM (SELECT r_name, n_name, n_nationkey, count(c_custkey) AS n FROM nation JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3) GROUP BY r_name""")
def r5(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    members = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("group"), F.col("n_nationkey").cast("string").alias("member"),
        F.col("n_nationkey").alias("rank"), "n_name",
    )
    customers = table(spark, sf_dir, "customer").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey"
    )
    named = members.select("group", F.col("n_name").alias("member"), "rank")
    return P.counts_per_group(customers, "n_name", named, 60)


_WORDS = f"length(regexp_replace(regexp_replace(text, '[^{SQL_WS}]+', 'x', 'g'), '[{SQL_WS}]+', '', 'g'))"


@query("R6_word_statistics", f"""
SELECT CAST(min(w) AS INTEGER) AS min_words, round(avg(w), 1) AS avg_words,
       CAST(round_even(median(w), 0) AS BIGINT) AS median_words, CAST(max(w) AS INTEGER) AS max_words
FROM (SELECT {_WORDS} AS w FROM documents)""")
def r6(spark, sf_dir):
    return P.word_statistics(table(spark, sf_dir, "documents"), "text")


@query("R7_text_counts", """
SELECT count(*) - count(DISTINCT coalesce(text, chr(1))) AS duplicates,
       count(*) FILTER (length(coalesce(text, '')) < 5) AS empty FROM documents""")
def r7(spark, sf_dir):
    return P.text_counts(table(spark, sf_dir, "documents"), "text")


def _preview_sql(tail: bool) -> str:
    head_or_tail = "ORDER BY o_orderkey DESC LIMIT 30" if tail else "ORDER BY o_orderkey LIMIT 45"
    first = "" if tail else "WHEN p1 IS DISTINCT FROM a THEN 'new status' "
    second = "p1 IS DISTINCT FROM a OR p2 IS DISTINCT FROM b"
    return f"""
SELECT o_orderkey, a AS o_orderstatus, b AS o_orderpriority, c AS block,
       CASE {first}WHEN {second} THEN 'new priority' WHEN p3 IS DISTINCT FROM c THEN '·' ELSE '' END AS marker
FROM (SELECT *, lag(a) OVER w AS p1, lag(b) OVER w AS p2, lag(c) OVER w AS p3 FROM (
        SELECT o_orderkey, o_orderstatus AS a, o_orderpriority AS b, CAST(o_orderkey // 2 AS VARCHAR) AS c
        FROM orders {head_or_tail}) WINDOW w AS (ORDER BY o_orderkey))"""


def _preview(tail):
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").withColumn(
            "block", F.call_function("div", "o_orderkey", F.lit(2)).cast("string")
        )
        levels, names = ["o_orderstatus", "o_orderpriority", "block"], ["status", "priority", "block"]
        return P.preview(orders, "o_orderkey", levels, 30 if tail else 45, tail, names)

    return run


query("R8_preview_head", _preview_sql(False))(_preview(False))
query("R8_preview_tail", _preview_sql(True))(_preview(True))


def document_batches(spark, sf_dir):
    """Ledger rows made from the labels' coverage of 30-document batches."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    covered = docs.select("doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left")
    batch = F.call_function("div", "doc_id", F.lit(30))
    counts = covered.groupBy(batch.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("quality").alias("filled")
    )
    return counts.withColumns(
        {"elapsed": (F.col("batch_id") % 5).cast("double"), "total": F.when(F.col("batch_id") % 9 == 8, 0).otherwise(F.col("rows"))}
    )


DOCUMENT_BATCHES_SQL = """
SELECT doc_id // 30 AS batch_id, count(*) AS rows, count(quality) AS filled, CAST((doc_id // 30) % 5 AS DOUBLE) AS elapsed,
       CASE WHEN (doc_id // 30) % 9 = 8 THEN 0 ELSE count(*) END AS total
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY doc_id // 30"""


@query("R9_throughput", f"""
SELECT *, CASE WHEN elapsed > 0 THEN rows / elapsed ELSE 0.0 END AS rows_per_s,
       CASE WHEN total > 0 THEN filled * 100.0::DOUBLE / total ELSE 0.0 END AS pct FROM ({DOCUMENT_BATCHES_SQL})""")
def r9(spark, sf_dir):
    return P.throughput(document_batches(spark, sf_dir), "rows", "elapsed", "filled", "total")


@query("R10_run_summary", """
WITH runs AS (SELECT o_orderpriority AS task, count(*) AS rows, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS elapsed
              FROM orders GROUP BY 1)
SELECT string_agg(task, ', ' ORDER BY task) AS tasks, arg_max(rows, task) AS total_rows, sum(elapsed) AS total_time,
       arg_max(rows, task) / sum(elapsed) AS rows_per_s,
       (SELECT count(*) FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'X') = 0 AS valid, 'out' AS output_path
FROM runs""")
def r10(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("task")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").cast("double").alias("elapsed")
    )
    runs = runs.withColumn("seq", F.col("task"))
    violations = C.forbidden_pairs(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", [("N", "X")])
    return P.run_summary(runs, violations, "out")


@query("R11_usage_statistics", """
SELECT role AS task, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS reasoning_chars,
       CAST(sum(turn) AS BIGINT) AS prompt_tokens, CAST(sum(conv_id % 7) AS BIGINT) AS completion_tokens,
       CAST(sum(CASE WHEN conv_id % 2 = 0 THEN turn + conv_id % 7 ELSE 50 END) AS BIGINT) AS total_tokens
FROM conversations GROUP BY role""")
def r11(spark, sf_dir):
    calls = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("task"), F.col("text").alias("reasoning"), F.col("turn").alias("prompt_tokens"),
        (F.col("conv_id") % 7).alias("completion_tokens"),
        F.when(F.col("conv_id") % 2 == 1, F.lit(50)).cast("long").alias("total_tokens"),
    )
    return P.usage_statistics(calls)
