"""K: balanced grids and quotas laid over the orders, suppliers and customers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.catalog.registry import query, sql_case, sql_draw, sql_list, sql_text, table
from evenweave.example import ad_spec
from evenweave.functions.draws import conditional_choice, uniform_choice
from evenweave.operators import quota as Q
from evenweave.operators import skeleton as S
from evenweave.spec import even_quota, spec_problems

SPEC = ad_spec(cycles=1)
PRIORITY_ORDER = ["5-LOW", "3-MEDIUM", "1-URGENT", "2-HIGH"]
STATUS_MEANS = {"F": "Safe", "O": "Unsafe"}
PRIORITY_CODE = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "5-LOW": 4}


def orders_as_rows(spark, sf_dir):
    """Orders as the rows of a design: the key is a dense row id. Returns rows, size and cycles."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    n = orders.count()
    return orders, n, -(-n // SPEC.base_unit)


def orders_quotas(n):
    return {c: even_quota(v, n) for c, v in SPEC.quota_values.items()}


def labelled_orders(spark, sf_dir):
    """Every order with the complete set of balanced columns."""
    orders, n, cycles = orders_as_rows(spark, sf_dir)
    cells = S.grid_columns(SPEC, F.col("row_id"), cycles)
    rows = orders.select("row_id", *[c.alias(name) for name, c in cells.items()])
    return S.complete_grid(rows, SPEC, quotas=orders_quotas(n))


# ------------------------------------------------------------------ SQL fragments

_FLAT = [(g, i) for g, items in V.THEME_OBJECTS.items() for i in items]
_CELLS = [(e, s) for e, s, w in SPEC.sorted_template() for _ in range(w)]
_N = "(SELECT count(*) FROM orders)"
_CYC = f"(({_N} + 809) // 810)"
_ITEM = f"((o_orderkey // (15 * {_CYC})) % {len(_FLAT)} + 1)"
_CELL = f"((o_orderkey % (15 * {_CYC})) // {_CYC} + 1)"

GRID_SQL = f"""
SELECT o_orderkey AS row_id,
       ({sql_list([g for g, _ in _FLAT])})[{_ITEM}] AS theme,
       ({sql_list([i for _, i in _FLAT])})[{_ITEM}] AS object_detected,
       ({sql_list([e for e, _ in _CELLS])})[{_CELL}] AS emotion,
       ({sql_list([s for _, s in _CELLS])})[{_CELL}] AS sentiment,
       CAST(o_orderkey % {_CYC} AS INTEGER) AS cycle
FROM orders"""


def quota_sql(column: str, values: list[str]) -> str:
    """(row_id, column) by a plain global row number."""
    k = len(values)
    return f"""
SELECT row_id, ({sql_list(values)})[CASE WHEN rk < ({_N} % {k}) * ({_N} // {k} + 1)
         THEN rk // ({_N} // {k} + 1)
         ELSE ({_N} % {k}) + (rk - ({_N} % {k}) * ({_N} // {k} + 1)) // ({_N} // {k}) END + 1] AS {column}
FROM (SELECT o_orderkey AS row_id,
             row_number() OVER (ORDER BY md5('42:{column}:' || o_orderkey), o_orderkey) - 1 AS rk
      FROM orders)"""


def weighted_sql(name: str, row_id: str, options: list[tuple[str, int]]) -> str:
    total = sum(w for _, w in options)
    u, upper, whens = sql_draw(name, row_id, total), 0, []
    for value, weight in options:
        upper += weight
        whens.append(f"WHEN {u} < {upper} THEN {sql_text(value)}")
    return f"(CASE {' '.join(whens)} END)"


_ACTIONS = [(a, 1) for a in V.CTA_ACTIONS]
_NEGATIVE = [(V.CTA_NONE, V.CTA_NEGATIVE_NONE_WEIGHT)] + [(a, V.CTA_NEGATIVE_ACTION_WEIGHT) for a in V.CTA_ACTIONS]
_ANY = [(V.CTA_NONE, 1), *_ACTIONS]


def cta_sql(condition: str, row_id: str) -> str:
    return (
        f"(CASE WHEN {condition} = 'Positive' THEN {weighted_sql('call_to_action', row_id, _ACTIONS)} "
        f"WHEN {condition} = 'Negative' THEN {weighted_sql('call_to_action', row_id, _NEGATIVE)} "
        f"ELSE {weighted_sql('call_to_action', row_id, _ANY)} END)"
    )


def money_sql(row_id: str) -> str:
    return f"({sql_list(V.MONETARY_OPTIONS)})[{sql_draw('monetary_mention', row_id, 22)} + 1]"


def labelled_sql() -> str:
    """The complete labelled table; ``row_id`` plus the fixed columns."""
    joins = " ".join(
        f"JOIN ({quota_sql(c, v)}) q_{c} USING (row_id)" for c, v in SPEC.quota_values.items()
    )
    trust = sql_case("sentiment", V.SENTIMENT_TO_TRUST)
    inner = f"""
SELECT row_id, printf('sample_%04d.jpg', row_id + 1) AS image_path, '' AS text, theme, sentiment, emotion,
       dominant_colour, attention_score, {trust} AS trust_safety, target_audience, predicted_ctr,
       likelihood_shares, '' AS keywords, {money_sql('row_id')} AS monetary_mention,
       {cta_sql('sentiment', 'row_id')} AS call_to_action, object_detected
FROM ({GRID_SQL}) g {joins}"""
    codes = ", ".join(f"{sql_case(c, m)}::INTEGER AS {c}_num" for c, m in SPEC.codes.items())
    return f"SELECT *, {codes} FROM ({inner})"


LABELLED_SQL = f"SELECT row_id, {', '.join(V.TABLE_COLUMNS)} FROM ({labelled_sql()})"


# ------------------------------------------------------------------ queries


@query("K1_weighted_expansion", """
SELECT s_suppkey, c.copy AS copy
FROM supplier, unnest(range(CASE WHEN s_suppkey % 50 = 7 THEN 1234 ELSE s_suppkey % 3 END)) AS c(copy)""")
def k1(spark, sf_dir):
    """A few suppliers weigh more than all others together; their copies are made in steps."""
    weight = F.when(F.col("s_suppkey") % 50 == 7, 1234).otherwise(F.col("s_suppkey") % 3)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    return S.expand_by_weight(suppliers, weight, "copy", step=100)


@query("K2_custom_order_rank", f"""
SELECT o_orderkey, CAST({sql_case('o_orderpriority', {v: i for i, v in enumerate(PRIORITY_ORDER)}, '99')} AS INTEGER) AS rank
FROM orders""")
def k2(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", S.list_rank("o_orderpriority", PRIORITY_ORDER).alias("rank"))


@query("K2_custom_order_sort", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def k2_sort(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return S.sort_by_lists(orders, {"o_orderpriority": PRIORITY_ORDER, "o_orderstatus": ["P", "O", "F"]})


def _rank_sql(column: str, order: list[str]) -> str:
    return f"CASE {' '.join(f'WHEN {column} = {sql_text(v)} THEN {i}' for i, v in enumerate(order))} ELSE 99 END"


@query("K2_sorted_positions", f"""
SELECT o_orderpriority, o_orderstatus, n, row_number() OVER (
         ORDER BY {_rank_sql('o_orderpriority', PRIORITY_ORDER)}, {_rank_sql('o_orderstatus', ['P', 'O', 'F'])}) AS place
FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)""")
def k2_positions(spark, sf_dir):
    """Where the rows of each pair of values lie in the sorted table: their stretches must not overlap."""
    at = F.monotonically_increasing_id()
    ordered = k2_sort(spark, sf_dir).withColumn("at", at)
    runs = ordered.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    by_first = Window.orderBy("first")  # one row per pair of values
    apart = F.coalesce(F.lag("last").over(by_first) < F.col("first"), F.lit(True))
    place = F.when(apart, F.row_number().over(by_first).cast("long"))
    return runs.select("o_orderpriority", "o_orderstatus", "n", place.alias("place"))


@query("K3_hierarchical_grid", GRID_SQL)
def k3(spark, sf_dir):
    orders, _, cycles = orders_as_rows(spark, sf_dir)
    cells = S.grid_columns(SPEC, F.col("row_id"), cycles)
    return orders.select("row_id", *[c.alias(n) for n, c in cells.items()])


@query("K3_hierarchy_from_table", f"""
SELECT s_nationkey AS theme, s_suppkey AS object_detected, s_suppkey * 30 + k AS row_id,
       ({sql_list([e for e, _ in _CELLS])})[k // 2 + 1] AS emotion,
       ({sql_list([s for _, s in _CELLS])})[k // 2 + 1] AS sentiment, CAST(k % 2 AS INTEGER) AS cycle
FROM supplier, unnest(range(30)) AS u(k)""")
def k3_table(spark, sf_dir):
    items = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("theme"), F.col("s_suppkey").alias("object_detected")
    )
    return S.expand_hierarchy(items, "object_detected", SPEC, cycles=2)


@query("K4_row_ids", """
SELECT o_orderkey AS row_id, printf('sample_%04d.jpg', o_orderkey + 1) AS image_path FROM orders""")
def k4(spark, sf_dir):
    orders, _, _ = orders_as_rows(spark, sf_dir)
    return orders.withColumn("image_path", S.id_string(F.col("row_id"), V.ID_PATTERN))


@query("K5_exact_quota", quota_sql("dominant_colour", V.COLOURS))
def k5(spark, sf_dir):
    orders, n, _ = orders_as_rows(spark, sf_dir)
    return Q.assign_quotas(orders, "row_id", {"dominant_colour": even_quota(V.COLOURS, n)})


@query("K5_global_rank", """
SELECT l_orderkey, l_linenumber, c AS copies, rk AS rank FROM (
  SELECT o_orderkey AS l_orderkey, CAST(o_orderkey % 7 AS INTEGER) AS l_linenumber, 1 AS c,
         row_number() OVER (ORDER BY md5('42:rank:' || o_orderkey), o_orderkey) - 1 AS rk FROM orders)""")
def k5_rank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        (F.col("o_orderkey") % 7).cast("int").alias("l_linenumber"),
        F.lit(1).alias("copies"),
    )
    return Q.hash_rank(orders, "l_orderkey", "rank")


_LINE_ID = "l_orderkey * 10 + l_linenumber"


@query("K5_K8_quota_of_many_values", f"""
WITH n AS (SELECT (SELECT count(*) FROM lineitem) // count(*) AS base, (SELECT count(*) FROM lineitem) % count(*) AS more FROM part),
ranked AS (SELECT {_LINE_ID} AS row_id, row_number() OVER (ORDER BY md5('42:part:' || ({_LINE_ID})), {_LINE_ID}) - 1 AS rk FROM lineitem),
placed AS (SELECT row_id, CASE WHEN rk < more * (base + 1) THEN rk // (base + 1) ELSE more + (rk - more * (base + 1)) // base END AS place
           FROM ranked, n)
SELECT row_id, p_partkey AS part FROM placed JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part) USING (place)""")
def k5_many(spark, sf_dir):
    """Every line goes to a part: as many values as there are parts, each with its exact count."""
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("value"))
    n, v = lines.agg(F.count("*")).scalar(), parts.agg(F.count("*")).scalar()
    more = (F.col("value") < F.pmod(n, v)).cast("long")  # keys are dense from 0
    quota = parts.select(F.col("value").alias("position"), "value", (F.call_function("div", n, v) + more).alias("count"))
    return Q.assign_quota_table(lines, "row_id", quota, "part")


@query("K6_equal_thirds", f"""
SELECT row_id, attention_score, predicted_ctr, likelihood_shares
FROM ({quota_sql('attention_score', V.LEVELS)}) a
JOIN ({quota_sql('predicted_ctr', V.LEVELS)}) b USING (row_id)
JOIN ({quota_sql('likelihood_shares', V.LEVELS)}) c USING (row_id)""")
def k6(spark, sf_dir):
    orders, n, _ = orders_as_rows(spark, sf_dir)
    thirds = even_quota(V.LEVELS, n)
    columns = ["attention_score", "predicted_ctr", "likelihood_shares"]
    return Q.assign_quotas(orders, "row_id", {c: thirds for c in columns})


@query("K7_equal_audiences", quota_sql("target_audience", V.AUDIENCES))
def k7(spark, sf_dir):
    orders, n, _ = orders_as_rows(spark, sf_dir)
    return Q.assign_quotas(orders, "row_id", {"target_audience": even_quota(V.AUDIENCES, n)})


@query("K8_quota_allocation", f"""
SELECT o_custkey, n AS total, ({sql_list(V.COLOURS)})[r + 1] AS value,
       n // 8 + CASE WHEN r < n % 8 THEN 1 ELSE 0 END AS quota
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), unnest(range(8)) AS u(r)""")
def k8(spark, sf_dir):
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"))
    return Q.allocate(totals, "total", V.COLOURS)


@query("K9_implied_column", f"""
SELECT o_orderkey, o_orderstatus, {sql_case('o_orderstatus', STATUS_MEANS)} AS trust_safety FROM orders""")
def k9(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return orders.withColumn("trust_safety", S.lookup("o_orderstatus", STATUS_MEANS))


_TONE_OF_STATUS = {"F": "Positive", "O": "Negative", "P": "Neutral"}


@query("K10_conditional_draw", f"""
SELECT o_orderkey, {cta_sql(sql_case('o_orderstatus', _TONE_OF_STATUS), 'o_orderkey')} AS call_to_action
FROM orders""")
def k10(spark, sf_dir):
    tone = S.lookup("o_orderstatus", _TONE_OF_STATUS)
    cases, rest = SPEC.tone_draws["call_to_action"]
    drawn = conditional_choice(42, "call_to_action", F.col("o_orderkey"), tone, cases, rest)
    return table(spark, sf_dir, "orders").select("o_orderkey", drawn.alias("call_to_action"))


@query("K11_uniform_draw", f"SELECT o_orderkey, {money_sql('o_orderkey')} AS monetary_mention FROM orders")
def k11(spark, sf_dir):
    drawn = uniform_choice(42, "monetary_mention", F.col("o_orderkey"), V.MONETARY_OPTIONS)
    return table(spark, sf_dir, "orders").select("o_orderkey", drawn.alias("monetary_mention"))


@query("K12_blank_columns", "SELECT c_custkey, '' AS text, '' AS keywords FROM customer")
def k12(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return customers.withColumns({c: F.lit("") for c in SPEC.blank_columns})


@query("K13_encoding", f"""
SELECT o_orderkey, o_orderpriority, CAST({sql_case('o_orderpriority', PRIORITY_CODE)} AS INTEGER) AS o_orderpriority_num
FROM orders""")
def k13(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return S.encode(orders, {"o_orderpriority": PRIORITY_CODE})


@query("K14_projection", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def k14(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").drop("c_acctbal")
    return S.in_order(customers, ["c_mktsegment", "c_custkey", "c_name"])


@query("K15_labelled_table", LABELLED_SQL)
def k15(spark, sf_dir):
    return labelled_orders(spark, sf_dir)


@query("K16_expected_counts", """
WITH t AS (SELECT s_nationkey, s_suppkey % 11 AS bin, s_suppkey % 4 AS w FROM supplier)
SELECT 's_nationkey' AS "column", CAST(s_nationkey AS VARCHAR) AS value, CAST(sum(w) * 3 AS BIGINT) AS expected
FROM t GROUP BY s_nationkey
UNION ALL
SELECT 'bin', CAST(bin AS VARCHAR), CAST(sum(w) * 3 AS BIGINT) FROM t GROUP BY bin""")
def k16(spark, sf_dir):
    template = table(spark, sf_dir, "supplier").select(
        "s_nationkey", (F.col("s_suppkey") % 11).alias("bin"), (F.col("s_suppkey") % 4).alias("w")
    )
    return Q.expected_from_template(template, ["s_nationkey", "bin"], "w", cycles=3)


@query("K17_spec_rules", """
WITH sizes AS (SELECT c_nationkey, count(DISTINCT c_custkey) AS n FROM customer GROUP BY c_nationkey)
SELECT 'equal_items_per_group' AS rule, c_nationkey || ': ' || n AS detail FROM sizes
WHERE n <> (SELECT arg_min(n, c_nationkey) FROM sizes)
UNION ALL
SELECT 'total_divisible_by_base_unit', n || ' % 810' FROM (SELECT count(*) AS n FROM orders) WHERE n % 810 <> 0""")
def k17(spark, sf_dir):
    unequal = Q.hierarchy_problems(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey")
    uneven = spec_problems(spark, SPEC, table(spark, sf_dir, "orders").count())
    return unequal.unionByName(uneven)
