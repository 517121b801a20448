"""V: validation checks over the given tables and over the labelled orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.catalog import balance as B
from evenweave.catalog.registry import query, sql_case, sql_list, sql_strip, sql_text, table
from evenweave.example import ad_spec
from evenweave.operators import checks as C
from evenweave.operators.cells import CellStore
from evenweave.operators.skeleton import list_rank
from evenweave.session import materialize, new_run_dir

_OUT = '"check", "key", expected, actual'


def _row(check: str, key: str, expected: str, actual: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", {key} AS \"key\", CAST({expected} AS BIGINT) AS expected, "
        f"CAST({actual} AS BIGINT) AS actual"
    )


# ------------------------------------------------------------------ single checks

DOCUMENT_COLUMNS = ["doc_id", "text", "theme", "lang", "emotion"]


@query("V1_V2_shape", f"""
{_row('V1', "'theme'", '1', '0')} UNION ALL {_row('V1', "'emotion'", '1', '0')} UNION ALL
SELECT * FROM ({_row('V2', "'rows'", '12345', 'count(*)')} FROM documents) WHERE expected <> actual""")
def v1_v2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return C.missing_columns(docs, DOCUMENT_COLUMNS).unionByName(C.row_count(docs, 12345))


STATUS_EXPECTED = [("F", 5000), ("O", 4979), ("X", 10)]


def _status_expected(spark):
    return spark.createDataFrame(STATUS_EXPECTED, "value string, expected long")


_STATUS_VALUES = "(VALUES " + ", ".join(f"({sql_text(v)}, {n})" for v, n in STATUS_EXPECTED) + ") e(value, expected)"
_STATUS_COUNTS = "(SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1) a"


@query("V3_marginal_lenient", f"""
SELECT * FROM ({_row('V3', "'o_orderstatus=' || e.value", 'e.expected', 'coalesce(n, 0)')}
FROM {_STATUS_VALUES} LEFT JOIN {_STATUS_COUNTS} USING (value)) WHERE expected <> actual""")
def v3(spark, sf_dir):
    return C.marginal(table(spark, sf_dir, "orders"), "o_orderstatus", _status_expected(spark), strict=False)


@query("V4_marginal_strict", f"""
SELECT * FROM ({_row('V4', "'o_orderstatus=' || value", 'coalesce(expected, 0)', 'coalesce(n, 0)')}
FROM {_STATUS_VALUES} FULL JOIN {_STATUS_COUNTS} USING (value)) WHERE expected <> actual""")
def v4(spark, sf_dir):
    return C.marginal(table(spark, sf_dir, "orders"), "o_orderstatus", _status_expected(spark), strict=True)


STATUS_PRIORITY = {"F": "1-URGENT", "O": "5-LOW"}


@query("V5_implied_value", _row(
    "V5", "'o_orderstatus->o_orderpriority'", "0",
    f"count(*) FILTER (NOT coalesce({sql_case('o_orderstatus', STATUS_PRIORITY)} = o_orderpriority, false))",
) + " FROM orders")
def v5(spark, sf_dir):
    return C.implied_value(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", STATUS_PRIORITY)


@query("V6_forbidden_pairs", _row(
    "V6", "'l_returnflagxl_linestatus'", "0",
    "count(*) FILTER ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))",
) + " FROM lineitem")
def v6(spark, sf_dir):
    pairs = [("A", "F"), ("N", "O")]
    return C.forbidden_pairs(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", pairs)


FLAGS, STATUSES, NUMBERS = ["A", "N", "R"], ["F", "O"], list(range(1, 9))


def _cells(spark, keys: list[str], expected: int) -> DataFrame:
    domain = {
        "l_returnflag": [(v,) for v in FLAGS],
        "l_linestatus": [(v,) for v in STATUSES],
        "l_linenumber": [(v,) for v in NUMBERS],
    }
    rows = reduce(lambda acc, k: [a + b for a in acc for b in domain[k]], keys, [()])
    types = ", ".join(f"{k} {'int' if k == 'l_linenumber' else 'string'}" for k in keys)
    return spark.createDataFrame([(*r, expected) for r in rows], f"{types}, expected long")


def _cells_sql(check: str, keys: list[str], expected: int) -> str:
    domain = {
        "l_returnflag": sql_list(FLAGS),
        "l_linestatus": sql_list(STATUSES),
        "l_linenumber": str(NUMBERS),
    }
    grid = ", ".join(f"unnest({domain[k]}) AS g{i}({k})" for i, k in enumerate(keys))
    names = ", ".join(keys)
    key = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (
        f"SELECT * FROM ({_row(check, key, str(expected), 'coalesce(n, 0)')} FROM (SELECT {names} FROM {grid}) g "
        f"LEFT JOIN (SELECT {names}, count(*) AS n FROM lineitem GROUP BY {names}) a USING ({names})) "
        "WHERE expected <> actual"
    )


CELL_CHECKS = {
    "V7_group_totals": ("V7", ["l_returnflag"], 20000),
    "V8_group_marginals": ("V8", ["l_returnflag", "l_linestatus"], 10025),
    "V9_group_joint": ("V9", ["l_returnflag", "l_linestatus", "l_linenumber"], 1400),
    "V10_contingency_two_way": ("V10", ["l_linestatus", "l_linenumber"], 4200),
    "V11_contingency_two_way": ("V11", ["l_returnflag", "l_linenumber"], 2900),
}


def _cell_query(check, keys, expected):
    def run(spark, sf_dir):
        return C.cell_counts(table(spark, sf_dir, "lineitem"), check, keys, _cells(spark, keys, expected))

    return run


for _name, _args in CELL_CHECKS.items():
    query(_name, _cells_sql(*_args))(_cell_query(*_args))


EVENT_ORDER = ["view", "signup", "purchase", "click"]
_EVENT_RANK = sql_case("event_type", {v: i for i, v in enumerate(EVENT_ORDER)}, "99")


@query("V12_grouping_order", f"""
{_row('V12', 'event_type', 'NULL', 'event_id')}
FROM (SELECT event_id, event_type, {_EVENT_RANK} AS r, lag({_EVENT_RANK}) OVER (ORDER BY event_id) AS p FROM events)
WHERE r < p ORDER BY event_id LIMIT 1""")
def v12(spark, sf_dir):
    rank = list_rank("event_type", EVENT_ORDER).alias("r")
    events = table(spark, sf_dir, "events")
    return C.grouping_order(events, "event_id", [rank], ["event_type"])


@query("V12_grouping_order_many_keys", f"""
{_row('V12', 'CAST(user_id AS VARCHAR)', 'NULL', 'event_id')}
FROM (SELECT event_id, user_id, lag(k) OVER (ORDER BY event_id) AS p, k FROM
      (SELECT event_id, user_id, CASE WHEN event_id < 3000 THEN event_id ELSE user_id END AS k FROM events))
WHERE k < p ORDER BY event_id LIMIT 1""")
def v12_many(spark, sf_dir):
    """The number of keys grows with the table."""
    rank = F.when(F.col("event_id") < 3000, F.col("event_id")).otherwise(F.col("user_id")).alias("r")
    events = table(spark, sf_dir, "events")
    return C.grouping_order(events, "event_id", [rank], ["user_id"])


@query("V12_grouping_order_kept", "SELECT * FROM (" + _row("V12", "''", "NULL", "0") + ") WHERE false")
def v12_kept(spark, sf_dir):
    """Orders by key in steps of a thousand: ascending, hence no violation."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.call_function("div", "o_orderkey", F.lit(1000)).alias("block")
    )
    return C.grouping_order(orders, "o_orderkey", [F.col("block").alias("r")], ["block"])


@query("V12_grouping_order_one_late_row", _row("V12", "'-1'", "NULL", "max(o_orderkey)") + " FROM orders")
def v12_late(spark, sf_dir):
    """The same blocks, but the last order comes with the lowest key."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).scalar()
    block = F.when(F.col("o_orderkey") == last, -1).otherwise(F.call_function("div", "o_orderkey", F.lit(1000)))
    named = orders.select("o_orderkey", block.cast("long").alias("block"))
    return C.grouping_order(named, "o_orderkey", [F.col("block").alias("r")], ["block"])


SEGMENT_CODE = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
PRIORITY_DIGIT = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@query("V13_code_mapping", f"""
SELECT * FROM ({_row('V13', "'c_mktsegment'", '0',
    f"count(*) FILTER (NOT coalesce({sql_case('c_mktsegment', SEGMENT_CODE)} = c_custkey % 5, false))")} FROM customer)
WHERE actual > 0""")
def v13(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment_num", (F.col("c_custkey") % 5).cast("int")
    )
    return C.code_mapping(customers, {"c_mktsegment": SEGMENT_CODE})


@query("V13_code_mapping_kept", "SELECT * FROM (" + _row("V13", "''", "0", "1") + ") WHERE false")
def v13_kept(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority_num", F.substring("o_orderpriority", 1, 1).cast("int")
    )
    return C.code_mapping(orders, {"o_orderpriority": PRIORITY_DIGIT})


@query("V13_code_mapping_one_wrong", "SELECT * FROM (" + _row("V13", "'o_orderpriority'", "0", "1") + ")")
def v13_wrong(spark, sf_dir):
    """The same codes, but for the last order, whose code is null."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).scalar()
    code = F.when(F.col("o_orderkey") != last, F.substring("o_orderpriority", 1, 1).cast("int"))
    return C.code_mapping(orders.withColumn("o_orderpriority_num", code), {"o_orderpriority": PRIORITY_DIGIT})


_LEN = f"length({sql_strip('coalesce(text, {q})'.replace('{q}', chr(39) * 2))})"


@query("V14_duplicate_texts", f"""
SELECT * FROM ({_row('V14', "'text'", '0', 'count(*)')}
FROM (SELECT text FROM documents WHERE {_LEN} > 5 GROUP BY text HAVING count(*) > 1)) WHERE actual > 0""")
def v14(spark, sf_dir):
    return C.duplicate_texts(table(spark, sf_dir, "documents"), "text")


_BANNED = " OR ".join(f"contains(lower(text), {sql_text(t)})" for t in V.BANNED_TERMS)


def _text_rules_sql(source: str) -> str:
    return f"""
SELECT * FROM ({_row('V15', "'text'", '0', f'count(*) FILTER ({_LEN} < 5)')} FROM {source}) WHERE actual > 0
UNION ALL
SELECT * FROM ({_row('V16', "'text'", '0', f'count(*) FILTER ({_BANNED})')} FROM {source}) WHERE actual > 0"""


@query("V15_V16_text_rules", _text_rules_sql("documents"))
def v15_v16(spark, sf_dir):
    return C.text_rules(table(spark, sf_dir, "documents"), "text", V.BANNED_TERMS)


# Terms from names of parts, customers and suppliers, as many as these tables give, and beginnings of words of the texts.
_TERMS_SQL = """
SELECT lower(p_name) AS term FROM part UNION SELECT lower(c_name) FROM customer UNION SELECT lower(s_name) FROM supplier
UNION SELECT lower(substr(text, 10, 9)) FROM documents WHERE doc_id % 7 = 0 AND length(text) > 20 UNION SELECT ''"""


@query("V16_many_terms", f"""
WITH terms AS (SELECT DISTINCT term FROM ({_TERMS_SQL}) WHERE term <> '')
SELECT 'V16' AS "check", 'text' AS key, CAST(0 AS BIGINT) AS expected, count(*) AS actual FROM documents
WHERE EXISTS (SELECT 1 FROM terms WHERE contains(lower(text), term)) HAVING count(*) > 0""")
def v16_many(spark, sf_dir):
    """Names of all parts, customers and suppliers, and pieces of texts, as banned terms."""
    docs = table(spark, sf_dir, "documents")
    names = [table(spark, sf_dir, t).select(F.col(c).alias("term")) for t, c in (
        ("part", "p_name"), ("customer", "c_name"), ("supplier", "s_name"))]
    pieces = docs.where("doc_id % 7 = 0 AND length(text) > 20").select(F.substring("text", 10, 9).alias("term"))
    terms = names[0].union(names[1]).union(names[2]).union(pieces)
    return C.text_rules(docs, "text", terms).where(F.col("check") == "V16")


@query("V14_V15_V16_text_checks", f"""
SELECT * FROM ({_row('V14', "'text'", '0', 'count(*)')}
FROM (SELECT text FROM documents WHERE {_LEN} > 5 GROUP BY text HAVING count(*) > 1)) WHERE actual > 0
UNION ALL {_text_rules_sql('documents')}""")
def v14_v16(spark, sf_dir):
    return C.text_checks(table(spark, sf_dir, "documents"), "text", V.BANNED_TERMS)


@query("V17_fill_rate", f"""
SELECT 'text' AS "column", count(*) FILTER ({_LEN} >= 200) AS filled, count(*) AS total FROM documents UNION ALL
SELECT 'lang', count(*) FILTER (length(trim(lang)) >= 1), count(*) FROM documents UNION ALL
SELECT 'nope', 0, count(*) FROM documents""")
def v17(spark, sf_dir):
    return C.fill_rate(table(spark, sf_dir, "documents"), {"text": 200, "lang": 1, "nope": 1})


# ------------------------------------------------------------------ composite checks


def damaged_orders(spark, sf_dir):
    """Labelled orders with a few wrong cells of every kind, and texts."""
    rid = F.col("row_id")
    kind = rid % 4
    text = (
        F.when(kind == 0, "")
        .when(kind == 1, "one text for all of them")
        .when(kind == 2, F.concat(F.lit("pineapple "), rid.cast("string")))
        .otherwise(F.concat(F.lit("plain text "), rid.cast("string")))
    )
    return B.labelled_orders(spark, sf_dir).withColumns(
        {
            "text": text,
            "trust_safety": F.when(rid % 97 == 3, "Safe").otherwise(F.col("trust_safety")),
            "sentiment": F.when(rid % 499 == 4, "Negative").otherwise(F.col("sentiment")),
            "dominant_colour": F.when(rid % 701 == 5, "Pink").otherwise(F.col("dominant_colour")),
            "theme_num": F.when(rid % 907 == 6, 99).otherwise(F.col("theme_num")),
        }
    )


DAMAGED_SQL = f"""
SELECT * REPLACE (
  CASE row_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'one text for all of them'
       WHEN 2 THEN 'pineapple ' || row_id ELSE 'plain text ' || row_id END AS text,
  CASE WHEN row_id % 97 = 3 THEN 'Safe' ELSE trust_safety END AS trust_safety,
  CASE WHEN row_id % 499 = 4 THEN 'Negative' ELSE sentiment END AS sentiment,
  CASE WHEN row_id % 701 = 5 THEN 'Pink' ELSE dominant_colour END AS dominant_colour,
  CASE WHEN row_id % 907 = 6 THEN 99 ELSE theme_num END AS theme_num)
FROM ({B.LABELLED_SQL})"""

_SPEC = B.SPEC


def _composite_sql(check4: str, strict: bool, parts: list[str]) -> str:
    """The count checks as plain joins against expectations spelled out from the spec's values."""
    items = ", ".join(
        f"({g_no}, {sql_text(g)}, {i_no}, {sql_text(i)})"
        for g_no, (g, names) in enumerate(V.THEME_OBJECTS.items())
        for i_no, i in enumerate(names)
    )
    cells = ", ".join(f"({sql_text(e)}, {sql_text(s)}, {w})" for e, s, w in V.OBJECT_TEMPLATE)
    cyc = "(SELECT c FROM cyc)"
    n = "(SELECT count(*) FROM orders)"
    expected4 = [
        ("theme", f"SELECT g AS v, count(*) * 15 * {cyc} AS x FROM items GROUP BY g"),
        ("object_detected", f"SELECT i AS v, 15 * {cyc} AS x FROM items"),
        ("sentiment", f"SELECT s AS v, sum(w) * 54 * {cyc} AS x FROM tmpl GROUP BY s"),
        ("emotion", f"SELECT e AS v, sum(w) * 54 * {cyc} AS x FROM tmpl GROUP BY e"),
        ("trust_safety", f"SELECT {sql_case('s', V.SENTIMENT_TO_TRUST)} AS v, sum(w) * 54 * {cyc} AS x FROM tmpl GROUP BY s"),
    ]
    for column, values in _SPEC.quota_values.items():
        k = len(values)
        expected4.append(
            (column, f"SELECT ({sql_list(values)})[r + 1] AS v, {n} // {k} + CASE WHEN r < {n} % {k} THEN 1 ELSE 0 END AS x "
                     f"FROM unnest(range({k})) u(r)")
        )
    how = "FULL" if strict else "LEFT"
    sql = {
        "V4": " UNION ALL ".join(
            f"SELECT * FROM ({_row(check4, repr(c + '=') + ' || v', 'coalesce(x, 0)', 'coalesce(m, 0)')} FROM ({x}) e "
            f"{how} JOIN (SELECT {c} AS v, count(*) AS m FROM t GROUP BY 1) a USING (v))"
            for c, x in expected4
        ),
        "V5": _row("V5", "'sentiment->trust_safety'", "0",
                   f"count(*) FILTER (NOT coalesce({sql_case('sentiment', V.SENTIMENT_TO_TRUST)} = trust_safety, false))")
        + " FROM t",
        "V6": _row("V6", "'emotionxsentiment'", "0", "count(*) FILTER (" + " OR ".join(
            f"(emotion = {sql_text(e)} AND sentiment = {sql_text(s)})" for e, s in V.FORBIDDEN_PAIRS) + ")") + " FROM t",
        "V7": _row("V7", "g || '/' || i", f"15 * {cyc}", "coalesce(m, 0)")
        + " FROM items LEFT JOIN per_item USING (g, i)",
        "V8": f"SELECT v8.* FROM ({_row('V8', 'g || {0} || i || {0} || s'.format(chr(39) + '/' + chr(39)), f'x * {cyc}', 'coalesce(m, 0)')}, g, i "
              "FROM (SELECT g, i, s, sum(w) AS x FROM items, tmpl GROUP BY g, i, s) e LEFT JOIN (SELECT theme AS g, object_detected AS i, "
              "sentiment AS s, count(*) AS m FROM t GROUP BY 1, 2, 3) a USING (g, i, s) UNION ALL "
              f"{_row('V8', 'g || {0} || i || {0} || e'.format(chr(39) + '/' + chr(39)), f'x * {cyc}', 'coalesce(m, 0)')}, g, i "
              "FROM (SELECT g, i, e, sum(w) AS x FROM items, tmpl GROUP BY g, i, e) e LEFT JOIN (SELECT theme AS g, object_detected AS i, "
              f"emotion AS e, count(*) AS m FROM t GROUP BY 1, 2, 3) a USING (g, i, e)) v8 JOIN per_item USING (g, i) WHERE m = 15 * {cyc}",
        "V9": _row("V9", "g || '/' || i || '/' || e || '/' || s", f"w * {cyc}", "coalesce(m, 0)")
        + ", g, i FROM items CROSS JOIN tmpl LEFT JOIN (SELECT theme AS g, object_detected AS i, emotion AS e, sentiment AS s, "
          "count(*) AS m FROM t GROUP BY 1, 2, 3, 4) a USING (g, i, e, s)",
        "V10": _row("V10", "g || '/' || s", f"x * {cyc}", "coalesce(m, 0)")
        + " FROM (SELECT g, s, sum(w) AS x FROM items, tmpl GROUP BY g, s) e LEFT JOIN (SELECT theme AS g, sentiment AS s, "
          "count(*) AS m FROM t GROUP BY 1, 2) a USING (g, s)",
        "V11": _row("V11", "g || '/' || e", f"x * {cyc}", "coalesce(m, 0)")
        + " FROM (SELECT g, e, sum(w) AS x FROM items, tmpl GROUP BY g, e) e LEFT JOIN (SELECT theme AS g, emotion AS e, "
          "count(*) AS m FROM t GROUP BY 1, 2) a USING (g, e)",
        "V14": _row("V14", "'text'", "0", "count(*)")
        + f" FROM (SELECT text FROM t WHERE {_LEN} > 5 GROUP BY text HAVING count(*) > 1)",
        "V15_16": _text_rules_sql("t"),
    }
    if strict:
        sql["V9"] = f"SELECT v9.* FROM ({sql['V9']}) v9 JOIN per_item USING (g, i) WHERE m = 15 * {cyc}"
        ranks = (
            f"{sql_case('theme', {g: k for k, g in enumerate(V.THEME_OBJECTS)}, '99')} * 1000000 + coalesce(i_no, 99) * 10000 + "
            f"{sql_case('emotion', {e: k for k, e in enumerate(V.EMOTION_ORDER)}, '99')} * 100 + "
            f"{sql_case('sentiment', {s: k for k, s in enumerate(V.SENTIMENT_ORDER)}, '99')}"
        )
        sql["V12"] = (
            f"SELECT * FROM ({_row('V12', 'theme || {0} || object_detected || {0} || emotion || {0} || sentiment'.format(chr(39) + '/' + chr(39)), 'NULL', 'row_id')} "
            f"FROM (SELECT *, lag(k) OVER (ORDER BY row_id) AS p FROM (SELECT t.*, {ranks} AS k FROM t LEFT JOIN items "
            "ON g = theme AND i = object_detected)) WHERE k < p ORDER BY row_id LIMIT 1)"
        )
        sql["V13"] = " UNION ALL ".join(
            _row("V13", sql_text(c), "0", f"count(*) FILTER (NOT coalesce({sql_case(c, m)} = {c}_num, false))") + " FROM t"
            for c, m in _SPEC.codes.items()
        )
    body = " UNION ALL ".join(f"SELECT {_OUT} FROM ({sql[p]})" for p in parts)
    return f"""
WITH t AS MATERIALIZED ({DAMAGED_SQL}),
cyc AS (SELECT (count(*) + 809) // 810 AS c FROM orders),
items(g_no, g, i_no, i) AS (VALUES {items}),
tmpl(e, s, w) AS (VALUES {cells}),
per_item AS (SELECT theme AS g, object_detected AS i, count(*) AS m FROM t GROUP BY 1, 2)
SELECT {_OUT} FROM ({body}) WHERE expected IS DISTINCT FROM actual"""


def _damaged_with_spec(spark, sf_dir):
    """The table to check lies in storage, as a finished table does."""
    n = table(spark, sf_dir, "orders").count()
    spec = ad_spec(cycles=-(-n // _SPEC.base_unit))
    return materialize(damaged_orders(spark, sf_dir), new_run_dir(spark) + "/labelled"), spec, n


@query("V18_verify_skeleton", _composite_sql("V4", True, ["V4", "V5", "V6", "V7", "V8", "V9", "V10", "V11", "V12", "V13"]))
def v18(spark, sf_dir):
    df, spec, n = _damaged_with_spec(spark, sf_dir)
    return C.verify_skeleton(df, spec, total_rows=n, quotas=B.orders_quotas(n))


@query("V4_V13_checks_of_three_waves", _composite_sql("V4", True, ["V4", "V5", "V6", "V7", "V8", "V9", "V10", "V11", "V13"]))
def v_waves(spark, sf_dir):
    """Counts kept over three waves and a correction: the first wave comes undamaged in part and is put right later."""
    df, spec, n = _damaged_with_spec(spark, sf_dir)
    store = CellStore(spark, new_run_dir(spark) + "/cells", spec)
    waves = [df.where(F.col("row_id") % 3 == k) for k in range(3)]
    early = waves[0].withColumn("emotion", F.when(F.col("row_id") % 2 == 0, F.lit("Joy")).otherwise(F.col("emotion")))
    store.add(early)
    store.add(waves[1])
    store.change(early, waves[0])
    store.add(waves[2])
    return store.compact().violations(n, B.orders_quotas(n))


@query("V19_validate_dataset", _composite_sql("V3", False, ["V4", "V5", "V6", "V9", "V10", "V11", "V14", "V15_16"]))
def v19(spark, sf_dir):
    df, spec, n = _damaged_with_spec(spark, sf_dir)
    return C.validate_dataset(df, spec, V.BANNED_TERMS, total_rows=n, quotas=B.orders_quotas(n))
