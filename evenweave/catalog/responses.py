"""X and C: records out of damaged responses made from the events, texts out of conversation chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenweave.catalog.registry import SQL_WS, query, sql_list, sql_strip, table
from evenweave.functions.text import clean_text
from evenweave.operators import extract as X
from evenweave.streaming import chunks as K

KEYS = ["text", "keywords"]


def damaged_responses(spark, sf_dir):
    """Ten events per response as a JSON array, damaged in one of six ways by batch number:
    intact, with talk around it, with stray comma and quotes, without brackets, without closing braces,
    replaced by prose."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    batch = F.call_function("div", "event_id", F.lit(10))
    kind = batch % 6
    text = F.concat(
        F.when(kind == 2, F.lit('say "hi" ')).otherwise(F.lit("")), F.col("event_type"), F.lit(" by user "),
        F.col("user_id").cast("string"),
    )
    item = F.concat(
        F.lit('{"id":'), (F.col("event_id") % 10 + 1).cast("string"), F.lit(',"text":"'), text,
        F.lit('","keywords":"'), F.col("event_type"), F.lit('"'),
        F.when(kind == 4, F.lit("")).otherwise(F.lit("}")),
    )
    grouped = events.groupBy(batch.alias("batch_id")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", item.alias("item")))).alias("items")
    )
    kind = F.col("batch_id") % 6
    items = F.transform("items", lambda i: i["item"])
    commas, spaces = F.array_join(items, ","), F.array_join(items, " ")
    raw = (
        F.when(kind == 0, F.concat(F.lit("["), commas, F.lit("]")))
        .when(kind == 1, F.concat(F.lit("Sure! ["), commas, F.lit("] done")))
        .when(kind == 2, F.concat(F.lit("["), commas, F.lit(",]")))
        .when(kind == 5, F.lit("no json here"))
        .otherwise(spaces)
    )
    return grouped.select("batch_id", raw.alias("raw"))


def _found_sql(kinds: str, cut: bool = False) -> str:
    """Per response the items a strategy recovers, with their values."""
    quoted = "'say'" if cut else "'say ''hi'' ' || event_type || ' by user ' || user_id"
    text = f"CASE WHEN (event_id // 10) % 6 = 2 THEN {quoted} ELSE event_type || ' by user ' || user_id END"
    return f"""
SELECT event_id // 10 AS batch_id, CAST(CASE WHEN (event_id // 10) % 6 IN ({kinds}) THEN count(*) ELSE 0 END AS INTEGER) AS n,
  CASE WHEN (event_id // 10) % 6 IN ({kinds})
    THEN string_agg((event_id % 10 + 1) || '|' || {text} || '|' || event_type, ';' ORDER BY event_id) ELSE '' END AS items
FROM events GROUP BY event_id // 10"""


def _strategy_query(build):
    def run(spark, sf_dir):
        found = damaged_responses(spark, sf_dir).withColumn("found", build(F.col("raw"), "text", KEYS))
        one = lambda i: F.concat_ws("|", *(F.try_element_at(i, F.lit(k)) for k in ("id", *KEYS)))
        return found.select(
            "batch_id", F.coalesce(F.size("found"), F.lit(0)).alias("n"),
            F.coalesce(F.array_join(F.transform("found", one), ";"), F.lit("")).alias("items"))

    return run


for _name, _build, _kinds, _cut in [
    ("X1_direct_items", X.items_direct, "0", False),
    ("X2_clean_items", X.items_clean, "0, 1", False),
    ("X3_fixed_items", X.items_fix, "0, 1, 2", False),
    ("X4_line_items", X.items_line, "0, 1, 2, 3", False),
    ("X5_regex_items", X.items_regex, "0, 1, 2, 3, 4", True),
]:
    query(_name, _found_sql(_kinds, _cut))(_strategy_query(_build))

_STRATEGY = f"({sql_list(X.STRATEGIES)})[(event_id // 10) % 6 + 1]"


@query("X6_cascade", f"""
SELECT event_id // 10 AS batch_id, {_STRATEGY} AS strategy, CAST(event_id % 10 AS INTEGER) AS pos,
       CAST(event_id % 10 + 1 AS VARCHAR) AS id,
       CASE WHEN (event_id // 10) % 6 = 2 THEN 'say ''hi'' ' ELSE '' END || event_type || ' by user ' || user_id AS text,
       event_type AS keywords
FROM events WHERE (event_id // 10) % 6 < 5""")
def x6(spark, sf_dir):
    found = X.explode_items(X.extract_items(damaged_responses(spark, sf_dir), "text", KEYS), "batch_id")
    values = [F.element_at("values", k).alias(k) for k in ("id", "text", "keywords")]
    return found.select("batch_id", "strategy", "pos", *values)


@query("X6_strategy_report", f"""
SELECT coalesce({_STRATEGY}, 'none') AS strategy, count(DISTINCT event_id // 10) AS responses,
       CAST(count(*) FILTER ((event_id // 10) % 6 < 5) AS BIGINT) AS items FROM events GROUP BY 1""")
def x6_report(spark, sf_dir):
    return X.strategy_report(X.extract_items(damaged_responses(spark, sf_dir), "text", KEYS))


@query("X7_single_objects", """
SELECT event_id, event_type || CASE event_id % 4 WHEN 0 THEN ' -' WHEN 2 THEN ' -' ELSE ':' END || ' user ' || user_id AS text,
       CASE event_id % 4 WHEN 1 THEN '' ELSE event_type END AS keywords FROM events""")
def x7(spark, sf_dir):
    said = F.concat(F.col("event_type"), F.lit(": user "), F.col("user_id").cast("string"))
    kind = F.col("event_id") % 4
    both = F.concat(F.lit('{"text":"'), said, F.lit('","keywords":"'), F.col("event_type"), F.lit('"'))
    raw = (
        F.when(kind == 0, F.concat(both, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('```json\n{"text": "'), said, F.lit('"}\n```')))
        .when(kind == 2, F.concat(F.lit("ok "), both, F.lit(",} bye")))
        .otherwise(F.concat(both, F.lit(", cut")))
    )
    found = X.extract_single(F.col("raw"), KEYS)
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", found.alias("v")).select(
        "event_id", *[F.element_at("v", k).alias(k) for k in KEYS]
    )


@query("X8_colons_in_values", """
SELECT event_id, '{"t":"x -' || event_type || ' -' || user_id || '","u": "p:q", "v":"\\" -"}' AS fixed FROM events""")
def x8(spark, sf_dir):
    text = F.concat(
        F.lit('{"t":"x:'), F.col("event_type"), F.lit(":"), F.col("user_id").cast("string"),
        F.lit('","u": "p:q", "v":"\\":"}'),
    )
    return table(spark, sf_dir, "events").select("event_id", X.fix_colons(text).alias("fixed"))


_CLEAN = sql_strip("""'  "' || text || '\\n it\\''s \\"' || chr(10) || text || '"  '""")
_CLEAN = f"trim(trim({_CLEAN}, '\"'), '''')"
_CLEAN = f"replace(replace(replace(replace({_CLEAN}, '\\\"', '\"'), '\\''', ''''), '\\n', ' '), '\\t', ' ')"
_CLEAN = sql_strip(f"regexp_replace({_CLEAN}, '[{SQL_WS}]+', ' ', 'g')")


@query("X9_clean_text", f"SELECT doc_id, md5(c) AS digest, length(c) AS chars FROM (SELECT doc_id, {_CLEAN} AS c FROM documents)")
def x9(spark, sf_dir):
    raw = F.concat(
        F.lit('  "'), F.col("text"), F.lit("\\n it\\'s \\\""), F.lit("\n"), F.col("text"), F.lit('"  ')
    )
    cleaned = table(spark, sf_dir, "documents").select("doc_id", clean_text(raw).alias("c"))
    return cleaned.select(
        "doc_id", F.md5(F.col("c").cast("binary")).alias("digest"), F.length("c").cast("long").alias("chars")
    )


# ------------------------------------------------------------------ chunks

_ROLE_TYPE = {"user": "response.output_text.delta", "assistant": "response.reasoning_text.delta"}


def _agg(where: str) -> str:
    return f"coalesce(string_agg(text, '' ORDER BY turn) FILTER ({where}), '')"


def _assembled_sql(content: str, reasoning: str) -> str:
    return f"""
SELECT conv_id AS request_id, {_agg(content)} AS content, {_agg(reasoning)} AS reasoning,
       CAST(length({_agg(reasoning)}) AS INTEGER) AS reasoning_chars FROM conversations GROUP BY conv_id"""


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("request_id"), F.col("turn").alias("seq"), "role", "text"
    )


@query("C1_chat_deltas", _assembled_sql("role = 'user'", "role = 'assistant'"))
def c1(spark, sf_dir):
    """Turns as chat events; the assistant's carry reasoning, the system's no choices."""
    turns = _turns(spark, sf_dir)
    delta = F.struct(
        F.when(F.col("role") == "user", F.col("text")).alias("content"),
        F.when(F.col("role") == "assistant", F.col("text")).alias("reasoning_content"),
    )
    choices = F.when(F.col("role") != "system", F.array(F.struct(delta.alias("delta"))))
    line = F.concat(F.lit("data: "), F.to_json(F.struct(choices.alias("choices"))))
    decoded = K.decode_lines(turns.select("request_id", "seq", line.alias("line")))
    found = K.assemble(K.chat_deltas(decoded), segment_rows=3)
    # Requests whose events all lack choices have no chunk and come from the list of requests.
    return turns.select("request_id").distinct().join(found, "request_id", "left").na.fill(
        {"content": "", "reasoning": "", "reasoning_chars": 0}
    )


@query("C2_typed_events", _assembled_sql("role = 'user'", "role = 'assistant'"))
def c2(spark, sf_dir):
    kind = F.coalesce(
        F.when(F.col("role") == "user", _ROLE_TYPE["user"]), F.when(F.col("role") == "assistant", _ROLE_TYPE["assistant"]),
        F.lit("response.completed"),
    )
    typed = _turns(spark, sf_dir).withColumns({"channel": K.channel_of(kind, True), "delta": F.col("text")})
    return K.assemble(typed)


@query("C3_event_log", _assembled_sql("role = 'user' AND turn < 4", "role <> 'user' AND turn < 4"))
def c3(spark, sf_dir):
    """Event-log lines with blanks, broken lines and an end marker before the fifth turn."""
    turns = _turns(spark, sf_dir)
    kind = F.when(F.col("role") == "user", "a.output").otherwise("a.thinking")
    good = F.concat(F.lit("data: "), F.to_json(F.struct(kind.alias("type"), F.col("text").alias("delta"))))
    lines = F.array(F.lit("data: {broken"), F.lit(""), good)
    lines = F.when(F.col("seq") == 4, F.array(F.lit("data: [DONE]"), good)).otherwise(lines)
    log = turns.select("request_id", "seq", F.posexplode(lines).alias("i", "line"))
    log = log.select("request_id", (F.col("seq") * 3 + F.col("i")).alias("seq"), "line")
    return K.assemble(K.typed_deltas(K.decode_lines(log)), done="done")


@query("C4_complete_responses", """
SELECT conv_id, turn, CASE turn % 4 WHEN 3 THEN '' ELSE text END AS content FROM conversations""")
def c4(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    kind, other = F.col("turn") % 4, F.lit("not this")
    raw = (
        F.when(kind == 0, F.to_json(F.struct(F.col("text").alias("output_text"), other.alias("text"))))
        .when(kind == 1, F.to_json(F.struct(other.alias("text"), F.col("text").alias("output"))))
        .when(kind == 2, F.to_json(F.struct(F.col("text").alias("text"))))
        .otherwise(F.to_json(F.struct(other.alias("content"))))
    )
    return turns.select("conv_id", "turn", K.complete_content(raw, "plain").alias("content"))


@query("C4_typed_and_chat_responses", """
SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN 'plain words' ELSE text END AS typed,
       CASE WHEN turn % 3 = 1 THEN text END AS chat FROM conversations""")
def c4_kinds(spark, sf_dir):
    """A nested output, a chat choice, and a response that is no JSON, read by either client."""
    turns = table(spark, sf_dir, "conversations")
    text, kind = F.col("text"), F.col("turn") % 3
    message = F.struct(F.struct(text.alias("content")).alias("message"))
    raw = (
        F.when(kind == 0, F.to_json(F.struct(F.struct(text.alias("text")).alias("output"))))
        .when(kind == 1, F.to_json(F.struct(F.array(message).alias("choices"))))
        .otherwise(F.lit("plain words"))
    )
    return turns.select(
        "conv_id", "turn", K.complete_content(raw).alias("typed"), K.complete_content(raw, "chat").alias("chat"))


@query("C5_reasoning_volume", """
SELECT count(DISTINCT conv_id) AS requests, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS reasoning_chars
FROM conversations""")
def c5(spark, sf_dir):
    return K.reasoning_volume(c2(spark, sf_dir))
