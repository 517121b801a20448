"""Chunk events: decoding, channels, ordered assembly over segments, streaming follow."""

import json

from pyspark.sql import functions as F

from evenweave.streaming import chunks as K


def test_channels(spark):
    rows = [
        ("response.reasoning_text.delta", "reasoning", "reasoning"),
        ("response.output_text.delta", "content", "content"),
        ("response.thinking.delta", "reasoning", "reasoning"),
        ("response.output_text.done", "content", None),
        ("response.completed", None, None),
        ("Output.delta", "content", "content"),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "t string, raw string, typed string")
    for r in df.select("*", K.channel_of(F.col("t")).alias("a"), K.channel_of(F.col("t"), True).alias("b")).collect():
        assert (r.a, r.b) == (r.raw, r.typed), r.t


def log_lines():
    def ev(t, d):
        return "data: " + json.dumps({"type": t, "delta": d})

    lines = [
        ev("response.reasoning_text.delta", "think "),
        ev("response.output_text.delta", "Hel"),
        "",
        "data: {broken",
        ev("response.completed", "x"),
        ev("response.output_text.delta", "lo"),
        "data: [DONE]",
        ev("response.output_text.delta", " never"),
    ]
    return [(1, i, x) for i, x in enumerate(lines)] + [(2, 5, ev("a.output", "b")), (2, 3, ev("a.text", "a"))]


def test_typed_stream(spark):
    lines = spark.createDataFrame(log_lines(), "request_id long, seq long, line string")
    chunks = K.typed_deltas(K.decode_lines(lines))
    for segment_rows in (1000, 2, 1):
        out = K.assemble(chunks, done="done", segment_rows=segment_rows)
        got = {r.request_id: (r.content, r.reasoning, r.reasoning_chars) for r in out.collect()}
        assert got == {1: ("Hello", "think ", 6), 2: ("ab", "", 0)}
    assert K.reasoning_volume(out).first().asDict() == {"requests": 2, "reasoning_chars": 6}


def test_chat_stream(spark):
    def ev(**delta):
        return "data: " + json.dumps({"choices": [{"delta": delta}]})

    lines = [
        (1, 0, ev(reasoning_content="r1", content="")), (1, 1, ev(content="A")),
        (1, 2, 'data: {"usage": {"total_tokens": 5}}'), (1, 3, ev(reasoning="r2", content="B")),
        (1, 4, "data: [DONE]"), (1, 5, ev(content="C")),
    ]
    df = spark.createDataFrame(lines, "request_id long, seq long, line string")
    on = K.assemble(K.chat_deltas(K.decode_lines(df), thinking=True), done="done").first()
    off = K.assemble(K.chat_deltas(K.decode_lines(df), thinking=False), done="done").first()
    assert (on.content, on.reasoning) == ("AB", "r1r2") and (off.content, off.reasoning) == ("AB", "")


def test_one_hot_request(spark):
    df = spark.range(30000).select(
        F.lit(1).alias("request_id"), (29999 - F.col("id")).alias("seq"), F.lit("content").alias("channel"),
        F.format_string("%05d", 29999 - F.col("id")).alias("delta"),
    )
    out = K.assemble(df).first().content
    assert out == "".join(f"{i:05d}" for i in range(30000))


def test_complete_content(spark):
    rows = [
        ('{"output_text":"a","text":"b"}', "a", "a"), ('{"output":"o"}', "o", "o"),
        ('{"output":{"text":"ot"}}', "ot", '{"text":"ot"}'), ('{"text":"t"}', "t", "t"),
        ('{"content":"c"}', "c", ""), ('{"choices":[{"message":{"content":"m"}}]}', "m", ""),
        ('{"z":1}', '{"z":1}', ""),
    ]
    df = spark.createDataFrame(rows, "raw string, typed string, plain string")
    for r in df.select(
        "*", K.complete_content(F.col("raw")).alias("a"), K.complete_content(F.col("raw"), "plain").alias("b")
    ).collect():
        assert (r.a, r.b) == (r.typed, r.plain), r.raw
    chat = df.select(K.complete_content(F.col("raw"), "chat").alias("c")).collect()
    assert [r.c for r in chat][5] == "m"


def test_follow_event_log(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    lines = spark.createDataFrame(log_lines(), "request_id long, seq long, line string")
    lines.where("request_id = 1").write.json(src)
    K.follow_event_log(spark, src, out, state).awaitTermination(120)
    lines.where("request_id = 2").write.mode("append").json(src)
    K.follow_event_log(spark, src, out, state).awaitTermination(120)
    got = K.assemble(spark.read.parquet(out), done="done").collect()
    assert {r.request_id: r.content for r in got} == {1: "Hello", 2: "ab"}
