"""Response text from ordered chunk events: decode, sort into channels, assemble per request.

Decoding and channel assignment are row-wise and work on streaming tables as well. Assembly runs in two
levels: a request is cut into segments of consecutive sequence numbers, the segments are put together
first, the requests from the segments. One request with very many chunks is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenweave.functions.columns import let, strict_json
from evenweave.functions.text import strip

SEGMENT_ROWS = 1000
REASONING_FIELDS = ["reasoning_content", "thinking_content", "reasoning"]


def _get(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def decode_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Event-log lines to ``done``, ``event`` (JSON value), dropping the ``data: `` prefix.

    Blank lines and lines that are no JSON are left out; the end marker stays as ``done``.
    """
    text = F.regexp_replace(F.col(line), r"^data: ", "")
    done = strip(text) == "[DONE]"
    out = lines.withColumn("done", F.coalesce(done, F.lit(False)))
    out = out.withColumn("event", F.when(~F.col("done"), strict_json(text)))
    return out.where(F.col("done") | F.col("event").isNotNull()).drop(line)


def channel_of(event_type: Column, deltas_only: bool = False) -> Column:
    """``reasoning``, ``content`` or null from the type of an event.

    ``deltas_only`` ignores types that do not contain "delta", as a typed client does; a raw line
    reader looks at every type.
    """
    lower = F.lower(event_type)
    channel = F.when(lower.rlike("reasoning|thinking"), "reasoning").when(
        lower.rlike("output|text"), "content"
    )
    return F.when(event_type.contains("delta"), channel) if deltas_only else channel


def typed_deltas(decoded: DataFrame, deltas_only: bool = False) -> DataFrame:
    """C2 on decoded lines: adds ``channel`` and ``delta``."""
    channel = channel_of(_get(F.col("event"), "$.type"), deltas_only)
    return decoded.withColumns({"channel": channel, "delta": _get(F.col("event"), "$.delta")}).drop("event")


def chat_deltas(decoded: DataFrame, thinking: bool = True) -> DataFrame:
    """C1 on decoded lines: content and, if ``thinking``, reasoning of ``choices[0].delta``.

    Events without choices drop out. An event can carry several parts; they become rows.
    """
    def part(channel: str, path: str) -> Column:
        return F.struct(F.lit(channel).alias("channel"), _get(F.col("event"), path).alias("delta"))

    parts = [part("reasoning", f"$.choices[0].delta.{f}") for f in REASONING_FIELDS] if thinking else []
    parts.append(part("content", "$.choices[0].delta.content"))
    marker = F.array(F.struct(F.lit(None).cast("string").alias("channel"), F.lit("").alias("delta")))
    present = F.filter(F.array(*parts), lambda p: F.length(p["delta"]) > 0)
    rows = F.when(F.col("done"), marker).otherwise(present)
    keep = [c for c in decoded.columns if c != "event"]
    return decoded.select(*keep, F.posexplode(rows).alias("part", "_p")).select(
        *keep, "part", "_p.channel", "_p.delta"
    )


def assemble(
    chunks: DataFrame,
    request: str = "request_id",
    seq: str = "seq",
    channel: str = "channel",
    delta: str = "delta",
    done: str | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Per request the content and reasoning text in sequence order, up to the end marker.

    Output ``(request, content, reasoning, reasoning_chars)``. Chunks without a channel are dropped,
    requests that only have such chunks come out with empty texts.
    """
    part = F.col("part") if "part" in chunks.columns else F.lit(0)
    is_done = F.col(done) if done else F.lit(False)
    entry = F.struct(
        F.col(seq).cast("long").alias("seq"),
        part.alias("part"),
        F.col(channel).alias("channel"),
        F.coalesce(F.col(delta), F.lit("")).alias("delta"),
    )
    segment = F.floor(F.col(seq) / F.lit(segment_rows))
    first_level = chunks.groupBy(F.col(request), segment.alias("segment")).agg(
        F.min(F.when(is_done, F.col(seq).cast("long"))).alias("done_at"),
        F.sort_array(F.collect_list(F.when(F.col(channel).isNotNull(), entry))).alias("parts"),
    )

    def text(name: str) -> Column:
        mine = F.filter(
            F.col("parts"),
            lambda p: (p["channel"] == name) & (F.col("done_at").isNull() | (p["seq"] < F.col("done_at"))),
        )
        return F.array_join(F.transform(mine, lambda p: p["delta"]), "")

    segments = first_level.select(
        request,
        F.struct("segment", text("content").alias("content"), text("reasoning").alias("reasoning")).alias("s"),
        F.when(F.col("done_at").isNotNull(), F.col("segment")).alias("done_segment"),
    )
    second_level = segments.groupBy(request).agg(
        F.sort_array(F.collect_list("s")).alias("parts"), F.min("done_segment").alias("last")
    )
    kept = F.filter(
        F.col("parts"), lambda s: F.col("last").isNull() | (s["segment"] <= F.col("last"))
    )
    out = second_level.select(
        request,
        F.array_join(F.transform(kept, lambda s: s["content"]), "").alias("content"),
        F.array_join(F.transform(kept, lambda s: s["reasoning"]), "").alias("reasoning"),
    )
    return out.withColumn("reasoning_chars", F.length("reasoning"))


def complete_content(raw: Column, kind: str = "typed") -> Column:
    """C4: text of a complete (not streamed) response: the first field that is present.

    typed  output_text, output, output.text, text, content, choices[0].text,
           choices[0].message.content, else the response itself
    plain  output_text, output, text, else blank
    chat   choices[0].message.content
    """
    if kind == "chat":
        return _get(strict_json(raw), "$.choices[0].message.content")
    if kind == "plain":
        fields = ["$.output_text", "$.output", "$.text"]
        return let(strict_json(raw), lambda v: F.coalesce(*[_get(v, p) for p in fields], F.lit("")))
    later = ["$.output.text", "$.text", "$.content", "$.choices[0].text", "$.choices[0].message.content"]

    def first_present(value: Column) -> Column:
        output = F.try_variant_get(value, "$.output", "variant")
        output_text = F.when(F.schema_of_variant(output) == "STRING", output.try_cast("string"))
        return F.coalesce(_get(value, "$.output_text"), output_text, *[_get(value, p) for p in later], raw)

    return let(strict_json(raw), first_present)


def reasoning_volume(assembled: DataFrame) -> DataFrame:
    """Requests, and characters of reasoning over all of them."""
    return assembled.agg(
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(F.sum("reasoning_chars"), F.lit(0)).alias("reasoning_chars"),
    )


def follow_event_log(spark, path: str, out: str, checkpoint: str, deltas_only: bool = False):
    """Structured Streaming: append decoded, classified chunks of new event-log files to a table.

    Input files are JSON lines ``(request_id, seq, line)``. Returns the query; rows are independent,
    so there is no state to keep and ``assemble`` can run on the table at any time.
    """
    lines = spark.readStream.schema("request_id long, seq long, line string").json(path)
    chunks = typed_deltas(decode_lines(lines), deltas_only)
    return (
        chunks.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
