"""E: gap filling over the documents (gaps where no label exists) and the parts."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.catalog.registry import query, sql_case, sql_list, sql_strip, sql_text, table
from evenweave.example import ad_tasks
from evenweave.functions.text import is_filled
from evenweave.operators import assign as A
from evenweave.plans.enrich import LadderOptions, ask_all, run_ladder, run_task, run_tasks
from evenweave.session import new_run_dir
from evenweave.sources.ledger import ProgressStore, read_ledger
from evenweave.spec import TaskSpec

TASKS = ad_tasks()
TEXT, IMG, CTA, AUDIENCE = (TASKS.get(n) for n in ("text", "img_desc", "cta", "audience"))

# ------------------------------------------------------------------ inputs

EMOTIONS = ["Joy", "Anger", "Trust", "Excitement", "Fear", "Hope", ""]
TONES = ["Positive", "Negative", "Neutral"]
COLOURS = ["Red", "None", "", "Mixed", "Blue"]
THEMES = ["Food", "Tech", "Technology", "Fashion", "Travel", "", "GAMING"]


def _nth(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def part_rows(spark, sf_dir):
    """Parts as rows to describe."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        key.alias("row_id"),
        _nth(THEMES, key % 7).alias("theme"),
        F.concat(F.lit("obj"), key.cast("string")).alias("object_detected"),
        _nth(EMOTIONS, size % 7).alias("emotion"),
        _nth(TONES, size % 3).alias("sentiment"),
        _nth(COLOURS, key % 5).alias("dominant_colour"),
        F.when(size % 2 == 0, F.col("p_name")).otherwise(F.lit("")).alias("text"),
        F.lit("").alias("keywords"),
    )


PARTS_SQL = f"""(SELECT p_partkey AS row_id, ({sql_list(THEMES)})[p_partkey % 7 + 1] AS theme,
  'obj' || p_partkey AS object_detected, ({sql_list(EMOTIONS)})[p_size % 7 + 1] AS emotion,
  ({sql_list(TONES)})[p_size % 3 + 1] AS sentiment, ({sql_list(COLOURS)})[p_partkey % 5 + 1] AS dominant_colour,
  CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END AS text, '' AS keywords FROM part)"""


def document_rows(spark, sf_dir):
    """Documents whose text counts only where a label exists; the others are gaps."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    text = F.when(F.col("quality").isNotNull(), F.col("text"))
    return joined.select(
        F.col("doc_id").alias("row_id"), text.alias("text"), "quality", "source", "lang"
    )


DOCS_SQL = """(SELECT doc_id AS row_id, CASE WHEN quality IS NOT NULL THEN text END AS text, quality, source, lang
  FROM documents LEFT JOIN labels USING (doc_id))"""
_FILLED = f"length({sql_strip(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')')}) >= 400"
MIN = 400

# ------------------------------------------------------------------ gaps and batches


@query("E2_filled_predicate", f"SELECT row_id, {_FILLED} AS filled FROM {DOCS_SQL}")
def e2(spark, sf_dir):
    return document_rows(spark, sf_dir).select("row_id", is_filled("text", MIN).alias("filled"))


@query("E3_fill_status", f"""
SELECT count(*) FILTER ({_FILLED}) AS filled, count(*) AS total, count(*) FILTER ({_FILLED}) = count(*) AS complete
FROM {DOCS_SQL}""")
def e3(spark, sf_dir):
    return A.fill_status(document_rows(spark, sf_dir), "text", MIN)


@query("E4_batch_assignment", """
SELECT doc_id AS row_id, doc_id // 30 AS batch_id, CAST(doc_id % 30 AS INTEGER) AS pos FROM documents""")
def e4(spark, sf_dir):
    return A.add_batches(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id")))


@query("E5_unfinished_batches", f"""
SELECT row_id // 3 AS batch_id FROM {DOCS_SQL} GROUP BY 1 HAVING NOT bool_and({_FILLED})""")
def e5(spark, sf_dir):
    return A.unfinished_batches(A.add_batches(document_rows(spark, sf_dir), batch_rows=3), "text", MIN)


@query("E14_E23_gaps_and_chunks", f"""
SELECT row_id, batch_id, pos, CAST(gap AS INTEGER) AS gap, CAST(gap // 5 AS INTEGER) AS chunk FROM (
  SELECT row_id, row_id // 30 AS batch_id, CAST(row_id % 30 AS INTEGER) AS pos,
         row_number() OVER (PARTITION BY row_id // 30 ORDER BY row_id) - 1 AS gap FROM {DOCS_SQL} WHERE NOT {_FILLED})""")
def e14(spark, sf_dir):
    gaps = A.find_gaps(A.add_batches(document_rows(spark, sf_dir)), "text", MIN)
    return A.micro_batches(gaps).select("row_id", "batch_id", "pos", "gap", "chunk")


# ------------------------------------------------------------------ prompts


def _prompt_sql(line: str, template: str) -> str:
    return f"""
SELECT row_id // 30 AS batch_id, CAST(count(*) AS INTEGER) AS n,
       replace(replace({sql_text(template)}, '{{n}}', count(*)::VARCHAR), '{{rows}}',
               string_agg((row_id % 30 + 1) || '. ' || {line}, chr(10) ORDER BY row_id)) AS prompt
FROM {PARTS_SQL} GROUP BY row_id // 30"""


def _context_sql(label: str) -> str:
    return f"CASE WHEN text <> '' THEN '{label}' || text ELSE '' END"


_LINES = {
    "E6_text_prompts": (TEXT, "'Theme:' || theme || ' | Object:' || object_detected || ' | Emotion:' || emotion || ' | Sentiment:' || sentiment", V.TEXT_BATCH),
    "E7_image_prompts": (IMG, f"object_detected || ' | ' || theme || ' | ' || emotion || ' | ' || {_context_sql('Ad Copy: ')}", V.IMG_BATCH),
    "E8_cta_prompts": (CTA, f"'Object: ' || object_detected || ' | Theme: ' || theme || ' | Emotion: ' || emotion || ' | ' || {_context_sql('Ad Copy: ')}", V.CTA_BATCH),
    "E9_audience_prompts": (AUDIENCE, f"'Object: ' || object_detected || ' | Theme: ' || theme || ' | ' || {_context_sql('Ad: ')}",
                            V.AUDIENCE_BATCH.replace("{categories}", V.AUDIENCE_CATEGORIES)),
}


def _prompt_query(task):
    def run(spark, sf_dir):
        return A.batch_prompts(A.add_batches(part_rows(spark, sf_dir)), task, ["batch_id"], "pos")

    return run


for _name, (_task, _line, _template) in _LINES.items():
    query(_name, _prompt_sql(_line, _template))(_prompt_query(_task))


def _single_sql(template: str, angles: list[str] | None, fields: list[str]) -> str:
    text = sql_text(template)
    if angles:
        text = f"replace({text}, '{{angle}}', ({sql_list(angles)})[v + 1])"
    for f in fields:
        text = f"replace({text}, '{{{f}}}', {f})"
    return f"""
SELECT row_id, CAST(v AS INTEGER) AS variation, {text} AS prompt
FROM {PARTS_SQL}, unnest(range(6)) AS u(v)"""


_FIELDS = ["object_detected", "theme", "emotion", "sentiment"]
_SINGLES = {
    "E10_single_prompts_text": (TEXT, V.TEXT_SINGLE, V.TEXT_ANGLES, _FIELDS),
    "E10_single_prompts_image": (IMG, V.IMG_SINGLE, V.IMG_ANGLES, [*_FIELDS[:3], "text"]),
    "E10_single_prompts_cta": (CTA, V.CTA_SINGLE, V.CTA_ANGLES, _FIELDS[:3]),
    "E11_single_prompts_audience": (
        AUDIENCE, V.AUDIENCE_SINGLE.replace("{categories}", V.AUDIENCE_CATEGORIES), None, [*_FIELDS[:2], "text"],
    ),
}


def _single_query(task):
    def run(spark, sf_dir):
        return A.single_prompts(part_rows(spark, sf_dir), task).select("row_id", "variation", "prompt")

    return run


for _name, (_task, *_args) in _SINGLES.items():
    query(_name, _single_sql(*_args))(_single_query(_task))


@query("E12_messages", """
SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'system=rules of ' || role || ';' ELSE '' END || 'user=' || text AS messages,
       CASE WHEN turn % 3 = 0 THEN 'rules of ' || role || chr(10) || chr(10) ELSE '' END || text AS joined
FROM conversations""")
def e12(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    system = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("rules of "), F.col("role"))).when(
        F.col("turn") % 3 == 1, F.lit("")
    )
    listed = F.transform(
        A.messages(system, F.col("text")), lambda m: F.concat(m["role"], F.lit("="), m["content"])
    )
    return turns.select(
        "conv_id", "turn", F.array_join(listed, ";").alias("messages"),
        A.joined_input(system, F.col("text")).alias("joined"),
    )


# ------------------------------------------------------------------ generator calls and the ladder


def measuring_generator():
    """Answers with the prompt's length; gives up on some prompts and fails on others."""
    def factory():
        def generate(prompt, system, temperature):
            if len(prompt) % 5 == 0:
                return None
            if len(prompt) % 5 == 1:
                raise RuntimeError("no answer")
            return f"{system}|{temperature}|{len(prompt)}"

        return generate

    return factory


def second_generator():
    def factory():
        def generate(prompt, system, temperature):
            return None if len(prompt) % 10 == 0 else "second"

        return generate

    return factory


@query("E13_generator_calls", """
SELECT conv_id, turn, CASE WHEN length(text) % 10 = 0 THEN NULL WHEN length(text) % 5 < 2 THEN 'second'
       ELSE 'be brief|0.5|' || length(text) END AS raw FROM conversations""")
def e13(spark, sf_dir):
    opts = LadderOptions(factory=measuring_generator(), secondary=second_generator())
    turns = table(spark, sf_dir, "conversations")
    requests = turns.select("conv_id", "turn", F.col("text").alias("prompt"))
    asked = ask_all(requests, requests.count(), opts, "be brief", 0.5, keys=("conv_id", "turn"))
    return asked.select("conv_id", "turn", "raw")


def numbering_generator():
    """Answers with the prompt and the generator it came from."""
    def factory():
        return lambda prompt, system, temperature: f"asked {prompt}"

    return factory


@query("E13_S11_answers_kept", """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'stored ' ELSE 'asked ' END || lang || ' ' || source AS raw,
  (SELECT count(DISTINCT lang || ' ' || source) FROM documents) AS stored, (SELECT count(DISTINCT lang || ' ' || source) FROM documents) AS answers
FROM documents""")
def e13_kept(spark, sf_dir):
    """Prompts that repeat, over a store with some answers: every other prompt is asked once, and a second round asks nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.concat_ws(" ", "lang", "source").alias("prompt"))
    opts = LadderOptions(factory=numbering_generator(), in_flight=4, answers=new_run_dir(spark) + "/answers")
    english = docs.where("lang = 'en'").select("doc_id", "prompt")
    teller = LadderOptions(factory=lambda: lambda p, s, t: f"stored {p}", answers=opts.answers)
    ask_all(english, 100, teller, "be brief", 0.5)
    first = ask_all(docs, 100, opts, "be brief", 0.5)
    stored = spark.read.parquet(opts.answers).agg(F.count("*")).scalar()
    again = ask_all(docs, 100, opts, "be brief", 0.5).agg(F.count_distinct("raw")).scalar()
    return first.select("doc_id", "raw", stored.alias("stored"), again.alias("answers"))


def staged_generator():
    """Decides by the ids in the prompt, so that every phase of the ladder has work to do.

    Whole batches, by number mod 4: answered; cut off after 20 rows; prose; an error. Chunks of five are
    answered if their first id is even. Single rows are answered if the id is a multiple of three, once
    the temperature is above 0.9.
    """
    def factory():
        def generate(prompt, system, temperature):
            single = re.search(r"^Object: obj(\d+)$", prompt, re.M)
            if single:
                i = int(single.group(1))
                if i % 3 == 0 and temperature > 0.9:
                    return '{"text":"single text %d","keywords":"k"}' % i
                return None if i % 2 else '{"text":"no"}'
            ids = [int(x) for x in re.findall(r"Object:obj(\d+) ", prompt)]
            items = [{"id": k + 1, "text": f"text of row {i}", "keywords": f"k{i}"} for k, i in enumerate(ids)]
            if len(ids) == 5:
                return None if ids[0] % 2 else json.dumps(items)
            kind = ids[0] // 30 % 4
            if kind == 3:
                raise RuntimeError("no answer")
            if kind == 2:
                return "sorry, no list today"
            return json.dumps(items[:20] if len(ids) == 30 and kind == 1 else items)

        return generate

    return factory


def _staged() -> LadderOptions:
    return LadderOptions(factory=staged_generator())


def open_parts(spark, sf_dir):
    """Parts without text, but for every 41st."""
    done = F.col("row_id") % 41 == 7
    return part_rows(spark, sf_dir).withColumn("text", F.when(done, F.lit("kept text")).otherwise(F.lit("")))


_KIND = "(row_id // 30) % 4"
# Gap number of an unfilled row within its batch; the kept rows are not sent again.
_GAPS = f"""(SELECT *, row_number() OVER (PARTITION BY row_id // 30 ORDER BY row_id) - 1 AS gap
  FROM {PARTS_SQL} WHERE row_id % 41 <> 7)"""
_STAGED = f"""(SELECT g.*, CASE WHEN {_KIND} = 0 THEN 1
    WHEN {_KIND} = 1 THEN CASE WHEN row_id % 30 < 20 THEN 1 WHEN taken IS NOT NULL THEN 1 ELSE 2 END
    WHEN size = 5 AND first % 2 = 0 OR size <> 5 AND (first // 30) % 4 < 2 THEN 3
    WHEN row_id % 3 = 0 THEN 4 ELSE 5 END AS phase, taken
  FROM (SELECT *, count(*) OVER c AS size, min(row_id) OVER c AS first,
               row_number() OVER (PARTITION BY row_id // 30, row_id % 30 >= 20 ORDER BY row_id) AS late FROM {_GAPS}
        WINDOW c AS (PARTITION BY row_id // 30, gap // 5)) g
  -- A kept row leaves its item unused; the first rows behind the cut take these items.
  LEFT JOIN (SELECT p_partkey // 30 AS b, row_number() OVER (PARTITION BY p_partkey // 30 ORDER BY p_partkey) AS nth,
                    p_partkey AS taken FROM part WHERE p_partkey % 41 = 7 AND p_partkey % 30 < 20) k
    ON b = row_id // 30 AND {_KIND} = 1 AND row_id % 30 >= 20 AND nth = late)"""
_FALLBACK_TEXT = "CASE " + " ".join(
    f"WHEN emotion = {sql_text(e)} AND sentiment = {sql_text(s)} THEN replace({sql_text(t)}, '{{object_detected}}', object_detected)"
    for (e, s), t in V.TEXT_FALLBACKS.items()
) + f" ELSE replace(replace({sql_text(V.TEXT_FALLBACK_DEFAULT)}, '{{object_detected}}', object_detected), '{{theme}}', theme) END"
_FALLBACK_KEYS = "object_detected || ' ' || theme || ' ' || lower(emotion)"
_STAGED_TEXT = f"""CASE WHEN phase <= 3 THEN 'text of row ' || coalesce(taken, row_id)
  WHEN phase = 4 THEN 'single text ' || row_id ELSE {_FALLBACK_TEXT} END"""
_STAGED_KEYS = f"CASE WHEN phase <= 3 THEN 'k' || coalesce(taken, row_id) WHEN phase = 4 THEN 'k' ELSE {_FALLBACK_KEYS} END"
_STAGED_OUT = f"""
SELECT row_id, theme, object_detected, emotion, sentiment, dominant_colour, {_STAGED_TEXT} AS text, {_STAGED_KEYS} AS keywords
FROM {_STAGED}
UNION ALL SELECT row_id, theme, object_detected, emotion, sentiment, dominant_colour, 'kept text', '' FROM {PARTS_SQL} WHERE row_id % 41 = 7"""


@query("E21_E24_E29_phase_ladder", f"SELECT row_id, CAST(phase AS INTEGER) AS phase, {_STAGED_TEXT} AS text, {_STAGED_KEYS} AS keywords FROM {_STAGED}")
def e29(spark, sf_dir):
    return run_ladder(open_parts(spark, sf_dir), TEXT, _staged()).fills


def repeating_generator():
    """Answers whose values repeat. Whole batches get ten values that the next batch gets too; gaps of twenty rows and more
    get values of their own; chunks get one value for all; single rows get one of four.
    """
    def factory():
        def generate(prompt, system, temperature):
            single = re.search(r"^Object: obj(\d+)$", prompt, re.M)
            if single:
                return '{"text":"single text %d","keywords":"k"}' % (int(single.group(1)) % 4)
            ids = [int(x) for x in re.findall(r"Object:obj(\d+) ", prompt)]
            batch = ids[0] // 30
            if len(ids) == 30:
                values = [f"value number {batch // 2 * 10 + k // 3}" for k in range(30)]
            elif len(ids) >= 20:
                values = [f"value of row {i}" for i in ids]
            else:
                values = [f"value of chunk {ids[0]}"] * len(ids)
            return json.dumps([{"text": v, "keywords": "k"} for v in values])

        return generate

    return factory


_REPEATED = """
SELECT row_id, CAST(phase AS INTEGER) AS phase, CASE phase
    WHEN 1 THEN CASE WHEN size < 30 THEN 'value of row ' || row_id ELSE 'value number ' || (b // 2 * 10 + pos) END
    WHEN 2 THEN 'value of row ' || row_id WHEN 3 THEN 'value of chunk ' || row_id ELSE 'single text ' || row_id % 4 END AS text
FROM (SELECT *, CASE WHEN size < 30 THEN 1
        WHEN b % 2 = 0 THEN CASE WHEN pos >= 10 OR used AND pos = 3 THEN 2 ELSE 1 END
        WHEN used THEN 2 WHEN pos % 5 = 0 THEN 3 ELSE 4 END AS phase
      FROM (SELECT *, b % 10 >= 8 AND max(row_id % 300) OVER (PARTITION BY row_id // 300) = 299 AS used,
                   count(*) OVER (PARTITION BY b) AS size
            FROM (SELECT p_partkey AS row_id, p_partkey // 30 AS b, p_partkey % 30 AS pos FROM part)))
WHERE row_id % 300 <> 299"""


@query("E19_E29_ladder_without_repeats", _REPEATED)
def e19_e29(spark, sf_dir):
    """The ladder with deduplication: repeats inside a batch, between batches and of values that the table holds."""
    rows = part_rows(spark, sf_dir)
    block = F.floor(F.col("row_id") / 300)
    held = F.concat(F.lit("value number "), (block * 50 + 43).cast("string"))
    rows = rows.withColumn("text", F.when(F.col("row_id") % 300 == 299, held).otherwise(""))
    task = TaskSpec(**{**TEXT.__dict__, "name": "unique", "deduplicate": True})
    opts = LadderOptions(factory=repeating_generator(), max_retries=1)
    return run_ladder(rows, task, opts).fills.select("row_id", "phase", "text")


@query("E30_E33_E34_run_task", _STAGED_OUT)
def e30(spark, sf_dir):
    return run_task(open_parts(spark, sf_dir), "text", TASKS, _staged())


@query("E31_run_tasks", f"""
SELECT *, CASE WHEN row_id % 30 = 0 THEN 'first of its batch ' || row_id ELSE 'picture of ' || object_detected END AS img_desc
FROM ({_STAGED_OUT})""")
def e31(spark, sf_dir):
    opts = LadderOptions(factory=text_and_picture_generator())
    done, _, _, _ = run_tasks(open_parts(spark, sf_dir), ["text", "unknown", "text", "img_desc"], TASKS, opts)
    return done


def text_and_picture_generator():
    """The staged answers for texts; for pictures always all rows of the batch."""
    texts = staged_generator()

    def factory():
        about_texts = texts()

        def generate(prompt, system, temperature):
            if "search queries" not in prompt:
                return about_texts(prompt, system, temperature)
            ids = [int(i) for i in re.findall(r"^\d+\. obj(\d+) \|", prompt, re.M)]
            said = [f"picture of obj{i}" if i % 30 else f"first of its batch {i}" for i in ids]
            return json.dumps([{"img_desc": text} for text in said])

        return generate

    return factory


def refusing_generator():
    def factory():
        def generate(prompt, system, temperature):
            return None

        return generate

    return factory


@query("E32_resume", """
SELECT row_id, CASE WHEN row_id < 60 THEN 'saved text ' || row_id ELSE 'text of row ' || row_id END AS text
FROM (SELECT p_partkey AS row_id FROM part)""")
def e32(spark, sf_dir):
    """A run that broke off after two batches goes on with the third; saved values stay."""
    rows = part_rows(spark, sf_dir).withColumn("text", F.lit(""))
    store = ProgressStore(new_run_dir(spark) + "/progress")
    fingerprint = store.fingerprint(rows, ["row_id", *TEXT.inputs, "text"])
    store.reset(spark, TEXT, fingerprint)
    saved = rows.where("row_id < 60").select(
        "row_id", F.lit(1).alias("phase"), F.concat(F.lit("saved text "), F.col("row_id").cast("string")).alias("text"),
        F.lit("k").alias("keywords"),
    )
    n = rows.count()
    store.save(saved, TEXT, fingerprint, 2, -(-n // 30), 60, n, 30)
    opts = LadderOptions(factory=willing_generator())
    return run_task(rows, "text", TASKS, opts, store).select("row_id", "text")


def willing_generator():
    def factory():
        def generate(prompt, system, temperature):
            ids = re.findall(r"Object:obj(\d+) ", prompt)
            return json.dumps([{"text": f"text of row {i}", "keywords": "k"} for i in ids])

        return generate

    return factory


# ------------------------------------------------------------------ assignment


@query("E15_E17_assignment", """
SELECT row_id, CAST(CASE WHEN filled THEN -1 WHEN pos < 20 THEN pos WHEN free IS NOT NULL THEN free ELSE -1 END AS INTEGER) AS pick
FROM (SELECT doc_id AS row_id, doc_id // 30 AS b, doc_id % 30 AS pos, quality IS NOT NULL AS filled,
             row_number() OVER (PARTITION BY doc_id // 30, quality IS NULL, doc_id % 30 >= 20 ORDER BY doc_id) AS nth
      FROM documents LEFT JOIN labels USING (doc_id)) r
LEFT JOIN (SELECT doc_id // 30 AS fb, doc_id % 30 AS free,
                  row_number() OVER (PARTITION BY doc_id // 30 ORDER BY doc_id) AS fnth
           FROM documents JOIN labels USING (doc_id) WHERE doc_id % 30 < 20) f
  ON fb = b AND fnth = nth AND NOT filled AND pos >= 20""")
def e15(spark, sf_dir):
    """Twenty items per batch of thirty: direct by position, the rest from items of filled rows."""
    rows = A.add_batches(document_rows(spark, sf_dir))
    batches = rows.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "row_id", F.col("quality").isNotNull().alias("filled")))).alias("rows")
    )
    items = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.concat(F.lit("item number "), k.cast("string")))
    picks = A.pick_items(F.transform("rows", lambda r: r["filled"]), items, 8)
    return batches.select(F.explode(F.arrays_zip("rows", picks.alias("picks"))).alias("z")).select(
        F.col("z.rows.row_id").alias("row_id"), F.col("z.picks").alias("pick")
    )


_ID_ITEMS = """
SELECT b, k, CASE WHEN k % 10 = 3 THEN NULL WHEN k % 10 = 7 THEN NULL WHEN k % 10 = 9 THEN 100 + k
  WHEN k >= 20 THEN ((k - 20) * 7 + b) % 30 + 1 ELSE (k * 7 + b) % 30 + 1 END AS id
FROM (SELECT DISTINCT doc_id // 30 AS b FROM documents), range(25) AS r(k) WHERE (k + b) % 8 <> 5"""


@query("E15_aligned_by_id", f"""
WITH rows AS (SELECT doc_id AS row_id, doc_id // 30 AS b, doc_id % 30 AS pos, quality IS NOT NULL AS filled
              FROM documents LEFT JOIN labels USING (doc_id)),
items AS ({_ID_ITEMS}),
named AS (SELECT row_id, min(k) AS k FROM rows JOIN items ON items.b = rows.b AND id = pos + 1 AND NOT filled GROUP BY row_id),
free AS (SELECT b, k, row_number() OVER (PARTITION BY b ORDER BY k) AS nth FROM items
         WHERE NOT EXISTS (SELECT 1 FROM named JOIN rows USING (row_id) WHERE rows.b = items.b AND named.k = items.k)),
open AS (SELECT row_id, b, row_number() OVER (PARTITION BY b ORDER BY pos) AS nth FROM rows
         WHERE NOT filled AND row_id NOT IN (SELECT row_id FROM named))
SELECT row_id, CAST(coalesce(named.k, free.k, -1) AS INTEGER) AS pick
FROM rows LEFT JOIN named USING (row_id) LEFT JOIN open USING (row_id) LEFT JOIN free ON free.b = open.b AND free.nth = open.nth""")
def e15_id(spark, sf_dir):
    """Twenty-five items per batch in any order: ids repeated, absent, no numbers, or of no row; some values too short."""
    rows = A.add_batches(document_rows(spark, sf_dir))
    batches = rows.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "row_id", F.col("quality").isNotNull().alias("filled")))).alias("rows"))

    def item(k):
        b = F.col("batch_id")
        number = F.when(k >= 20, F.pmod((k - 20) * 7 + b, F.lit(30))).otherwise(F.pmod(k * 7 + b, F.lit(30))) + 1
        name = (F.when(k % 10 == 3, "").when(k % 10 == 7, F.concat(F.lit("row "), k.cast("string")))
                .when(k % 10 == 9, F.concat((k + 100).cast("string"))).otherwise(F.concat(F.lit(" "), number.cast("string"))))
        text = F.when(F.pmod(k + b, F.lit(8)) == 5, "short").otherwise(F.concat(F.lit("item number "), k.cast("string")))
        return F.create_map(F.lit("id"), name, F.lit("text"), text)

    items = F.transform(F.sequence(F.lit(0), F.lit(24)), item)
    batches = batches.withColumn("items", items)
    texts = F.transform("items", lambda i: F.try_element_at(i, F.lit("text")))
    picks = A.pick_items(F.transform("rows", lambda r: r["filled"]), texts, 8, ids=A.item_ids(F.col("items")))
    return batches.select(F.explode(F.arrays_zip("rows", picks.alias("picks"))).alias("z")).select(
        F.col("z.rows.row_id").alias("row_id"), F.col("z.picks").alias("pick")
    )


@query("E16_extracted_values", """
SELECT doc_id, trim(lang) AS text, CASE WHEN doc_id % 2 = 0 THEN source || ' x' ELSE '' END AS keywords FROM documents""")
def e16(spark, sf_dir):
    item = F.map_from_arrays(
        F.array(F.lit("text"), F.when(F.col("doc_id") % 2 == 0, F.lit("keywords")).otherwise(F.lit("other"))),
        F.array(F.concat(F.lit(' "'), F.col("lang"), F.lit('" ')), F.concat(F.col("source"), F.lit("\\n x"))),
    )
    values = A.item_values(F.array(item), ["text", "keywords"])
    return table(spark, sf_dir, "documents").select("doc_id", F.inline(values))


@query("E18_E34_apply_values", """
SELECT doc_id AS row_id, source, CASE WHEN quality IS NOT NULL THEN 'q' || quality ELSE lang END AS lang,
       CASE WHEN quality IS NOT NULL THEN '' || toxic ELSE '' END AS flag
FROM documents LEFT JOIN labels USING (doc_id)""")
def e18(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "source", "lang")
    fills = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_id"), F.lit(1).alias("phase"),
        F.concat(F.lit("q"), F.col("quality").cast("string")).alias("lang"), F.col("toxic").cast("string").alias("flag"),
    )
    return A.apply_fills(docs, fills, ["lang", "flag"])


_USED = "(SELECT DISTINCT text FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"


@query("E19_deduplication", f"""
SELECT doc_id AS row_id FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS nth FROM documents)
WHERE nth = 1 AND text NOT IN {_USED}""")
def e19(spark, sf_dir):
    docs = A.add_batches(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text"))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("row_id"))
    used = A.existing_values(docs.join(toxic, "row_id", "left_semi"), "text", 1)
    return A.deduplicate(docs, "text", "row_id", used).select("row_id")


@query("E20_existing_values", f"SELECT count(DISTINCT text) AS n FROM {DOCS_SQL} WHERE {_FILLED}")
def e20(spark, sf_dir):
    return A.existing_values(document_rows(spark, sf_dir), "text", MIN).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ fallbacks


@query("E25_text_fallback", f"SELECT row_id, {_FALLBACK_TEXT} AS text, {_FALLBACK_KEYS} AS keywords FROM {PARTS_SQL}")
def e25(spark, sf_dir):
    values = TEXT.fallback()
    return part_rows(spark, sf_dir).select("row_id", *[c.alias(n) for n, c in values.items()])


@query("E26_image_fallback", f"""
SELECT row_id, '"' || lower(object_detected) || '"' ||
  CASE WHEN dominant_colour IN ('', 'None', 'Mixed') THEN '' ELSE ' ' || lower(dominant_colour) END ||
  CASE WHEN theme = '' THEN '' ELSE ' ' || lower(theme) END ||
  coalesce(' ' || {sql_case('emotion', V.IMG_MOODS)}, '') || ' {V.IMG_SUFFIX}' AS img_desc FROM {PARTS_SQL}""")
def e26(spark, sf_dir):
    return part_rows(spark, sf_dir).select("row_id", IMG.fallback()["img_desc"].alias("img_desc"))


@query("E27_audience_fallback", f"""
SELECT row_id, {sql_case('lower(theme)', V.AUDIENCE_BY_THEME, sql_text(V.AUDIENCE_DEFAULT))} AS target_audience FROM {PARTS_SQL}""")
def e27(spark, sf_dir):
    return part_rows(spark, sf_dir).select("row_id", AUDIENCE.fallback()["target_audience"].alias("target_audience"))


@query("E28_no_fallback", f"""
SELECT row_id, theme, object_detected, emotion, sentiment, dominant_colour, text, keywords,
       '' AS monetary_mention, '' AS call_to_action FROM {PARTS_SQL}""")
def e28(spark, sf_dir):
    """Nothing answers and the task has no fallback: all rows stay gaps."""
    opts = LadderOptions(factory=refusing_generator(), max_retries=1, variations=1)
    return run_task(part_rows(spark, sf_dir), "cta", TASKS, opts)


@query("E1_task_outputs", f"""
SELECT row_id, 'described ' || row_id AS caption, '' AS alt FROM {PARTS_SQL}""")
def e1(spark, sf_dir):
    """A task of one's own: any columns, builders as Columns, values by fallback only."""
    task = TaskSpec(
        name="caption", output_columns=["caption", "alt"], min_length=5, inputs=["row_id"], deduplicate=False,
        fallback=lambda: {"caption": F.concat(F.lit("described "), F.col("row_id").cast("string"))},
    )
    run = run_ladder(part_rows(spark, sf_dir), task, LadderOptions(factory=refusing_generator()))
    return run.table.select("row_id", "caption", "alt")


@query("E29_partial_fallback", f"""
SELECT row_id, 'described ' || row_id AS caption, 'kept ' || row_id AS alt FROM {PARTS_SQL}""")
def e29_partial(spark, sf_dir):
    """A fallback for one of two columns leaves the other as it is."""
    number = F.col("row_id").cast("string")
    task = TaskSpec(
        name="caption", output_columns=["caption", "alt"], min_length=5, inputs=["row_id"], deduplicate=False,
        fallback=lambda: {"caption": F.concat(F.lit("described "), F.col("row_id").cast("string"))},
    )
    rows = part_rows(spark, sf_dir).withColumn("alt", F.concat(F.lit("kept "), number))
    run = run_ladder(rows, task, LadderOptions(factory=refusing_generator()))
    return run.table.select("row_id", "caption", "alt")


@query("S7_S8_ledger_of_a_run", """
SELECT 'text' AS task_name, CAST(b AS INTEGER) AS completed_batches, CAST(total AS INTEGER) AS total_batches,
       least(b * 30, n) AS completed_rows, n AS total_rows
FROM (SELECT count(*) AS n, (count(*) + 29) // 30 AS total, ((count(*) + 29) // 30 + 1) // 2 AS half FROM part),
     unnest([half, total]) AS u(b)""")
def s7_run(spark, sf_dir):
    """Ledger of a run in two waves."""
    rows = part_rows(spark, sf_dir).withColumn("text", F.lit(""))
    store = ProgressStore(new_run_dir(spark) + "/progress")
    half = (-(-rows.count() // 30) + 1) // 2
    opts = LadderOptions(factory=willing_generator())
    run_task(rows, "text", TASKS, opts, store, batches_per_wave=half)
    return read_ledger(spark, store.ledger_path).select(
        "task_name", "completed_batches", "total_batches", "completed_rows", "total_rows"
    )
