"""Prompts, assignment, fallbacks, and the ladder with stub generators."""

import json
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.example import ad_spec, ad_tasks
from evenweave.functions.text import is_filled
from evenweave.operators import assign as A
from evenweave.operators import checks as C
from evenweave.operators.skeleton import build_skeleton
from evenweave.plans.enrich import (
    ask_all,
    LadderOptions,
    is_task_complete,
    phase_report,
    run_ladder,
    run_task,
    run_tasks,
)
from evenweave.session import materialize, new_run_dir
from evenweave.sources.ledger import ProgressStore, read_ledger, status
from evenweave.spec import TaskRegistry, TaskSpec

TASKS = ad_tasks()
# Python workers cannot import this file, so its generators travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_task_contract():
    with pytest.raises(ValueError):
        TaskSpec(name="x", output_columns=[])
    with pytest.raises(ValueError):
        TaskSpec(name="x", output_columns=["a"], primary_column="b")
    assert TaskSpec(name="x", output_columns=["a", "b"]).primary_column == "a"
    assert TaskSpec(name="x", output_columns=["a"]).deduplicate and TASKS.get("text").min_length == 8
    reg = TaskRegistry()
    reg.register(TaskSpec(name="x", output_columns=["a"]))
    reg.register(TaskSpec(name="x", output_columns=["b"]))
    assert reg.names() == ["x"] and reg.get("x").output_columns == ["b"] and reg.get("y") is None
    assert TASKS.names() == ["text", "img_desc", "cta", "audience", "headline"]


def test_a_round_of_many_requests_has_tasks_by_cores(spark):
    """Tasks that grow in number with the requests cost a worker, a file and a block of every task before them each."""
    requests = spark.range(3).select("id", F.lit("p").alias("prompt"))
    opts = LadderOptions(factory=lambda: lambda prompt, system, temperature: prompt)
    for n, most in ((64, 1), (1000, 16), (1_000_000, 256), (100_000_000, 256)):
        assert ask_all(requests, n, opts, "", 0.5, keys=("id",)).rdd.getNumPartitions() <= most
    assert opts.tasks(100_000_000, cores=100) == 1600 and opts.tasks(640, cores=100) == 10


def test_prompts(spark):
    df = spark.createDataFrame(
        [(0, 0, "Food", "Pizza", "Joy", "Positive", "Red", "tasty"), (1, 1, "Tech", "Phone", "Fear", "Negative", None, None)],
        "row_id long, pos int, theme string, object_detected string, emotion string, sentiment string, "
        "dominant_colour string, text string",
    ).withColumn("batch_id", F.lit(0))
    text = A.batch_prompts(df, TASKS.get("text"), ["batch_id"], "pos").first()
    assert text.n == 2 and text.prompt.startswith(
        "Generate 2 ad copy lines.\n\nROWS:\n1. Theme:Food | Object:Pizza | Emotion:Joy | Sentiment:Positive\n"
        "2. Theme:Tech | Object:Phone | Emotion:Fear | Sentiment:Negative\n\nOUTPUT FORMAT - JSON array with 2 objects:"
    )
    assert '{"id":1,"text":"Your ad copy here"' in text.prompt
    img = A.batch_prompts(df, TASKS.get("img_desc"), ["batch_id"], "pos").first().prompt
    assert "1. Pizza | Food | Joy | Ad Copy: tasty\n2. Phone | Tech | Fear | \n" in img
    cta = A.batch_prompts(df, TASKS.get("cta"), ["batch_id"], "pos").first().prompt
    assert "1. Object: Pizza | Theme: Food | Emotion: Joy | Ad Copy: tasty\n" in cta
    aud = A.batch_prompts(df, TASKS.get("audience"), ["batch_id"], "pos").first().prompt
    assert "- General: unclear or mixed themes" in aud and aud.count("\n- ") >= 55
    assert "1. Object: Pizza | Theme: Food | Ad: tasty\n" in aud
    single = A.single_prompts(df.where("row_id = 0"), TASKS.get("text")).orderBy("variation").collect()
    assert [r.prompt.split("\n")[0] for r in single] == [f"Write ONE ad copy line {a}." for a in V.TEXT_ANGLES]
    assert "Object: Pizza\nEmotion: Joy" in single[0].prompt
    audience = A.single_prompts(df.where("row_id = 1"), TASKS.get("audience")).collect()
    assert len({r.prompt for r in audience}) == 1 and "Ad Copy: \n" in audience[0].prompt


def test_messages(spark):
    df = spark.createDataFrame([("sys", "p"), ("", "p"), (None, "p")], "s string, p string")
    got = df.select(
        A.messages(F.col("s"), F.col("p")).alias("m"), A.joined_input(F.col("s"), F.col("p")).alias("j")
    ).collect()
    assert [[(m.role, m.content) for m in r.m] for r in got] == [
        [("system", "sys"), ("user", "p")], [("user", "p")], [("user", "p")],
    ]
    assert [r.j for r in got] == ["sys\n\np", "p", "p"]


def naive_picks(filled, prim, m, dedup):
    used, taken, out = set(), set(), []
    ok = lambda j: len(prim[j]) >= m and not (dedup and prim[j] in taken)
    for i, f in enumerate(filled):
        pick = -1
        if not f:
            if i < len(prim) and ok(i):
                pick = i
            else:
                pick = next((j for j in range(len(prim)) if j not in used and ok(j)), -1)
        if pick >= 0:
            used.add(pick)
            taken.add(prim[pick])
        out.append(pick)
    return out


def test_pick_items(spark):
    import random

    rng = random.Random(3)
    cases = [([False] * 3, ["short", "item one ok", "item two ok"])]
    for _ in range(150):
        cases.append(
            (
                [rng.random() < 0.3 for _ in range(rng.randint(1, 7))],
                [rng.choice(["x", "good one", "good two", "good three"]) for _ in range(rng.randint(0, 8))],
            )
        )
    df = spark.createDataFrame(cases, "filled array<boolean>, prim array<string>")
    got = df.select(
        "*", A.pick_items(F.col("filled"), F.col("prim"), 8).alias("a"),
        A.pick_items(F.col("filled"), F.col("prim"), 8, True).alias("b"),
    ).collect()
    assert got[0].a == [1, 1, 2]
    for r in got:
        assert r.a == naive_picks(r.filled, r.prim, 8, False), r
        assert r.b == naive_picks(r.filled, r.prim, 8, True), r


def naive_picks_by_id(filled, prim, ids, m, dedup):
    out, taken = [-1] * len(filled), set()

    def take(i, found):
        j = next((j for j in found if len(prim[j]) >= m and j not in out and not (dedup and prim[j] in taken)), -1)
        out[i] = j
        if j >= 0:
            taken.add(prim[j])

    for i, f in enumerate(filled):
        if not f:
            take(i, [j for j in range(len(prim)) if ids[j] == i + 1])
    for i, f in enumerate(filled):
        if not f and out[i] < 0:
            take(i, range(len(prim)))
    return out


def test_pick_items_by_id(spark):
    import random

    rng = random.Random(5)
    cases = [([False] * 3, ["item one ok", "item two ok", "item three ok"], ["3", "1", "2"]), ([], ["item one ok"], ["1"])]
    for _ in range(200):
        n = rng.randint(0, 8)
        cases.append((
            [rng.random() < 0.3 for _ in range(rng.randint(1, 7))],
            [rng.choice(["x", "good one", "good two", "good three"]) for _ in range(n)],
            [rng.choice(["1", "2", " 3 ", "4", "7", "9", "-1", "two", "", None, "2.5"]) for _ in range(n)],
        ))
    df = spark.createDataFrame(cases, "filled array<boolean>, prim array<string>, ids array<string>")
    items = F.transform("ids", lambda i: F.when(i.isNotNull(), F.create_map(F.lit("id"), i)).otherwise(F.create_map(F.lit("a"), F.lit("b"))))
    df = df.withColumn("numbers", A.item_ids(items))
    got = df.select("*", *(A.pick_items(F.col("filled"), F.col("prim"), 8, d, F.col("numbers")).alias(n) for n, d in (("a", False), ("b", True))))
    rows = got.collect()
    assert rows[0].numbers == [3, 1, 2] and rows[0].a == [1, 2, 0]
    for r in rows:
        numbers = [int(i) if i is not None and i.strip().lstrip("-").isdigit() else None for i in r.ids]
        assert r.numbers == numbers
        assert r.a == naive_picks_by_id(r.filled, r.prim, numbers, 8, False), r
        assert r.b == naive_picks_by_id(r.filled, r.prim, numbers, 8, True), r


def shuffled_answer():
    """Items in reverse order, with the ids of their rows."""
    def answer(prompt, system, temperature):
        ids = [int(x) for x in re.findall(r"Object:obj(\d+) ", prompt)]
        return json.dumps([{"id": k + 1, "text": f"text of row {i}", "keywords": "k"} for k, i in enumerate(ids)][::-1])

    return answer


def test_ladder_aligned_by_id(spark):
    by = {a: run_ladder(table(spark, 45), TASKS.get("text"), LadderOptions(factory=shuffled_answer, align=a)) for a in ("id", "position")}
    named = {r.row_id: r.text for r in by["id"].fills.collect()}
    assert named == {i: f"text of row {i}" for i in range(45)}
    assert {r.row_id: r.text for r in by["position"].fills.collect()} == {
        i: f"text of row {29 - i if i < 30 else 74 - i}" for i in range(45)}


def test_used_values_are_filtered_before_the_join(spark):
    """Only values that the candidates may hold are shuffled; the plan joins bit tables by broadcast."""
    used = A.existing_values(spark.range(5000).select(F.concat(F.lit("old "), F.col("id")).alias("text")), "text", 1)
    rows = spark.range(60).select(F.col("id").alias("row_id"), F.concat(F.lit("old "), F.col("id") * 1000).alias("text"))
    assert sorted(r.row_id for r in A.deduplicate(rows, "text", "row_id", used).collect()) == list(range(5, 60))
    from evenweave.operators.bits import bit_table, maybe_in

    hits = maybe_in(used, F.xxhash64("d"), bit_table(rows, F.xxhash64(A.digest("text"))))
    assert 5 <= hits.count() <= 10


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_single_prompts_do_not_read_the_table_again(spark, tmp_path):
    from evenweave.plans.enrich import _Ladder
    from evenweave.session import materialize, new_run_dir

    path = new_run_dir(spark)
    base = materialize(table(spark, 90), f"{path}/base")
    ladder = _Ladder(base, TASKS.get("text"), LadderOptions(factory=make_answer), path)
    units = materialize(ladder.units(), f"{path}/units")
    seen = []
    ladder.opts = LadderOptions(factory=make_answer, variations=0)
    pending = ladder.single_phase(units)
    seen.append(pending._jdf.queryExecution().optimizedPlan().toString())
    assert "Join" not in seen[0] and scans(pending) == 1 and {"theme", "object_detected"} <= set(pending.columns)


def counting_factory(folder, wait=0.0):
    """Generators that note every call in a file of its own."""
    def factory():
        import os
        import time
        import uuid

        def generate(prompt, system, temperature):
            begin = time.time()
            time.sleep(wait)
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(f"{os.getpid()} {begin} {time.time()}")
            return None if prompt.endswith("7") else f"answer to {prompt}"

        return generate

    return factory


def test_calls_overlap_and_keep_their_order(spark, tmp_path):
    asked = spark.range(40).select(F.col("id"), F.concat(F.lit("prompt "), F.col("id")).alias("prompt")).coalesce(1)
    opts = LadderOptions(factory=counting_factory(str(tmp_path), 0.05), in_flight=8, concurrency=1)
    got = ask_all(asked, 40, opts, "", 0.5, keys=("id",)).collect()
    assert {r.id: r.raw for r in got} == {i: None if i % 10 == 7 else f"answer to prompt {i}" for i in range(40)}
    calls = [tuple(map(float, f.read_text().split())) for f in tmp_path.iterdir()]
    most = max(sum(b <= t < e for _, b, e in calls) for _, t, _ in calls)
    assert len(calls) == 40 and 2 <= most <= 8


def test_answers_are_kept(spark, tmp_path):
    """Equal prompts are asked once; a later run asks only what had no answer; a retry asks again."""
    asked = spark.range(60).select(F.col("id"), F.concat(F.lit("prompt "), F.col("id") % 10).alias("prompt"))
    opts = LadderOptions(factory=counting_factory(str(tmp_path)), answers=new_run_dir(spark) + "/answers")
    want = {i: None if i % 10 == 7 else f"answer to prompt {i % 10}" for i in range(60)}
    for turn, calls in (("a1", 10), ("a1", 11), ("a2", 21)):
        got = ask_all(asked, 60, opts, "", 0.5, turn=turn).collect()
        assert {r.id: r.raw for r in got} == want and len(list(tmp_path.iterdir())) == calls, turn


def test_a_run_that_broke_off_asks_nothing_again(spark, tmp_path):
    def factory():
        answer, count = make_answer(), counting_factory(str(tmp_path))()

        def generate(prompt, system, temperature):
            count(prompt, system, temperature)
            return answer(prompt, system, temperature)

        return generate

    path = new_run_dir(spark) + "/answers"
    task = TASKS.get("text")
    first = run_ladder(table(spark, 40), task, LadderOptions(factory=factory, answers=path)).fills.collect()
    calls = len(list(tmp_path.iterdir()))
    again = run_ladder(table(spark, 40), task, LadderOptions(factory=factory, answers=path)).fills.collect()
    assert sorted(again) == sorted(first) and calls
    plain = run_ladder(table(spark, 40), task, LadderOptions(factory=make_answer)).fills.collect()
    assert sorted(plain) == sorted(first)


def test_resume_reads_open_ranges_only(spark, tmp_path):
    """Ranges that are filled become one folder each; a later run neither reads nor asks for them."""
    def factory(most):
        def make():
            note = counting_factory(str(tmp_path))()

            def generate(prompt, system, temperature):
                note(prompt, system, temperature)
                ids = [int(x) for x in re.findall(r"[Oo]bject: ?obj(\d+)", prompt)]
                if ids[0] >= most:
                    return None
                items = [{"text": f"text of row {i}", "keywords": "k"} for i in ids]
                return json.dumps(items if "Object: " not in prompt else items[0])

            return generate

        return make

    registry = TaskRegistry()
    registry.register(TaskSpec(**{**TASKS.get("text").__dict__, "fallback": None}))
    rows = materialize(table(spark, 220), f"{new_run_dir(spark)}/rows")
    store = ProgressStore(new_run_dir(spark) + "/progress", range_batches=2)
    opts = dict(max_retries=1, variations=1)
    run_task(rows, "text", registry, LadderOptions(factory=factory(120), **opts), store, batches_per_wave=3)
    task = registry.get("text")
    fingerprint = store.fingerprint(rows, ["row_id", *task.inputs, "text"])
    assert store.finished_parts(spark, "text", fingerprint) == {0, 1}
    # a value saved again after its range was compacted is the newer one
    again = store.snapshot(spark, task, fingerprint, {0})
    assert again.count() == 60 and all("/whole/part=0/" in f for f in again.inputFiles())
    left = store.snapshot(spark, task, fingerprint, store.parts(spark, "text", fingerprint, "open"))
    assert left.count() == 0 and not any("/whole/" in f for f in left.inputFiles())
    for f in tmp_path.iterdir():
        f.unlink()
    done = run_task(rows, "text", registry, LadderOptions(factory=factory(10**9), **opts), store, batches_per_wave=3)
    assert {r.row_id: r.text for r in done.collect()} == {i: f"text of row {i}" for i in range(220)}
    assert len(list(tmp_path.iterdir())) == 4 and store.finished_parts(spark, "text", fingerprint) == {0, 1, 2, 3}
    late = spark.createDataFrame([(7, 1, "late value", "k", 2**60)], "row_id long, phase int, text string, keywords string, saved_us long")
    store.append_values(late, "text", fingerprint, 30)
    assert store.finished_parts(spark, "text", fingerprint) == {1, 2, 3}
    found = {r.row_id: r.text for r in store.snapshot(spark, task, fingerprint).collect()}
    assert len(found) == 220 and found[7] == "late value" and found[8] == "text of row 8"


def test_waves_are_written_once(spark):
    """No wave joins the saved values again, and each reads its own folder."""
    from evenweave.plans.enrich import _parts

    rows = table(spark, 200)
    saved = spark.range(40).select(F.col("id").alias("row_id"), F.lit(1).alias("phase"), F.lit("saved").alias("text"))
    work = A.apply_fills(rows, saved, ["text"])
    waves = [(0, 2), (2, 4), (4, 6), (6, 7)]
    parts = list(_parts(work, waves, 30))
    assert [sorted(r.row_id for r in p.collect()) for p in parts] == [list(range(a * 30, min(b * 30, 200))) for a, b in waves]
    for p in parts:
        plan = p._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "PartitionFilters: [isnotnull(_wave" in plan
    many = [(k, k + 1) for k in range(100)]
    counted = [p.count() for p in list(_parts(rows, [(a * 1, b) for a, b in many], 2))]
    assert counted == [2] * 100


def test_gaps_and_batches(spark):
    df = spark.range(70).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "long enough").otherwise("").alias("text")
    )
    b = A.add_batches(df)
    assert b.agg(F.max("batch_id"), F.max("pos")).first()[:] == (2, 29)
    gaps = A.micro_batches(A.find_gaps(b, "text", 8))
    assert gaps.count() == 46 and gaps.where("batch_id = 1").agg(F.max("gap"), F.max("chunk")).first()[:] == (19, 3)
    status_row = A.fill_status(df, "text", 8).first()
    assert (status_row.filled, status_row.total, status_row.complete) == (24, 70, False)
    assert A.fill_status(df, "nope", 8).first().filled == 0
    full = b.withColumn("text", F.when(F.col("batch_id") == 1, "long enough").otherwise(F.col("text")))
    assert sorted(r[0] for r in A.unfinished_batches(full, "text", 8).collect()) == [0, 2]


def test_fallbacks(spark):
    df = spark.createDataFrame(
        [("Food", "Pizza", "Joy", "Positive", "Red"), ("Tech", "Phone", "Joy", "Negative", "None"), ("", "Pen", "Hope", "x", None)],
        "theme string, object_detected string, emotion string, sentiment string, dominant_colour string",
    )
    text = TASKS.get("text").fallback()
    img = TASKS.get("img_desc").fallback()
    aud = TASKS.get("audience").fallback()
    rows = df.select(*[c.alias(n) for f in (text, img, aud) for n, c in f.items()]).collect()
    assert rows[0][:] == (
        "Experience pure happiness with our amazing Pizza", "Pizza Food joy",
        '"pizza" red food bright natural lighting professional photography high resolution', "Food enthusiasts",
    )
    assert rows[1].text == "Discover the perfect Phone for your Tech needs"
    assert rows[1].img_desc == '"phone" tech bright natural lighting professional photography high resolution'
    assert rows[1].target_audience == "General consumers"
    assert rows[2].img_desc == '"pen" professional photography high resolution'
    assert TASKS.get("cta").fallback() is None


def test_dedup_keeps_first(spark):
    rows = [(r, r // 3, r % 3, v) for r, v in enumerate(["aa", "bb", "aa", "cc", "dd", "bb", "cc", "ee"])]
    df = spark.createDataFrame(rows, "row_id long, batch_id long, pos int, text string")
    used = A.existing_values(spark.createDataFrame([("dd",)], "text string"), "text", 1)
    kept = A.deduplicate(df, "text", "row_id", used)
    assert sorted(r.row_id for r in kept.collect()) == [0, 1, 3, 7]


def table(spark, n):
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.lit("Food").alias("theme"), F.format_string("obj%d", F.col("id")).alias("object_detected"),
        F.lit("Joy").alias("emotion"), F.lit("Positive").alias("sentiment"), F.lit("").alias("text"), F.lit("").alias("keywords"),
    )


def make_answer():
    """Batches by id of their first row mod 4: answered, cut short, broken, refused. Chunks of five are
    refused if their first id is divisible by 5 and not by 10, single rows unless divisible by 3."""

    def answer(prompt, system, temperature):
        single = re.search(r"^Object: obj(\d+)$", prompt, re.M)
        if single:
            i = int(single.group(1))
            if i % 3 == 0 and temperature > 0.9:
                return '{"text":"single text %d","keywords":"k"}' % i
            return None if i % 2 else '{"text":"no"}'
        ids = [int(x) for x in re.findall(r"Object:obj(\d+) ", prompt)]
        items = [{"id": k + 1, "text": f"text of row {i}", "keywords": f"k{i}"} for k, i in enumerate(ids)]
        if len(ids) == 5:
            return None if ids[0] % 10 == 5 else json.dumps(items)
        kind = ids[0] // 30 % 4
        if len(ids) == 30 and kind == 1:
            return json.dumps(items[:20])
        if kind == 2:
            return "sorry, nothing"
        if kind == 3:
            raise RuntimeError("refused")
        return json.dumps(items)

    return answer


def test_ladder(spark):
    df = table(spark, 130).withColumn("text", F.when(F.col("row_id") == 4, "kept as it is").otherwise(""))
    run = run_ladder(df, TASKS.get("text"), LadderOptions(factory=make_answer))
    out = {r.row_id: r for r in run.table.collect()}
    phase = {r.row_id: r.phase for r in run.fills.collect()}
    assert run.table.columns == df.columns and len(out) == 130
    assert out[4].text == "kept as it is" and out[4].keywords == "" and 4 not in phase
    for i in range(130):
        if i == 4:
            continue
        if i < 30 or 120 <= i:
            want = 1
        elif i < 60:
            want = 1 if i < 50 else 2
        elif (i - i % 5) % 10 == 0:
            want = 3
        else:
            want = 4 if i % 3 == 0 else 5
        assert phase[i] == want, i
        texts = {1: f"text of row {i}", 2: f"text of row {i}", 3: f"text of row {i}", 4: f"single text {i}"}
        assert out[i].text == texts.get(want, f"Experience pure happiness with our amazing obj{i}")
    log = run.responses
    labels = {r.label for r in log.collect()}
    assert {"b001_p1_a1", "b003_p1_a3", "b002_p2_a1", "b003_p3m1_a3", "b003_p4s5_v0", "b003_p4s9_v2"} <= labels
    assert "b001_p1_a2" not in labels and "b003_p4s9_v3" not in labels and "b003_p4s5_v5" in labels
    # Phase 1: 5 batches, 2 of them three times. Phase 2: 1 + 2 x 3. Phase 3: 12 chunks, half thrice.
    counts = {r.phase: r["count"] for r in log.groupBy("phase").count().collect()}
    assert (counts[1], counts[2], counts[3]) == (9, 7, 24)
    assert {r.phase: r.rows for r in phase_report(run).collect()}[2] == 10


def test_secondary_and_no_fallback(spark):
    refuse = lambda: (lambda p, s, t: None)
    opts = LadderOptions(factory=refuse, secondary=make_answer)
    run = run_ladder(table(spark, 30), TASKS.get("text"), opts)
    assert {r.phase for r in run.fills.collect()} == {1}
    gaps = table(spark, 7).withColumn("monetary_mention", F.lit(None).cast("string"))
    run = run_ladder(gaps, TASKS.get("cta"), LadderOptions(factory=refuse, max_retries=1, variations=1))
    assert run.fills.isEmpty() and run.table.count() == 7
    assert run.table.columns[-2:] == ["monetary_mention", "call_to_action"]
    left = run_ladder(table(spark, 3), TASKS.get("headline"), LadderOptions(factory=refuse))
    assert left.table.columns[-2:] == ["headline", "subheadline"]
    assert not is_task_complete(left.table, TASKS.get("headline"))


def test_ladder_on_an_empty_table(spark):
    for task in ("text", "headline"):
        run = run_ladder(table(spark, 0), TASKS.get(task), LadderOptions(factory=make_answer))
        assert run.table.isEmpty() and run.fills.isEmpty()
    full = table(spark, 40).withColumn("text", F.lit("all of them are filled"))
    assert run_ladder(full, TASKS.get("text"), LadderOptions(factory=make_answer)).fills.isEmpty()


def test_single_prompts_only(spark):
    """Without a batch prompt every gap is asked for by itself; filled rows are left alone."""
    task = TaskSpec(**{**TASKS.get("text").__dict__, "name": "single", "batch_prompt": None, "line": None})
    df = table(spark, 12).withColumn("text", F.when(F.col("row_id") == 6, "kept as it is").otherwise(""))
    run = run_ladder(df, task, LadderOptions(factory=make_answer))
    got = {r.row_id: r.phase for r in run.fills.collect()}
    assert got == {i: 4 if i % 3 == 0 else 5 for i in range(12) if i != 6}
    assert {r.phase for r in run.responses.collect()} == {4}


def dup_answer():
    def answer(prompt, system, temperature):
        ids = [int(x) for x in re.findall(r"Object:obj(\d+) ", prompt)]
        if not ids:
            return None
        return json.dumps([{"text": f"value number {i % 40}", "keywords": "k"} for i in ids])

    return answer


def test_ladder_with_dedup(spark):
    task = TaskSpec(**{**TASKS.get("text").__dict__, "name": "unique", "deduplicate": True, "fallback": None})
    df = table(spark, 90).withColumn("text", F.when(F.col("row_id") == 89, "value number 3").otherwise(""))
    run = run_ladder(df, task, LadderOptions(factory=dup_answer, max_retries=1, variations=1))
    filled = run.table.where(is_filled("text", 8))
    texts = [r.text for r in filled.collect()]
    assert len(texts) == len(set(texts)) == 40
    assert {r.row_id for r in filled.collect()} == {*range(3), *range(4, 40), 89}


def test_run_task_saves_and_resumes(spark, tmp_path):
    store = ProgressStore(str(tmp_path / "progress"), model="stub")
    df, task = table(spark, 100), TASKS.get("text")
    columns = ["row_id", *task.inputs, "text"]
    fp = store.fingerprint(df, columns)
    assert store.load("text", fp, spark) is None
    assert run_task(df, "nope", TASKS, LadderOptions(factory=make_answer), store) is None
    full = run_task(df, "text", TASKS, LadderOptions(factory=make_answer), store, batches_per_wave=2)
    assert is_task_complete(full, task) and full.count() == 100
    ledger = read_ledger(spark, store.ledger_path)
    assert sorted((r.completed_batches, r.total_batches, r.completed_rows) for r in ledger.collect()) == [
        (2, 4, 60), (4, 4, 100),
    ]
    assert store.load("text", fp, spark) is None  # complete
    logged = {r.label for r in spark.read.parquet(store.response_path("text")).collect()}
    assert "b001_p1_a1" in logged and "b004_p1_a1" not in logged  # refused calls leave no response

    # A run that stopped after the first wave: only the rest is generated on resume.
    other = df.withColumn("theme", F.lit("Tech"))
    fp2 = store.fingerprint(other, columns)
    assert fp2 != fp
    store.reset(spark, task, fp2)
    first = run_ladder(other.where("row_id < 60"), task, LadderOptions(factory=make_answer))
    store.save(first.fills, task, fp2, 2, 4, 60, 100, 30)
    assert store.load("text", fp2, spark)["completed_batches"] == 2
    assert store.load("text", fp, spark) is None and store.load("cta", fp2, spark) is None
    refuse_low = lambda: (
        lambda p, s, t: None if re.search(r"obj[0-5]?\d[ \n]", p) else make_answer()(p, s, t)
    )
    again = run_task(other, "text", TASKS, LadderOptions(factory=refuse_low), store)
    rows = {r.row_id: r.text for r in again.collect()}
    assert rows[0] == "text of row 0" and is_task_complete(again, task)
    now = {r.task_name: (r.completed_batches, r.pct, r.bar) for r in status(read_ledger(spark, store.ledger_path)).collect()}
    assert now == {"text": (4, 100.0, 40)}


def test_ledger_skips_corrupt_records(spark, tmp_path):
    path = tmp_path / "ledger"
    path.mkdir()
    good = {"task_name": "t", "completed_batches": 1, "total_batches": 2, "completed_rows": 5, "total_rows": 0,
            "last_saved": "2024-01-01 00:00:00"}
    (path / "a.json").write_text(json.dumps(good) + "\n{broken\n")
    got = status(read_ledger(spark, str(path))).collect()
    assert [(r.task_name, r.pct) for r in got] == [("t", 0.0)]


def full_answer():
    def answer(prompt, system, temperature):
        n = len(re.findall(r"^\d+\. ", prompt, re.M))
        key = re.search(r'\{"id":1,"(\w+)":', prompt).group(1)
        extra = {"text": "keywords", "monetary_mention": "call_to_action"}.get(key)
        return json.dumps(
            [{key: f"made {key} {k} {hash(prompt) % 9973}", **({extra: "more"} if extra else {})} for k in range(n)]
        )

    return answer


def test_run_tasks(spark):
    spec = ad_spec(cycles=1)
    skeleton = materialize(build_skeleton(spark, spec), new_run_dir(spark) + "/s")
    out, done, skipped, bad = run_tasks(
        skeleton, ["text", "nope", "img_desc", "cta", "audience"], TASKS, LadderOptions(factory=full_answer),
        validate=lambda t: C.validate_dataset(t, spec, V.BANNED_TERMS),
    )
    # Money and audience are drawn with the skeleton, so these tasks have nothing to do.
    assert done == ["text", "img_desc"] and skipped == ["cta", "audience"]
    assert out.columns == [*skeleton.columns, "img_desc"] and out.count() == 810
    assert {r.check for r in bad.collect()} <= {"V14"}
