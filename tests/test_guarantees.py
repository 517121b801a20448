"""What must not happen: lost answers, wrong counts, work that meets in one task, a lost end marker."""

import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from evenweave.operators.quota import assign_quotas
from evenweave.operators.skeleton import expand_by_weight
from evenweave.plans.enrich import LadderOptions, ask_all, run_ladder, run_task
from evenweave.session import new_run_dir
from evenweave.sources.csvfiles import inventory, latest_dataset, save_final
from evenweave.sources.ledger import ProgressStore
from evenweave.spec import TaskRegistry, TaskSpec
from evenweave.streaming.chunks import decode_lines


@pytest.mark.parametrize("counts", [(2, 2), (20, 2), (9, 2)])
def test_quota_must_add_up(spark, counts):
    quota = {"v": [("a", counts[0]), ("b", counts[1])]}
    with pytest.raises(Exception, match="do not add up"):
        assign_quotas(spark.range(10), "id", quota).collect()


def test_quota_that_adds_up(spark):
    rows = assign_quotas(spark.range(10), "id", {"v": [("a", 8), ("b", 2)]}).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in rows} == {"a": 8, "b": 2}


def test_equally_heavy_rows_are_spread(spark):
    rows = spark.range(500).withColumn("w", F.lit(150))
    out = expand_by_weight(rows, "w", "copy", step=50)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 500 * 150 and max(per_task) < 2 * sum(per_task) / 4
    assert out.select("id", "copy").distinct().count() == 500 * 150


def counting_generator(folder, answer):
    """Leaves a file per call; ``answer`` decides from the prompt."""
    def factory():
        def generate(prompt, system, temperature):
            with open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w") as f:
                f.write(str(os.getpid()))
            return answer(prompt)

        return generate

    return factory


def a_task(**kw):
    return TaskSpec(
        name="note", output_columns=["note"], min_length=3, inputs=["row_id"], deduplicate=False,
        line=lambda: F.concat(F.lit("row "), F.col("row_id").cast("string")),
        batch_prompt=lambda n, lines: F.concat(F.lit("fill"), F.lit(chr(10)), lines), **kw,
    )


def test_calls_are_spread_over_tasks(spark, tmp_path):
    options = LadderOptions(factory=counting_generator(tmp_path, lambda p: None))
    requests = spark.range(0, 1000, 1, 1).select(
        F.col("id").alias("batch_id"), F.lit(0).alias("chunk"), F.lit(0).alias("pos"), F.lit("x").alias("prompt"))
    asked = ask_all(requests, 1000, options, "", 0.5)
    tasks = asked.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) > 8 and max(r["count"] for r in tasks) < 160


def test_second_run_asks_only_for_open_batches(spark, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()

    def answer(prompt):
        return '[{"note": "good"}, {"note": "fine"}]' if "row 0" in prompt or "row 2" in prompt else None

    rows = spark.range(10).select(F.col("id").alias("row_id"), F.lit("").alias("note"))
    registry = TaskRegistry()
    registry.register(a_task())
    store = ProgressStore(new_run_dir(spark) + "/progress")
    options = dict(max_retries=1, batch_rows=2, micro_rows=2, variations=1)
    out = run_task(rows, "note", registry, LadderOptions(factory=counting_generator(first, answer), **options), store)
    assert out.where("note <> ''").count() == 4
    again = run_task(rows, "note", registry, LadderOptions(factory=counting_generator(second, lambda p: None), **options), store)
    assert again.where("note <> ''").count() == 4  # nothing lost
    calls = len(list(first.iterdir())), len(list(second.iterdir()))
    assert calls[0] == 5 + 3 + 3 and calls[1] == 3 * 3  # batches 0 and 1 are not asked for again


def test_fallback_keeps_other_columns(spark):
    task = TaskSpec(
        name="t", output_columns=["a", "b"], min_length=1, inputs=["row_id"], deduplicate=False,
        fallback=lambda: {"a": F.lit("new")},
    )
    rows = spark.range(5).select(F.col("id").alias("row_id"), F.lit("").alias("a"), F.lit("keep").alias("b"))
    out = run_ladder(rows, task, LadderOptions(factory=counting_generator("/nowhere", None))).table.collect()
    assert {(r["a"], r["b"]) for r in out} == {("new", "keep")}


def test_final_save_names_and_latest(spark):
    base = new_run_dir(spark)
    when = datetime(2024, 5, 6, 7, 8, 9)
    path = save_final(spark.range(3), base, "text", when).first()["path"]
    assert path.endswith("/dataset_text_3rows_20240506_070809.csv")
    with pytest.raises(FileExistsError):
        save_final(spark.range(3), base, "text", when)
    save_final(spark.range(4), base, "skeleton", when)
    assert latest_dataset(inventory(spark, [base])).first()["name"] == "dataset_text_3rows_20240506_070809.csv"


@pytest.mark.parametrize("end", ["[DONE]", "[DONE]\t", "[DONE]\r", " [DONE] "])
def test_end_marker_with_blanks(spark, end):
    lines = spark.createDataFrame([(f"data: {end}",)], "line string")
    assert decode_lines(lines).first()["done"]
