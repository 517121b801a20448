"""Term lists and quotas of any size against plain versions."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenweave.operators import checks, quota, terms


def texts_and_terms(n, words):
    r = random.Random(n)
    vocabulary = ["".join(r.choice("abcdeéß ") for _ in range(r.randrange(3, 9))) for _ in range(words)]
    texts = [None, "", "PINEAPPLE pie", "İstanbul STRASSE"] + [" ".join(r.choice(vocabulary) for _ in range(12)) for _ in range(n)]
    return texts, [*vocabulary[:: max(1, words // 40)], "apple", "STRASSE", "", "apple"]


@pytest.mark.parametrize("most", [16_000_000, 60])
def test_flag_terms(spark, monkeypatch, most):
    """One group of terms or several; columns of any name stay."""
    monkeypatch.setattr(terms, "MOST_CHARACTERS", most)
    texts, listed = texts_and_terms(200, 300)
    df = spark.createDataFrame([(t, i, "x") for i, t in enumerate(texts)], "text string, row long, hit string")
    found = terms.flag_terms(df, "text", spark.createDataFrame([(t,) for t in listed], "name string"), "name")
    assert found.columns == ["text", "row", "hit", "banned"]
    low = {t.lower() for t in listed if t}
    lower = {r.row: r.l for r in df.select("row", F.lower("text").alias("l")).collect()}
    for r in found.collect():
        assert r.banned == (lower[r.row] is not None and any(t in lower[r.row] for t in low)), r
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString() or most == 60


def test_no_terms_and_no_texts(spark):
    none = spark.createDataFrame([], "name string")
    df = spark.createDataFrame([("apple",), (None,)], "text string")
    assert [r.banned for r in terms.flag_terms(df, "text", none, "name").collect()] == [False, False]
    assert terms.flag_terms(df.limit(0), "text", spark.createDataFrame([("a",)], "name string"), "name").collect() == []
    assert checks.text_rules(df, "text", spark.createDataFrame([("pp",)], "name string")).collect()[-1].actual == 1


def test_one_group_of_terms_in_a_task(spark, monkeypatch):
    """Several groups are passes one after the other: a plan that holds them all keeps all of them in memory."""
    monkeypatch.setattr(terms, "MOST_CHARACTERS", 60)
    texts, listed = texts_and_terms(50, 300)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    names = spark.createDataFrame([(t,) for t in listed], "name string")
    assert len(terms.term_groups(names, "name")) > 2
    found = terms.flag_terms(df, "text", names, "name")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 19])
def test_terms_equal_a_search_per_term(monkeypatch, block):
    """Terms that begin alike or with each other, that end with a text, cross blocks, or are longer than texts; slices."""
    monkeypatch.setattr(terms, "BLOCK", block)
    r = random.Random(block)
    for size in (2, 5, 9, 20):
        listed = [bytes(r.choices(b"ab\0\xc3", k=r.randrange(max(1, size - 8), size + 9))) for _ in range(40)]
        texts = [None, b"", *(bytes(r.choices(b"ab\0\xc3", k=r.randrange(0, 4 * size))) for _ in range(60)), listed[0], b""]
        texts += [b"x" + t[:-1] for t in listed[:20]] + [b"x" + t for t in listed[20:]]
        found = terms.Terms(listed).hits(pa.array([b"ab" * 30, *texts], pa.binary()).slice(1)).tolist()
        assert found == [t is not None and any(x in t for x in listed) for t in texts]


def test_time_hardly_grows_with_the_number_of_terms(spark):
    texts, _ = texts_and_terms(3000, 300)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4).cache()
    df.count()
    seconds = []
    for n in (200, 20_000):
        listed = spark.range(n).select(F.concat(F.lit("no such term "), F.col("id")).alias("name")).cache()
        checks.text_rules(df, "text", listed).collect()
        start = time.time()
        assert [r.check for r in checks.text_rules(df, "text", listed).collect()] == ["V15"]
        seconds.append(time.time() - start)
    assert seconds[1] < 8 * seconds[0] + 2


def test_quota_table_assigns_as_the_list_does(spark):
    rows = spark.range(5000).select((F.col("id") * 3).alias("row_id"), F.lit(1).alias("low"))
    counts = [0, 700, 1, 0, 2299, 1500, 500, 0]
    listed = [(f"v{i}", n) for i, n in enumerate(counts)]
    table = spark.createDataFrame([(i, v, n) for i, (v, n) in enumerate(listed)], "position long, value string, count long")
    want = {r.row_id: r.colour for r in quota.assign_quotas(rows, "row_id", {"colour": listed}).collect()}
    got = quota.assign_quota_table(rows, "row_id", table, "colour")
    assert got.columns == ["row_id", "low", "colour"] and {r.row_id: r.colour for r in got.collect()} == want


def test_quota_ranges_of_many_values(spark):
    table = spark.range(30_000).select(F.col("id").alias("position"), F.col("id").alias("value"), (F.col("id") % 4).alias("count"))
    found = quota.quota_ranges(table, "position", "count", block=1000).orderBy("position").collect()
    at = 0
    for r in found:
        assert (r.low, r.high) == (at, at + r["count"])
        at = r.high


def test_quota_table_must_add_up(spark):
    rows = spark.range(100).withColumnRenamed("id", "row_id")
    for n in (0, 99, 101):
        table = spark.createDataFrame([(0, "a", n)], "position long, value string, count long")
        with pytest.raises(Exception, match="do not add up"):
            quota.assign_quota_table(rows, "row_id", table, "colour").collect()


def test_quota_table_joins_by_equality(spark):
    table = spark.range(2000).select(F.col("id").alias("position"), F.col("id").alias("value"), F.lit(5).alias("count"))
    rows = spark.range(10_000).withColumnRenamed("id", "row_id")
    plan = quota.assign_quota_table(rows, "row_id", table, "part")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
