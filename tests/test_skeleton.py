"""Balanced tables: counts, order, determinism, plans, and one broken row per check."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.example import ad_spec
from evenweave.functions.draws import draw_key
from evenweave.operators import checks as C
from evenweave.operators.quota import assign_quotas, hash_rank
from evenweave.operators.skeleton import build_skeleton, expand_by_weight, grid, list_rank
from evenweave.session import materialize, new_run_dir
from evenweave.spec import even_quota, spec_problems

SPEC = ad_spec()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skeleton(spark):
    return materialize(build_skeleton(spark, SPEC), new_run_dir(spark) + "/skeleton")


def test_sizes_and_schema(skeleton):
    assert SPEC.total_rows == 3240 and SPEC.base_unit == 810
    assert skeleton.count() == 3240
    assert skeleton.columns == ["row_id", *V.TABLE_COLUMNS]
    row = skeleton.where("row_id = 0").first()
    assert row.image_path == "sample_0001.jpg" and row.theme == "Food" and row.object_detected == "Pizza"
    assert (row.emotion, row.sentiment, row.text) == ("Joy", "Positive", "")
    last = skeleton.where("row_id = 3239").first()
    assert last.image_path == "sample_3240.jpg" and last.object_detected == "Globe"


def test_skeleton_verifies(skeleton):
    assert C.is_valid(C.verify_skeleton(skeleton, SPEC))


def test_expected_counts(skeleton):
    def counts(c):
        return {r[0]: r[1] for r in skeleton.groupBy(c).count().collect()}

    assert counts("dominant_colour") == {
        "Red": 408, "Black": 408, "Blue": 404, "Green": 404, "White": 404, "Grey": 404,
        "Yellow": 404, "Brown": 404,
    }
    assert set(counts("theme").values()) == {360} and set(counts("object_detected").values()) == {60}
    assert set(counts("target_audience").values()) == {324}
    assert set(counts("attention_score").values()) == {1080}


def test_draw_rules(skeleton):
    positive = skeleton.where("sentiment = 'Positive' and call_to_action = 'None'")
    assert positive.count() == 0
    negative = skeleton.where("sentiment = 'Negative'").groupBy("call_to_action").count().collect()
    share = {r[0]: r[1] / 1080 for r in negative}
    assert 0.64 < share["None"] < 0.76 and len(share) == 11
    money = skeleton.where("monetary_mention = 'None'").count() / 3240
    assert 0.15 < money < 0.22


def test_seed(spark, skeleton):
    again = build_skeleton(spark, SPEC)
    assert again.exceptAll(skeleton).isEmpty() and skeleton.exceptAll(again).isEmpty()
    other = build_skeleton(spark, SPEC, seed=7)
    assert not other.select("row_id", "dominant_colour").exceptAll(
        skeleton.select("row_id", "dominant_colour")
    ).isEmpty()
    assert C.is_valid(C.verify_skeleton(other, SPEC))


def test_quota_equals_plain_window(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    quota = [("a", 0), ("b", 1234), ("c", 0), ("d", 1), ("e", 3765), ("f", 0)]
    got = assign_quotas(df, "row_id", {"v": quota}, digits=2)
    ranked = df.withColumn(
        "rk", F.row_number().over(W.orderBy(draw_key(42, "v", F.col("row_id")), "row_id")) - 1
    )
    want = ranked.select(
        "row_id",
        F.when(F.col("rk") < 1234, "b").when(F.col("rk") < 1235, "d").otherwise("e").alias("v"),
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    ranks = hash_rank(df, "row_id", "v", out="rk", digits=2)
    assert ranks.exceptAll(ranked.withColumn("rk", F.col("rk").cast("bigint"))).isEmpty()


def test_quota_moves_no_rows(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    text = plan(assign_quotas(df, "row_id", {"v": even_quota(["a", "b", "c"], 5000)}))
    main = text.split("Subquery")[0]
    assert "Exchange" not in main.split("Range")[0] or main.index("Range") < main.index("Exchange")
    assert "Python" not in text and "Pandas" not in text


def test_grid_has_no_shuffle(spark):
    assert "Exchange" not in plan(grid(spark, SPEC))
    assert "Exchange" not in plan(grid(spark, ad_spec(1_000_000)))


def test_even_quota():
    assert even_quota(["a", "b", "c"], 8, 2) == [("a", 6), ("b", 6), ("c", 4)]


def test_spec_problems(spark):
    assert spec_problems(spark, SPEC).isEmpty()
    bad = spec_problems(spark, SPEC, total_rows=3241).collect()
    assert [r.rule for r in bad] == ["total_divisible_by_base_unit"]


def test_expand_and_rank(spark):
    df = spark.createDataFrame([("x", 2), ("y", 0), ("z", 1)], "v string, w int")
    assert sorted(r.v for r in expand_by_weight(df, "w").collect()) == ["x", "x", "z"]
    numbered = expand_by_weight(df, "w", "copy").collect()
    assert sorted((r.v, r["copy"]) for r in numbered) == [("x", 0), ("x", 1), ("z", 0)]
    heavy = spark.createDataFrame([("x", 2501), ("y", 3)], "v string, w int")
    counts = expand_by_weight(heavy, "w", "copy", step=100).groupBy("v").agg(
        F.count_distinct("copy").alias("n"), F.max("copy").alias("last")
    )
    assert {r.v: (r.n, r.last) for r in counts.collect()} == {"x": (2501, 2500), "y": (3, 2)}
    ranks = df.select("v", list_rank("v", ["z", "x"]).alias("r")).collect()
    assert {r.v: r.r for r in ranks} == {"x": 1, "y": 99, "z": 0}


def kinds(df):
    return sorted({r.check for r in df.collect()})


def test_mutation_colour(skeleton):
    first = skeleton.where("dominant_colour = 'Red'").agg(F.min("row_id")).first()[0]
    hit = F.col("row_id") == first
    bad = skeleton.withColumn("dominant_colour", F.when(hit, "Blue").otherwise(F.col("dominant_colour")))
    bad = bad.withColumn("dominant_colour_num", F.when(hit, 2).otherwise(F.col("dominant_colour_num")))
    rows = C.verify_skeleton(bad, SPEC).collect()
    assert sorted((r.check, r.key, r.expected, r.actual) for r in rows) == [
        ("V4", "dominant_colour=Blue", 404, 405),
        ("V4", "dominant_colour=Red", 408, 407),
    ]


def test_mutation_unexpected_value(skeleton):
    hit = F.col("row_id") == 5
    bad = skeleton.withColumn("attention_score", F.when(hit, "Huge").otherwise(F.col("attention_score")))
    rows = C.verify_skeleton(bad, SPEC).collect()
    assert ("V4", "attention_score=Huge", 0, 1) in [(r.check, r.key, r.expected, r.actual) for r in rows]
    lenient = C.validate_dataset(bad, SPEC, V.BANNED_TERMS).collect()
    assert not [r for r in lenient if "Huge" in r.key]


def test_mutation_implied_swap(skeleton):
    a = skeleton.where("sentiment = 'Positive'").agg(F.min("row_id")).first()[0]
    b = skeleton.where("sentiment = 'Negative'").agg(F.min("row_id")).first()[0]
    rid = F.col("row_id")
    bad = skeleton.withColumn(
        "trust_safety", F.when(rid == a, "Unsafe").when(rid == b, "Safe").otherwise(F.col("trust_safety"))
    ).withColumn(
        "trust_safety_num", F.when(rid == a, 1).when(rid == b, 0).otherwise(F.col("trust_safety_num"))
    )
    rows = C.verify_skeleton(bad, SPEC).collect()
    assert [(r.check, r.actual) for r in rows] == [("V5", 2)]


def test_mutation_order(skeleton):
    rid = F.col("row_id")
    bad = skeleton.withColumn("row_id", F.when(rid == 0, 3239).when(rid == 3239, 0).otherwise(rid))
    rows = C.verify_skeleton(bad, SPEC).collect()
    assert [(r.check, r.actual) for r in rows] == [("V12", 1)]
    assert rows[0].key == "Food/Pizza/Joy/Positive"


def test_mutation_code(skeleton):
    bad = skeleton.withColumn("theme_num", F.when(F.col("row_id") == 9, 99).otherwise(F.col("theme_num")))
    rows = C.verify_skeleton(bad, SPEC).collect()
    assert [(r.check, r.key, r.actual) for r in rows] == [("V13", "theme", 1)]


def test_mutation_lost_row(skeleton):
    bad = skeleton.where("row_id < 3239")
    assert kinds(C.verify_skeleton(bad, SPEC)) == ["V10", "V11", "V2", "V4", "V7"]
    assert kinds(C.validate_dataset(bad, SPEC, V.BANNED_TERMS)) == ["V10", "V11", "V15", "V2", "V3", "V9"]


def test_forbidden_pair(skeleton):
    hit = F.col("row_id") == 0
    bad = skeleton.withColumn("sentiment", F.when(hit, "Negative").otherwise(F.col("sentiment")))
    assert "V6" in kinds(C.verify_skeleton(bad, SPEC))


def test_missing_column_stops(skeleton):
    rows = C.validate_dataset(skeleton.drop("keywords", "theme"), SPEC, V.BANNED_TERMS).collect()
    assert sorted((r.check, r.key) for r in rows) == [("V1", "keywords"), ("V1", "theme")]


def test_order_check_against_lag(spark):
    labels = ["v"]
    for seed in range(12):
        df = spark.range(40).select(
            F.col("id").alias("row_id"),
            F.when(F.lit(seed) % 3 == 0, F.col("id").cast("int") * 0)
            .otherwise((F.col("id") / 5 + F.pmod(F.hash("id", F.lit(seed)), F.lit(7)) / 4).cast("int"))
            .alias("v"),
        )
        rank = [F.col("v").alias("r")]
        got = C.grouping_order(df, "row_id", rank, labels).collect()
        # rows out of order, ids with gaps, empty tasks: by chunks of ids, with the same result
        mixed = C.grouping_order(df.repartition(5, F.hash("id" if "id" in df.columns else "row_id")), "row_id", rank, labels, chunk_rows=7)
        ranged = df.repartitionByRange(9, "row_id").sortWithinPartitions("row_id")
        assert got == mixed.collect() == C.grouping_order(ranged, "row_id", rank, labels).collect()
        lagged = df.withColumn("p", F.lag("v").over(W.orderBy("row_id"))).where("v < p")
        want = lagged.agg(F.min("row_id")).first()[0]
        assert [r.actual for r in got] == ([] if want is None else [want])


def test_order_runs_shuffle_no_row(spark, skeleton):
    """Every task sums up its rows; only a run a task is merged."""
    from evenweave.operators import order

    rows = skeleton.repartitionByRange(6, "row_id").sortWithinPartitions("row_id")
    runs = order.order_runs(rows, "row_id", C.rank_columns(SPEC), ["theme", "emotion"])
    own = order.order_runs(spark.range(100).withColumnRenamed("id", "row_id"), "row_id", [F.col("row_id")], ["row_id"])
    assert runs.count() <= 6 and "Exchange" not in plan(own)
    whole = order.first_late_row(rows, "row_id", C.rank_columns(SPEC), ["theme", "emotion"])
    n = skeleton.count()
    assert (whole.first, whole.last, whole.late, whole.overlap) == (0, n - 1, None, False)


def test_runs_merge_in_any_grouping(spark):
    import random

    from evenweave.operators.order import Run

    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 12)
        ids = sorted(rng.sample(range(100), n))
        keys = [[rng.randint(0, 3), rng.randint(0, 1)] if rng.random() < 0.4 else [i // 20, 0] for i in ids]
        ones = [Run(i, i, k, k, [str(i)]) for i, k in zip(ids, keys)]
        late = next((ids[j] for j in range(1, n) if keys[j] < keys[j - 1]), None)
        while len(ones) > 1:
            j = rng.randrange(len(ones) - 1)
            ones[j : j + 2] = [ones[j].then(ones[j + 1])]
        assert (ones[0].first, ones[0].last, ones[0].late) == (ids[0], ids[-1], late)
        assert not ones[0].overlap and (late is None or ones[0].late_labels == [str(late)])
    assert ones[0].then(Run(0, 0, [0, 0], [0, 0], [None])).overlap

