"""One value, text, request or weight holds a third of all rows: results stay whole, plans stay safe."""

from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.operators import assign as A
from evenweave.operators import checks as C
from evenweave.operators import profile as P
from evenweave.operators.quota import assign_quotas
from evenweave.spec import even_quota
from evenweave.streaming import chunks as K

N = 6000


def hot_rows(spark):
    text = F.when(F.col("id") % 3 == 0, "the text of a third of all rows").otherwise(
        F.concat(F.lit("text "), (F.col("id") % 1500).cast("string"))
    )
    return spark.range(N).select(F.col("id").alias("row_id"), text.alias("text"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deduplication(spark):
    df = hot_rows(spark)
    used = A.existing_values(spark.createDataFrame([("text 1",)], "text string"), "text", 1)
    kept = A.deduplicate(df, "text", "row_id", used)
    want = df.groupBy("text").agg(F.min("row_id").alias("row_id")).where("text <> 'text 1'")
    assert kept.select("row_id").exceptAll(want.select("row_id")).isEmpty()
    assert kept.count() == want.count()
    assert "Window" not in plan(kept) and "CartesianProduct" not in plan(kept)


def test_duplicate_reports(spark):
    df = hot_rows(spark)
    distinct = df.select("text").distinct().count()
    assert P.text_counts(df, "text").first().duplicates == N - distinct
    repeated = df.groupBy("text").count().where("count > 1").count()
    found = {r.check: r.actual for r in C.text_checks(df, "text", ["third of", "nothing"]).collect()}
    assert found == {"V14": repeated, "V16": N // 3}
    # Digests and counts cross the network, whole texts do not.
    text = plan(C.text_checks(df, "text", V.BANNED_TERMS))
    assert text.count("Exchange") == 2 and "Window" not in text


def test_hot_request(spark):
    chunks = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("request_id"),
        F.col("id").alias("seq"), F.lit("content").alias("channel"), F.format_string("%04d", "id").alias("delta"),
    )
    got = {r.request_id: r.content for r in K.assemble(chunks, segment_rows=100).collect()}
    assert got[0] == "".join(f"{i:04d}" for i in range(0, N, 3))
    assert sum(len(c) for c in got.values()) == 4 * N


def test_quotas_on_skewed_ids(spark):
    """Ids far apart and clustered: the digests spread them evenly all the same."""
    ids = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.col("id") + 10**12).otherwise(F.col("id")).alias("row_id")
    )
    quota = even_quota(["a", "b", "c", "d", "e", "f", "g"], N)
    got = assign_quotas(ids, "row_id", {"v": quota}).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == dict(quota)
