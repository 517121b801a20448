"""Cells kept over waves against the checks that scan the whole table."""

import pytest
from pyspark.sql import functions as F

from evenweave.example import ad_spec
from evenweave.operators import cells, checks
from evenweave.operators.skeleton import build_skeleton
from evenweave.session import materialize, new_run_dir


@pytest.fixture(scope="module")
def spec():
    return ad_spec(cycles=1)


@pytest.fixture(scope="module")
def damaged(spark, spec):
    """A skeleton with a wrong label, an unknown value, a null and wrong codes."""
    table = build_skeleton(spark, spec, seed=3).withColumns({
        "emotion": F.when(F.col("row_id") % 97 == 5, "Envy").when(F.col("row_id") % 211 == 7, None).otherwise(F.col("emotion")),
        "sentiment": F.when(F.col("row_id") % 150 == 1, "Negative").otherwise(F.col("sentiment")),
        "theme_num": F.when(F.col("row_id") % 300 == 2, 77).otherwise(F.col("theme_num")),
    })
    return materialize(table, f"{new_run_dir(spark)}/damaged")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def whole(df, spec):
    return rows(checks.verify_skeleton(df, spec).where("check <> 'V12'"))


def test_checks_after_three_waves_equal_the_full_run(spark, spec, damaged):
    store = cells.CellStore(spark, f"{new_run_dir(spark)}/cells", spec)
    for k in range(3):
        store.add(damaged.where(F.col("row_id") % 3 == k))
    want = whole(damaged, spec)
    assert rows(store.violations(spec.total_rows)) == want and {r[0] for r in want} >= {"V4", "V5", "V9", "V13"}
    assert rows(store.compact().violations(spec.total_rows)) == want


def test_rows_that_go_and_change(spark, spec, damaged):
    good = build_skeleton(spark, spec, seed=3)
    store = cells.CellStore(spark, f"{new_run_dir(spark)}/cells", spec)
    store.add(damaged)
    store.remove(damaged.where("row_id >= 500"))
    store.add(good.where("row_id >= 500"))
    store.change(damaged.where("row_id < 500"), good.where("row_id < 500"))
    assert rows(store.violations(spec.total_rows)) == []
    assert store.cells().where("n < 0").count() == 0


def test_reports_derive_from_the_cells(spark, spec, damaged):
    store = cells.CellStore(spark, f"{new_run_dir(spark)}/cells", spec)
    store.add(damaged.where("row_id < 400"))
    store.add(damaged.where("row_id >= 400"))
    got = {(r.column, r.value): r.actual for r in store.marginals().collect()}
    for column in ("theme", "emotion", "sentiment", *spec.quota_values):
        plain = damaged.groupBy(F.coalesce(column, F.lit("(null)")).alias("v")).count().collect()
        assert {v: n for (c, v), n in got.items() if c == column} == {r.v: r["count"] for r in plain}


def test_only_the_new_wave_is_scanned(spark, spec, damaged):
    """Checks read the store's files; adding a wave reads that wave."""
    path = f"{new_run_dir(spark)}/cells"
    store = cells.CellStore(spark, path, spec)
    store.add(damaged)
    files = {f.rsplit("/", 2)[-2] for f in store.violations(spec.total_rows).inputFiles()}
    assert files <= {"cells"}
    assert store.cells().count() < damaged.count() / 4 or store.cells().count() < 700


def test_an_empty_store(spark, spec):
    store = cells.CellStore(spark, f"{new_run_dir(spark)}/cells", spec)
    assert {r.actual for r in store.violations(spec.total_rows).collect()} == {0}
    assert store.marginals().collect() == []
