"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from evenweave.catalog import all_queries
from oracle import compare, duck

OWN = all_queries()
QUERIES = {n: q for n, q in entry.queries().items() if n in OWN}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in OWN}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_registry():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) > 100
    assert not [n for n in QUERIES if n[0] not in "CEKRSVX"]


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "row_id" and len(df.columns) == 25 and df.count() == 1500


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare(con, QUERIES[name](spark, sf_dir), ORACLES[name]) is None
