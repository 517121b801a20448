"""Registered corpus queries against their SQL, and the pipeline stage by stage against brute force."""

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from evenweave.llm.queries import corpus_oracles, corpus_queries
from oracle import compare, duck
from test_llm_operators import above, base_measures, base_spans, expected_fences, near_groups, quoting, sample_texts, table
from evenweave.llm import fertility, jaccard_join, metric_rounds, packing, units


def test_registry():
    names = list(corpus_queries())
    assert [f"op{n}" for n in range(1, 14)] == sorted((n.split("_")[0] for n in names if n != "pipeline"), key=lambda n: int(n[2:]))
    assert set(names) <= set(entry.queries()) and set(corpus_oracles()) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(corpus_oracles()))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(duck(sf_dir), entry.queries()[name](spark, sf_dir), corpus_oracles()[name]) is None


@pytest.mark.parametrize("name", sorted(set(corpus_queries()) - set(corpus_oracles()) - {"pipeline"}))
def test_query_returns_every_document(spark, sf_dir, name):
    ids = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    got = [r.doc_id for r in entry.queries()[name](spark, sf_dir).select("doc_id").collect()]
    assert set(got) == ids and (name.startswith("op10_") or len(got) == len(ids))


def expected_stages(rows):
    """What each stage leaves of (id, text) rows, without Spark."""
    vocabulary = fertility.pieces(fertility.model_path(None))
    Measures = collections.namedtuple("Measures", [f.split()[0] for f in fertility.FIELDS.split(", ")])
    found = [Measures(*m) for m in fertility.measure([(t or "").encode() for _, t in rows], vocabulary)]
    fences = expected_fences(found)
    verdicts = [r.kept and above(r, fences[r.script]) for r in found]
    assert not any(v and base_measures(t)[-1] for v, (_, t) in zip(verdicts, rows))
    good = [r for r, v in zip(rows, verdicts) if v]
    yield good
    last: dict = {}
    for i, t in good:
        k = t.encode().lower()
        if k not in last or (last[k][0] is None or i is not None and i > last[k][0]):
            last[k] = (i, t)
    unique = list(last.values())
    yield unique
    near = near_groups(unique)
    apart = [r for r, (i, _, low) in zip(unique, near) if i == low]
    yield apart
    yield [(i, redacted(t)) for i, t in apart]


def redacted(text):
    out, at = [], 0
    for start, _, span in base_spans(text):
        kind, _, end = span.split(":")
        if start >= at:
            out.append(f"{text[at:start]}[{kind.upper()}]")
        at = max(at, int(end))
    return "".join(out) + text[at:]


@pytest.mark.parametrize("source", ["sample", "tables"])
def test_pipeline(spark, sf_dir, source):
    if source == "sample":
        docs = table(spark, [r for r in sample_texts() if r[0] not in (21, 22)])
    else:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected_stages(rows)):
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns, name
        got = collections.Counter((r.doc_id, r.text) for r in docs.collect())
        assert got == collections.Counter(want), name
        assert docs.where(F.length("text") != F.col("n_chars")).where("n_chars > 0").count() == 0 or name != "pii"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    ids = units.ids_of(units.model_path(None))
    want = collections.Counter((i, len(ids.encode(t.encode())) // 4 + 1) for i, t in [(r.doc_id, r.text) for r in docs.collect()])
    got = collections.Counter()
    for r in packed:
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == collections.Counter({k: k[1] * n for k, n in want.items()})
    assert max(r.offset + r.length for r in packed) <= packing.LENGTH


def test_near_stage_deals_out_no_texts_that_share_a_passage(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(metric_rounds, "BLOCK", 8)
    seen, rounds = [], jaccard_join.regions_to_compare

    def counted(*args):
        found = rounds(*args)
        seen.append(found[2])
        return found

    monkeypatch.setattr(jaccard_join, "regions_to_compare", counted)
    texts = quoting(31, 60, 320, [[f"q{k}_{j}" for j in range(15)] for k in range(2)])
    docs = table(spark, [*enumerate(texts), (60, texts[0] + " tail")])
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, sf_dir).collect()}
    assert got == set(range(60)) and seen == [{"rounds": 0, "in rounds": 0, "in block pairs": 0}]
