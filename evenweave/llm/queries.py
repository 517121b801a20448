"""The queries ``opN_<name>``: each operator over its whole table, reduced to the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenweave.llm import (
    brown_lm, exact_dedup, fertility, fill_in_middle, jaccard_join, merkle, packing, pieces, pii, repeats, rules, token_counts,
    toxicity,
)
from evenweave.llm.common import documents, table
from evenweave.llm.registry import ORACLES, QUERIES, query
from evenweave.llm.sql import OP6_SQL, OP11_SQL, OP12_SQL, op1_sql


@query("op1_pii", op1_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(documents(spark, sf_dir)))


@query("op2_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


@query("op4_brown_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.brown_scores(documents(spark, sf_dir))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_rules(documents(spark, sf_dir))


@query("op6_exact_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query("op8_quality_rules_ensemble")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return rules.score(docs, rules.learn(docs, table(spark, sf_dir, "labels")))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(documents(spark, sf_dir))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(documents(spark, sf_dir))


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.rearranged(documents(spark, sf_dir)))


@query("op13_suffix_repeats")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir))


def corpus_queries() -> dict:
    """All queries of this subpackage, the pipeline among them."""
    import corpus_pipeline  # noqa: F401  registers itself

    return dict(QUERIES)


def corpus_oracles() -> dict:
    corpus_queries()
    return dict(ORACLES)
