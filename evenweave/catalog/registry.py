"""Registered queries over the given tables, each with the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_case(column: str, mapping: dict, default: str = "NULL") -> str:
    def lit(v):
        return sql_text(v) if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {column} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


def sql_draw(name: str, row_id: str, n: int, seed: int = 42) -> str:
    """Same integer as ``draw_int``."""
    return f"(('0x' || substr(md5('{seed}:{name}:' || {row_id}), 1, 8))::BIGINT % {n})"


# Whitespace as the text functions see it, for regular expressions and for trim().
SQL_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_strip(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^[{SQL_WS}]+', ''), '[{SQL_WS}]+$', '')"
