"""A bit table of fixed size: tells keys that are surely not in a set, however large the set is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def _bit(key: Column) -> Column:
    """The highest bits of a 64-bit hash."""
    return F.shiftrightunsigned(key, 64 - BITS)


def bit_table(keys: DataFrame, key: Column) -> DataFrame:
    """word, bits: the 64-bit hashes ``key`` as at most 2^BITS bits, so at most 2^(BITS - 6) rows. Combined map-side."""
    at = keys.select(_bit(key).alias("at"))
    rows = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    return rows.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def maybe_in(rows: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """``rows`` without those whose hash ``key`` is surely not in the table; a few others stay by chance."""
    met = rows.withColumn("_at", _bit(key)).join(F.broadcast(bits), F.shiftright("_at", 6) == F.col("word"))
    return met.where(F.expr("bits & shiftleft(1L, cast(_at & 63 as int))") != 0).drop("_at", "word", "bits")
