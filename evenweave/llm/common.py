"""Helpers shared by the corpus operators: words, shingles, Arrow batches, text keys.

Conventions of every operator here: a null text counts as empty, a null id stays a null id, rows that repeat an
id are separate rows, an empty table gives an empty result, and only the named columns are read, so that other
columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BATCH = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: texts can be long, and a batch is the unit of a Python worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(prepare(spark), sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Exactly the two columns, named ``doc_id`` and ``text``; a null text becomes empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def with_id_type(docs: DataFrame, id_col: str, fields: str) -> T.StructType:
    """Result schema: the id in its own type, then ``fields`` as DDL."""
    id_type = docs.select(id_col).schema[0].dataType
    return T.StructType([T.StructField("doc_id", id_type), *T.StructType.fromDDL(fields).fields])


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def map_texts(docs: DataFrame, fields: str, fn: Callable[[list[bytes]], Iterable[tuple]],
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and the values ``fn`` gives for each text (UTF-8) of a batch."""
    schema = with_id_type(docs, id_col, fields)
    kinds = [arrow_type(f.dataType) for f in schema.fields[1:]]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(fn(utf8(batch.column(1))))
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def words(text: bytes) -> list[bytes]:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    return text.split()


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = Hashes()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words; of all words together if they are fewer."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ (out >> _HALF)) * _ODD + hashes[k : k + n]
    out = (out ^ (out >> _HALF)) * _MIX
    return out ^ (out >> _HALF)


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of the ASCII-lower-cased text."""
    return np.unique(windows(word_hashes(words(text.lower())), size))


def remainder(id_column: Column | str, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo; -1 for a null id."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(c.cast("string")) % modulus, F.lit(-1))


def md5(text: bytes) -> bytes:
    return hashlib.md5(text, usedforsecurity=False).digest()


def rows_that_stay(docs: DataFrame, found: DataFrame, digest: Callable[[bytes], bytes], id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs``, all columns, that ``found`` (hid, digest, stays: a row for each) lets stay; of rows alike, one.

    ``hid`` is the hash of the id, ``digest`` that of the text. Only rows whose id a bit table does not rule out - those
    that go or have rows alike, and a few by chance - are shuffled; all others are copied as they are.
    """
    special = found.groupBy("hid", "digest").agg(F.count("*").alias("n"), F.bool_or("stays").alias("stays"))
    special = special.where("n > 1 OR NOT stays").select("hid", "digest", "stays")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).select(
        "row", F.xxhash64(f"row.`{id_col}`").alias("hid"), F.coalesce(f"row.`{text_col}`", F.lit("")).alias("text")
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("digest", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array([digest(t) for t in utf8(batch.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], digests], names=schema.names)

    bits = bit_table(special, "hid")
    met = maybe_in(rows, "hid", bits).mapInArrow(run, schema).join(special, ["hid", "digest"], "left")
    same = Window.partitionBy("hid", "digest").orderBy("hid")
    some = met.where(F.coalesce("stays", F.lit(True))).withColumn("nth", F.row_number().over(same))
    return surely_not_in(rows, "hid", bits).select("row.*").union(some.where("nth = 1").select("row.*"))


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows with the highest counts ``n``: as many whole count classes (64 to a doubling) as fit into ``most`` rows.

    Found from a histogram of the classes, so no task and no driver ever holds more than the result.
    """
    level = F.floor(F.log2(F.col(n).cast("double")) * 64)
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect()  # a few thousand at most
    left, least = most, None
    for r in sorted(sizes, key=lambda r: -r["level"]):
        left -= r["rows"]
        if left < 0:
            break
        least = r["level"]
    return counts.where(level >= F.lit(least)) if least is not None else counts.where(F.lit(False))


# --- a bit table of fixed size: tells keys that are surely not in a set, whatever the size of the set --------------------

BITS = 24


def _bit(key: Column) -> Column:
    """The highest bits of a 64-bit hash."""
    return F.shiftrightunsigned(key, 64 - BITS)


def bit_table(keys: DataFrame, key: str) -> DataFrame:
    """word, bits: the hashes ``key`` of ``keys`` as a set of at most 2^BITS bits, so at most 2^(BITS - 6) rows."""
    at = keys.select(_bit(F.col(key)).alias("at"))
    rows = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    return rows.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def maybe_in(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """``rows`` without those whose hash ``key`` is surely not in the bit table; drops others by chance only."""
    at = _bit(F.col(key))
    met = rows.withColumn("_at", at).join(F.broadcast(bits), F.shiftright("_at", 6) == F.col("word"))
    return met.where(F.expr("bits & shiftleft(1L, cast(_at & 63 as int))") != 0).drop("_at", "word", "bits")


def surely_not_in(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """The rows that ``maybe_in`` leaves out."""
    met = rows.withColumn("_at", _bit(F.col(key))).join(F.broadcast(bits), F.shiftright("_at", 6) == F.col("word"), "left")
    hit = F.expr("bits & shiftleft(1L, cast(_at & 63 as int))") != 0
    return met.where(~F.coalesce(hit, F.lit(False))).drop("_at", "word", "bits")


def bits_as_array(bits: DataFrame) -> np.ndarray:
    """A bit table as an array of words on the driver, 2 MB for 24 bits."""
    table = bits.toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return out


def in_bit_table(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
