"""Exact duplicates: 128-bit content hash, one document stays per text, bytes compared inside groups.

Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest id stays; of rows
that repeat that id, one. Null ids come before all others. A bit table of the ids of copies keeps the texts of other
documents, but for a few by chance, from being shuffled; the texts of copies are compared with the text that stays,
spread over salts, so a text that a third of the corpus shares meets in no single task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenweave.llm.common import bit_table, id_and_text, map_texts, maybe_in, md5, rows_that_stay, utf8
from evenweave.session import materialize, new_run_dir

SALTS = 64
FIELDS = "h binary, text_sha256 string, n_bytes int"


def _digests(texts: list[bytes]):
    for t in texts:
        t = t.lower()
        yield md5(t), hashlib.sha256(t).hexdigest(), len(t)


def content_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (128-bit hash of the normalised text), text_sha256, salt (by id, spreads one hash)."""
    keys = map_texts(docs, FIELDS, _digests, id_col, text_col)
    return keys.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    run = new_run_dir(docs.sparkSession)
    keys = materialize(content_keys(docs, id_col, text_col), f"{run}/keys")
    # Two levels: at most SALTS partial rows per text, whatever its number of copies.
    part = keys.groupBy("h", "salt").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    part = materialize(part, f"{run}/partial")
    groups = part.groupBy("h").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    groups = materialize(
        part.select("h", "salt").join(groups.where("group_size > 1"), "h"), f"{run}/groups"
    )

    collided = materialize(_unequal(docs, keys, groups, run, id_col, text_col), f"{run}/collided")
    out = keys.join(groups, ["h", "salt"], "left").select(
        "doc_id", "text_sha256", "h",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
    )
    if not collided.isEmpty():  # hashes that several texts share: these groups are told apart by the longer digest
        out = _regroup(out, collided)
    same = Window.partitionBy("doc_id", "text_sha256").orderBy("doc_id")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(same) == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _unequal(docs: DataFrame, keys: DataFrame, groups: DataFrame, run: str, id_col: str, text_col: str) -> DataFrame:
    """Hashes for which some member's bytes differ from those of the row that stays."""
    texts = id_and_text(docs, id_col, text_col).select(
        F.xxhash64("doc_id").alias("hid"), F.octet_length("text").alias("n_bytes"), "text"
    )
    wanted = keys.join(groups.select("h", "salt", "keep_id"), ["h", "salt"]).groupBy(
        F.xxhash64("doc_id").alias("hid"), "n_bytes", "h", "salt"
    ).agg(F.max(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("keeper"))
    wanted = materialize(wanted, f"{run}/wanted")
    members = maybe_in(texts, "hid", bit_table(wanted, "hid")).join(wanted, ["hid", "n_bytes"]).select("text", "h", "salt", "keeper")
    members = materialize(members.mapInArrow(_own_text, "text binary, h binary, salt int, keeper boolean"), f"{run}/members")
    keepers = members.where("keeper").groupBy("h").agg(F.min("text").alias("kept_text"))
    spread = materialize(keepers.join(groups.select("h", "salt"), "h"), f"{run}/keepers")
    return members.join(spread, ["h", "salt"]).where(F.col("text") != F.col("kept_text")).select("h").distinct()


def _own_text(batches):
    """Rows whose text has the hash beside it, with the text lower-cased; an id may come with several texts."""
    for batch in batches:
        texts = [t.lower() for t in utf8(batch.column("text"))]
        mine = pa.array([md5(t) == h for t, h in zip(texts, batch.column("h").to_pylist())], pa.bool_())
        columns = [pa.array(texts, pa.binary()), *batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(mine)


def _regroup(out: DataFrame, collided: DataFrame) -> DataFrame:
    hit, rest = out.join(collided, "h", "left_semi"), out.join(collided, "h", "left_anti")
    own = hit.groupBy("h", "text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    hit = hit.select("doc_id", "h", "text_sha256").join(own, ["h", "text_sha256"])
    return rest.unionByName(hit.select(*rest.columns))


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns as they are; of rows alike in id and text, one stays."""
    found = materialize(exact_groups(docs, id_col, text_col), f"{new_run_dir(docs.sparkSession)}/found").select(
        F.xxhash64("doc_id").alias("hid"), F.unhex("text_sha256").alias("digest"), F.col("kept").alias("stays"))
    return rows_that_stay(docs, found, lambda t: hashlib.sha256(t.lower()).digest(), id_col, text_col)
