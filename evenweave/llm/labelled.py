"""A bounded sample of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenweave.llm.common import id_and_text, remainder

SAMPLE = 12_000
_PLACES = 1 << 30


def sample_of(docs: DataFrame, labels: DataFrame, target: str, most: int = SAMPLE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id, text, y of at most ``most`` labelled documents whose fold is not held out.

    The sample is the lowest hashes of the ids, so it is the same in every run; an id that is labelled more than once
    counts with its largest label, and of several texts of an id the one of the least hash is taken. Only the sample's ids are
    sent to the tasks, and that is at most ``most`` rows.
    """
    usable = labels.where(F.col(target).isNotNull() & (remainder("doc_id") > 0))
    usable = usable.groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES))
    n = usable.count()
    if n > most:  # leave out what cannot be among the lowest, so that few rows are sorted
        usable = usable.where(place < -(-_PLACES * most * 5 // (n * 4)))
    some = usable.orderBy(place, "doc_id").limit(most)
    texts = id_and_text(docs, id_col, text_col)
    met = texts.join(F.broadcast(some), "doc_id")
    least = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.sha2("text", 256)))
    return met.withColumn("_nth", least).where("_nth = 1").drop("_nth")
