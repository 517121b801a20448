"""Fill-in-the-middle: documents cut at two of their own token borders and put together in another order.

A token is a run of white space with the word behind it, or white space at the end. ``regexp_count`` gives their
number n, the SHA-256 of seed and id gives two borders and the form. One pattern per row then captures prefix, middle
and suffix in a single match: ``((?:unit){a}+)((?:unit){b-a}+)(.*)``. Counted groups are possessive, so the match
runs as a loop without a stack or a way back, however long the text. The replacement of that match is the output.

Texts that are empty or null, that hold a marker, or that the draw leaves alone stay as they are (form ``plain``). A
null id draws like the empty id. Rows that repeat an id draw alike. Only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenweave.llm.common import id_and_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
RATE = 50  # percent of the documents that are rearranged
SUFFIX_FIRST = 80  # percent of those whose suffix comes first
# What a token is, and the same without ways back, for the counted groups.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_POSSESSIVE = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def rearranged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
               suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: doc_id, text, n (tokens), form (plain, psm or spm), output."""
    base = id_and_text(docs, id_col, text_col).withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = base.withColumn("digest", digest).select(
        "doc_id", "text", "n", *(_draw(F.col("digest"), k).alias(f"h{k}") for k in (1, 2, 3, 4)))
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(m))
    form = (
        F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= rate), "plain")
        .when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    )
    cut = drawn.select("doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    pattern = F.format_string(
        rf"(?s)\A((?:{_POSSESSIVE}){{%d}}+)((?:{_POSSESSIVE}){{%d}}+)(.*)\z", F.col("a"), F.col("b") - F.col("a"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return cut.select("doc_id", "text", "n", "form", output.alias("output"))


def parts(output: Column, form: Column) -> Column:
    """prefix, middle and suffix of an output as a struct, null for plain ones; their texts hold no marker."""
    found = F.split(output, "<[PSM]>", -1)
    psm, spm = (1, 3, 2), (2, 3, 1)
    places = {form_name: F.struct(*(found[i].alias(n) for i, n in zip(order, ("prefix", "middle", "suffix"))))
              for form_name, order in (("psm", psm), ("spm", spm))}
    return F.when(form == "psm", places["psm"]).when(form == "spm", places["spm"])


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from."""
    p = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(p["prefix"], p["middle"], p["suffix"]))


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256"""
    p = parts(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form",
        F.length(p["prefix"]).cast("long").alias("prefix_chars"), F.length(p["middle"]).cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
