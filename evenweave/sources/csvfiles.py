"""CSV in and out, final saves, and the inventory of saved data sets."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.sources import segments

# Doubled quotes inside quoted cells, line breaks in cells, blanks kept as they are.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
    na_tokens: tuple[str, ...] | list[str] = ("",), line_breaks_in_cells: bool = True,
) -> DataFrame:
    """CSV with header. Text cells equal to one of ``na_tokens`` become null.

    Cells may hold line breaks. With a ``schema`` a file is then read by many tasks, in segments (see ``segments``),
    and the engine's own parser reads the records; columns come in the order of the schema, as they lie in the file. Switch
    ``line_breaks_in_cells`` off for files without line breaks in cells, which saves one pass.

    Pass ``fixed_values.FRAME_NA_TOKENS`` to read the way data-frame libraries do ("None" is null).
    Without ``schema`` the types are inferred, which reads the data twice, and each file in one task if cells may
    hold line breaks.
    """
    if schema is not None and line_breaks_in_cells:
        kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")}
        text = segments.records(spark, path)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)
        df = text.select(F.from_csv("text", ddl, options).alias("r")).select("r.*")
    else:
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", line_breaks_in_cells)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
        df = reader.csv(path)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    tokens = [F.lit(t) for t in na_tokens]
    return df.withColumns({c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in text}) if text else df


def write_table(df: DataFrame, path: str) -> None:
    """CSV with header, one part file per partition."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def save_final(df: DataFrame, base: str, task: str, now: datetime | None = None) -> DataFrame:
    """S3: save as ``dataset_<task>_<rows>rows_<time>.csv``; reports ``(path, rows, columns, size_kb)``.

    The rows are counted while they are written, under a name that no inventory lists; then the folder gets
    its name. A data set of the same name is never replaced.
    """
    spark = df.sparkSession
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    draft = f"{base}/_temp_{uuid.uuid4().hex}"
    seen = Observation("save_final")
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), draft)
    rows = seen.get["rows"]
    path = f"{base}/dataset_{task}_{rows}rows_{stamp}.csv"
    _rename(spark, draft, path)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("bytes"))
    return size.select(
        F.lit(path).alias("path"),
        F.lit(rows).cast("long").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        (F.col("bytes") / 1024).alias("size_kb"),
    )


def _rename(spark: SparkSession, old: str, new: str) -> None:
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        raise FileExistsError(new)
    if not files.rename(source, target):
        raise OSError(f"{old} could not be renamed to {new}")


def _dataset_of(file_path: Column) -> Column:
    """A part file belongs to the ``....csv`` folder it lies in, any other file stands for itself."""
    return F.regexp_replace(file_path, r"(\.csv)/[^/]*$", "$1")


def inventory(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``(path, name, dir, size_kb, rows, modified)`` of the CSV data sets below the folders.

    Files named ``_progress*`` or ``_temp*`` are left out. ``rows`` counts records, so line breaks inside cells do
    not count; every file is counted by many tasks, in segments. Newest first.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .load(list(dict.fromkeys(folders)))
        .select("path", "length", "modificationTime")
        .distinct()
    )
    files = listing.withColumn("dataset", _dataset_of(F.col("path")))
    name = F.element_at(F.split("dataset", "/"), -1)
    files = files.where(~name.startswith("_progress") & ~name.startswith("_temp"))
    sets = files.groupBy("dataset").agg(
        (F.sum("length") / 1024).alias("size_kb"), F.max("modificationTime").alias("modified")
    )
    counted = segments.record_counts(
        spark, list(dict.fromkeys(folders)), recursiveFileLookup="true", pathGlobFilter="*.csv")
    records = counted.groupBy(_dataset_of(F.col("file")).alias("dataset")).agg(F.sum("rows").alias("rows"))
    out = sets.join(records, "dataset", "left")
    return out.select(
        F.col("dataset").alias("path"),
        F.element_at(F.split("dataset", "/"), -1).alias("name"),
        F.regexp_replace("dataset", r"/[^/]*$", "").alias("dir"),
        "size_kb",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        "modified",
    ).orderBy(F.col("modified").desc_nulls_last(), "path")


def newest(inv: DataFrame, n: int = 15) -> DataFrame:
    """The newest entries of an inventory."""
    return inv.orderBy(F.col("modified").desc_nulls_last(), "path").limit(n)


def latest_dataset(inv: DataFrame, leave_out: str = "skeleton") -> DataFrame:
    """The newest entry whose name lacks ``leave_out``; empty if there is none."""
    named = inv.where(~F.lower("name").contains(leave_out))
    return named.orderBy(F.col("modified").desc_nulls_last(), "path").limit(1)
