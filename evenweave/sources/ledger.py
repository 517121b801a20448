"""Progress: an append-only ledger, saved values per wave, and the response log."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.functions.text import is_filled
from evenweave.spec import TaskSpec

LEDGER_SCHEMA = (
    "task_name string, completed_batches int, total_batches int, completed_rows long, total_rows long, "
    "batch_size int, model string, profile string, last_saved string, primary_column string, "
    "dataset_fingerprint string, saved_us long"
)


def batch_progress(df: DataFrame, task: TaskSpec, batch_rows: int = 30) -> DataFrame:
    """The counts of a ledger record from a table with dense ``row_id``.

    A batch counts as completed when none of its rows is a gap.
    """
    batch = F.call_function("div", F.col("row_id").cast("long"), F.lit(batch_rows).cast("long"))
    filled = is_filled(task.primary_column, task.min_length)
    per_batch = df.groupBy(batch.alias("batch_id")).agg(
        F.count_if(filled).alias("filled"), F.count(F.lit(1)).alias("rows")
    )
    return per_batch.agg(
        F.count_if(F.col("filled") == F.col("rows")).cast("int").alias("completed_batches"),
        F.count(F.lit(1)).cast("int").alias("total_batches"),
        F.sum("filled").alias("completed_rows"),
        F.sum("rows").alias("total_rows"),
    ).select(
        F.lit(task.name).alias("task_name"),
        "*",
        F.lit(batch_rows).alias("batch_size"),
        F.lit(task.primary_column).alias("primary_column"),
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All readable records; corrupt lines are left out."""
    schema = T.StructType.fromDDL(LEDGER_SCHEMA).add("_corrupt_record", T.StringType())
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return raw.where(F.col("_corrupt_record").isNull() & F.col("task_name").isNotNull()).drop(
        "_corrupt_record"
    )


def latest_records(ledger: DataFrame, keys: tuple[str, ...] = ("task_name",)) -> DataFrame:
    """Newest record per key, combined map-side."""
    rest = [c for c in ledger.columns if c not in keys]
    order = F.struct("last_saved", "saved_us", "completed_batches")
    newest = ledger.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def resumable(ledger: DataFrame) -> DataFrame:
    """Records a run can resume from: batches or rows are open, with a snapshot (checked by the store)."""
    zero = F.lit(0)
    return ledger.where(
        (F.coalesce("completed_batches", zero) < F.coalesce("total_batches", zero))
        | (F.coalesce("completed_rows", zero) < F.coalesce("total_rows", zero))
    )


def status(ledger: DataFrame) -> DataFrame:
    """Newest record per task with percent of rows filled and the bar length out of 40."""
    pct = F.when(F.col("total_rows") > 0, F.col("completed_rows") * 100.0 / F.col("total_rows")).otherwise(0.0)
    return latest_records(ledger).select(
        "task_name", "completed_batches", "total_batches", "completed_rows", "total_rows",
        pct.alias("pct"), F.floor(pct * 40 / 100).cast("int").alias("bar"), "model", "last_saved",
    )


class ProgressStore:
    """Ledger and snapshots below one shared folder. Keyed by task and by the data set itself.

    A snapshot lies in ranges of ``range_batches`` batches, a folder each. Waves append to the ``open`` folders. A range
    whose rows are all filled is compacted: its newest values go to a ``whole`` folder, one row each, and its open folder
    goes. So a run that resumes reads the open ranges only.
    """

    def __init__(self, path: str, model: str = "", profile: str = "", range_batches: int = 1000):
        self.path, self.model, self.profile, self.range_batches = path.rstrip("/"), model, profile, range_batches

    @property
    def ledger_path(self) -> str:
        return f"{self.path}/ledger"

    def response_path(self, task: str) -> str:
        return f"{self.path}/responses/task={task}"

    def _snapshot_path(self, task: str, fingerprint: str) -> str:
        return f"{self.path}/snapshot/task={task}/data={fingerprint}"

    def fingerprint_parts(self, df: DataFrame, columns: list[str] | None = None) -> list[Column]:
        """The aggregates ``n`` and ``x`` that ``fingerprint_of`` reads, to be taken in a scan with others."""
        present = [c for c in columns if c in df.columns] if columns else df.columns
        return [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*sorted(set(present)))).alias("x")]

    @staticmethod
    def fingerprint_of(row) -> str:
        return f"{row['n']}-{(row['x'] or 0) & 0xFFFFFFFFFFFFFFFF:016x}"

    def fingerprint(self, df: DataFrame, columns: list[str] | None = None) -> str:
        """Order-free digest of the rows: count and xor of the row hashes over the given columns."""
        return self.fingerprint_of(df.agg(*self.fingerprint_parts(df, columns)).first())

    def _snapshot_schema(self, task: TaskSpec) -> str:
        values = "".join(f"`{c}` string, " for c in task.output_columns)
        return f"row_id long, phase int, {values}saved_us long"

    def _append(self, spark: SparkSession, record: dict) -> None:
        names = [f.name for f in T.StructType.fromDDL(LEDGER_SCHEMA).fields]
        row = spark.createDataFrame([tuple(record.get(n) for n in names)], LEDGER_SCHEMA)
        row.coalesce(1).write.mode("append").json(self.ledger_path)

    def _folder(self, spark: SparkSession, path: str):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where

    def reset(self, spark: SparkSession, task: TaskSpec, fingerprint: str) -> None:
        """Start over: earlier saved values of this task and data set are not used again."""
        files, where = self._folder(spark, self._snapshot_path(task.name, fingerprint))
        files.delete(where, True)
        files.mkdirs(where)

    def part_of(self, row_id: Column, batch_rows: int) -> Column:
        """Range of a row."""
        rows = F.lit(batch_rows * self.range_batches).cast("long")
        return F.call_function("div", row_id.cast("long"), rows)

    def append_values(self, values: DataFrame, task: str, fingerprint: str, batch_rows: int) -> None:
        """Adds values (row_id, phase, columns, saved_us) to the open ranges of their rows."""
        path = f"{self._snapshot_path(task, fingerprint)}/open"
        values.withColumn("part", self.part_of(F.col("row_id"), batch_rows)).write.mode("append").partitionBy("part").parquet(path)

    def parts(self, spark: SparkSession, task: str, fingerprint: str, kind: str) -> set[int]:
        """Ranges that have an ``open`` or a ``whole`` folder."""
        files, where = self._folder(spark, f"{self._snapshot_path(task, fingerprint)}/{kind}")
        if not files.exists(where):
            return set()
        names = [f.getPath().getName() for f in files.listStatus(where)]
        return {int(n.removeprefix("part=")) for n in names if n.startswith("part=")}

    def finished_parts(self, spark: SparkSession, task: str, fingerprint: str) -> set[int]:
        """Ranges in which every row has its value."""
        return self.parts(spark, task, fingerprint, "whole") - self.parts(spark, task, fingerprint, "open")

    def compact(self, spark: SparkSession, task: TaskSpec, fingerprint: str, part: int) -> None:
        """The newest values of a range as one folder. If it breaks off, both folders hold the same values."""
        path = self._snapshot_path(task.name, fingerprint)
        draft = f"{path}/_draft-{uuid.uuid4().hex}"
        self.snapshot(spark, task, fingerprint, {part}).coalesce(1).write.parquet(draft)
        files, whole = self._folder(spark, f"{path}/whole/part={part}")
        files.mkdirs(whole.getParent())
        files.delete(whole, True)
        if not files.rename(self._folder(spark, draft)[1], whole):
            raise OSError(f"{draft} could not be renamed")
        files.delete(self._folder(spark, f"{path}/open/part={part}")[1], True)

    def save(
        self, fills: DataFrame, task: TaskSpec, fingerprint: str, completed_batches: int,
        total_batches: int, completed_rows: int, total_rows: int, batch_rows: int,
    ) -> None:
        """Append this wave's values, then a ledger record. Only new values are written."""
        now = time.time_ns() // 1000
        self.append_values(fills.withColumn("saved_us", F.lit(now)), task.name, fingerprint, batch_rows)
        self._append(
            fills.sparkSession,
            {
                "task_name": task.name,
                "completed_batches": completed_batches,
                "total_batches": total_batches,
                "completed_rows": completed_rows,
                "total_rows": total_rows,
                "batch_size": batch_rows,
                "model": self.model,
                "profile": self.profile,
                "last_saved": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
                "primary_column": task.primary_column,
                "dataset_fingerprint": fingerprint,
                "saved_us": now,
            },
        )

    def has_snapshot(self, spark: SparkSession, task: str, fingerprint: str) -> bool:
        files, where = self._folder(spark, self._snapshot_path(task, fingerprint))
        return files.exists(where)

    def load(self, task: str, fingerprint: str, spark: SparkSession | None = None) -> dict | None:
        """Newest record with open batches or rows, or None: no ledger, other task or data set, complete,
        snapshot missing, corrupt."""
        spark = spark or SparkSession.getActiveSession()
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.ledger_path)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        mine = read_ledger(spark, self.ledger_path).where(
            (F.col("task_name") == task) & (F.col("dataset_fingerprint") == fingerprint)
        )
        found = resumable(latest_records(mine)).first()
        if found is None or not self.has_snapshot(spark, task, fingerprint):
            return None
        return found.asDict()

    def snapshot(self, spark: SparkSession, task: TaskSpec, fingerprint: str, parts: set[int] | None = None) -> DataFrame:
        """Saved values, the newest per row; of the given ranges, whose folders alone are read, or of all."""
        path, schema = self._snapshot_path(task.name, fingerprint), self._snapshot_schema(task)
        found = {kind: self.parts(spark, task.name, fingerprint, kind) for kind in ("open", "whole")}
        if parts is not None:
            found = {kind: some & parts for kind, some in found.items()}

        def values(kind: str, some: set[int]) -> DataFrame:
            folders = [f"{path}/{kind}/part={k}" for k in sorted(some)]
            return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

        settled = values("whole", found["whole"] - found["open"])
        saved = values("open", found["open"]).unionByName(values("whole", found["whole"] & found["open"]))
        rest = [c for c in saved.columns if c != "row_id"]
        newest = saved.groupBy("row_id").agg(F.max_by(F.struct(*rest), "saved_us").alias("r"))
        return settled.unionByName(newest.select("row_id", *[F.col(f"r.{c}").alias(c) for c in rest]))


def append_responses(responses: DataFrame, path: str) -> None:
    """Append labelled responses to the log; calls without an answer are not logged."""
    responses.where(F.length("raw") > 0).write.mode("append").partitionBy("phase").parquet(path)
