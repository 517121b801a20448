"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SCRATCH: list[tempfile.TemporaryDirectory] = []


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A JSON object that repeats a key keeps the last value instead of being rejected.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def reach_workers(spark: SparkSession, folder: str) -> SparkSession:
    """Lets Python workers import from ``folder``, and gives a local session that names no folder for
    intermediate tables one that goes with the process. Clusters name theirs in ``spark.checkpoint.dir``.
    """
    context = spark.sparkContext
    known = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if folder not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (folder, known) if x)
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
            scratch = tempfile.TemporaryDirectory(prefix="evenweave-", ignore_cleanup_errors=True)
            _SCRATCH.append(scratch)
            spark.conf.set("spark.checkpoint.dir", scratch.name)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def drop_run(spark: SparkSession, run_dir: str) -> None:
    """Removes the intermediate tables of a finished run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once, read back: cuts lineage so a lost executor never repeats the work behind it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counting(df: DataFrame, path: str, **conditions: Column) -> tuple[DataFrame, dict[str, int]]:
    """Like ``materialize``, with counts of the rows that meet each condition taken while writing."""
    seen = Observation()
    counts = [F.count_if(c).alias(n) for n, c in conditions.items()]
    return materialize(df.observe(seen, *counts), path), seen.get
