"""Counts kept up to date: a cell table that grows by waves, from which checks and reports derive.

The cells of a table (see ``checks.observed_cells``) add up: the cells of two parts together are those of the whole, and rows
that go or change are subtracted. So every wave is scanned once, when it comes; the checks read cells only, whose number
depends on the values and not on the rows. Wrong codes (V13) are counted alike. What does not add up - row order (V12) and
texts (V14 to V16) - is left to the checks that scan.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenweave.operators.checks import code_mismatches, judge_cells, observed_cells, skip_cells_of_failed_items
from evenweave.spec import BalanceSpec

SCHEMA = "part string, g string, i string, l string, t string, m string, value string, n long"
_KEYS = ["part", "g", "i", "l", "t", "m", "value"]
CODES = "wrong code"
STRICT = ["V2", "V4", "V5", "V6", "V7", "V8", "V9", "V10", "V11"]


def cells_of(df: DataFrame, spec: BalanceSpec) -> DataFrame:
    """Cells of the rows of ``df``, and per coded column the number of rows with a wrong code."""
    coded = {c: m for c, m in spec.codes.items() if f"{c}_num" in df.columns}
    if not coded:
        return observed_cells(df, spec)
    wrong = code_mismatches(df, coded)
    none = F.lit(None).cast("string")
    codes = wrong.select(F.lit(CODES).alias("part"), *(none.alias(k) for k in _KEYS[1:-1]), F.col("column").alias("value"), "n")
    return observed_cells(df, spec).unionByName(codes)


def add_up(tables: list[DataFrame]) -> DataFrame:
    """One cell table from several; cells that come to nothing are left out."""
    merged = reduce(DataFrame.unionByName, tables).groupBy(*_KEYS).agg(F.sum("n").alias("n"))
    return merged.where("n <> 0").select(*_KEYS, "n")


def negative(cells: DataFrame) -> DataFrame:
    return cells.withColumn("n", -F.col("n"))


class CellStore:
    """Cell tables of all waves below one shared folder; each change is one folder that appears when it is complete."""

    def __init__(self, spark: SparkSession, path: str, spec: BalanceSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self._append(spark.createDataFrame([], SCHEMA))

    def _append(self, cells: DataFrame) -> None:
        cells.select(*_KEYS, F.col("n").cast("long").alias("n")).coalesce(1).write.mode("append").parquet(self.path)

    def add(self, wave: DataFrame) -> None:
        """Counts new rows: one scan of them, none of the others."""
        self._append(cells_of(wave, self.spec))

    def remove(self, rows: DataFrame) -> None:
        """Subtracts rows that were counted before."""
        self._append(negative(cells_of(rows, self.spec)))

    def change(self, before: DataFrame, after: DataFrame) -> None:
        """Rows as they were counted and as they are now, in one step."""
        self._append(add_up([negative(cells_of(before, self.spec)), cells_of(after, self.spec)]))

    def cells(self) -> DataFrame:
        return add_up([self.spark.read.schema(SCHEMA).parquet(self.path)])

    def compact(self) -> CellStore:
        """The same cells as one folder of their own, for stores of very many waves."""
        folder, name = self.path.rsplit("/", 1)
        other = CellStore(self.spark, f"{folder}/{name}-{uuid.uuid4().hex}", self.spec)
        other._append(self.cells())
        return other

    def violations(self, total_rows: int, quotas=None, strict: bool = True) -> DataFrame:
        """V2, V4 to V11 and V13 of all rows counted so far."""
        cells = self.cells()
        grid = cells.where(F.col("part") != CODES)
        counts = judge_cells(grid, self.spec, STRICT, strict, total_rows, quotas)
        codes = cells.where(F.col("part") == CODES).select(
            F.lit("V13").alias("check"), F.col("value").alias("key"), F.lit(0).cast("long").alias("expected"), F.col("n").alias("actual"))
        return (skip_cells_of_failed_items(counts) if strict else counts).unionByName(codes)

    def marginals(self) -> DataFrame:
        """``(column, value, actual)`` of the grid and quota columns."""
        s = self.spec
        named = {"g": s.group_col, "i": s.item_col, "l": s.label_col, "t": s.tone_col, "m": s.implied_col}
        joint = F.array(*(F.struct(F.lit(c).alias("column"), F.col(k).alias("value")) for k, c in named.items()))
        quota = F.array(F.struct(F.col("part").alias("column"), F.col("value").alias("value")))
        each = self.cells().where(F.col("part") != CODES).select(
            F.explode(F.when(F.col("part") == "joint", joint).otherwise(quota)).alias("c"), "n")
        return each.groupBy("c.column", "c.value").agg(F.sum("n").alias("actual"))
