"""S: CSV round trips, inventory, ledger and response log in a fresh folder of the shared directory."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from evenweave.catalog.registry import query, sql_list, table
from evenweave.fixed_values import FRAME_NA_TOKENS
from evenweave.session import new_run_dir
from evenweave.sources import csvfiles as S
from evenweave.sources import ledger as L
from evenweave.spec import TaskSpec

TEXT_TASK = TaskSpec(name="quality", output_columns=["text"], min_length=300)


def _noted(customers):
    """Customers with a text cell that holds separators, quotes, line breaks and missing-value words."""
    key = F.col("c_custkey") % 5
    note = (
        F.when(key == 0, F.lit("None"))
        .when(key == 1, F.lit(""))
        .when(key == 2, F.concat(F.lit('say "hi", '), F.col("c_name")))
        .when(key == 3, F.concat(F.lit(" two\nlines of "), F.col("c_name")))
        .otherwise(F.lit("N/A"))
    )
    return customers.withColumn("note", note)


_NOTE = """CASE c_custkey % 5 WHEN 0 THEN 'None' WHEN 1 THEN NULL WHEN 2 THEN 'say "hi", ' || c_name
 WHEN 3 THEN ' two' || chr(10) || 'lines of ' || c_name ELSE 'N/A' END"""


def _round_trip(spark, sf_dir, tokens):
    df = _noted(table(spark, sf_dir, "customer"))
    path = new_run_dir(spark) + "/customer.csv"
    S.write_table(df, path)
    return S.read_table(spark, path, df.schema, na_tokens=tokens)


@query("S1_csv_scan", f"""
SELECT customer.*, CASE WHEN c_custkey % 5 IN (0, 4) THEN NULL ELSE {_NOTE} END AS note FROM customer""")
def s1(spark, sf_dir):
    """Cells that data-frame readers take as missing become null."""
    return _round_trip(spark, sf_dir, FRAME_NA_TOKENS)


@query("S2_csv_sink", f"SELECT customer.*, {_NOTE} AS note FROM customer")
def s2(spark, sf_dir):
    return _round_trip(spark, sf_dir, ("",))


FILE_BYTES = 256 << 20


def _in_files(docs):
    """One file, or of many texts several of about ``FILE_BYTES``, as each is written by one task."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES))
    return docs.repartition(files) if files > 1 else docs.coalesce(1)


@query("S1_one_file_by_many_tasks", """
SELECT doc_id, source, lang, n_chars, length(text) AS length, md5(text) AS digest FROM documents""")
def s1_one_file(spark, sf_dir):
    """Texts with line breaks from one file, read in segments; very many texts make several such files."""
    docs = table(spark, sf_dir, "documents")
    path = new_run_dir(spark) + "/documents.csv"
    S.write_table(_in_files(docs), path)
    found = S.read_table(spark, path, docs.schema)
    return found.select(
        "doc_id", "source", "lang", "n_chars", F.length("text").cast("long").alias("length"), F.md5("text").alias("digest"))


@query("S3_final_save", """
SELECT count(*) AS rows, 8 AS columns, 'dataset_text_' || count(*) || 'rows_20240131_120000.csv' AS name, true AS has_size FROM part""")
def s3(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumns({"text": F.lit(""), "keywords": F.lit("")})
    saved = S.save_final(parts, new_run_dir(spark), "text", datetime(2024, 1, 31, 12))
    return saved.select(
        "rows", "columns", F.element_at(F.split("path", "/"), -1).alias("name"), (F.col("size_kb") > 0).alias("has_size"))


def _saved_sets(spark, sf_dir):
    base = new_run_dir(spark)
    for name, target in [
        ("orders", "dataset_orders.csv"), ("customer", "Skeleton_customer.csv"), ("part", "_temp_part.csv"),
        ("supplier", "_progress_supplier.csv"), ("events", "dataset_events.csv"), ("part", "skeleton_part.csv"),
    ]:
        S.write_table(table(spark, sf_dir, name), f"{base}/{target}")
    return S.inventory(spark, [base, base]).withColumn("in_folder", F.col("dir").endswith(base))


@query("S4_inventory", """
SELECT 'dataset_orders.csv' AS name, count(*) AS rows, 3 AS place, true AS in_folder, true AS has_size, true AS has_time FROM orders
UNION ALL SELECT 'Skeleton_customer.csv', count(*), 2, true, true, true FROM customer
UNION ALL SELECT 'dataset_events.csv', count(*), 1, true, true, true FROM events
UNION ALL SELECT 'skeleton_part.csv', count(*), 0, true, true, true FROM part""")
def s4(spark, sf_dir):
    """Newest first, with folder, size (two bytes a record at least) and time."""
    found = _saved_sets(spark, sf_dir)
    newer = F.count("*").over(Window.orderBy(F.desc("modified")).rowsBetween(Window.unboundedPreceding, -1))  # four rows
    return found.select(
        "name", "rows", newer.cast("int").alias("place"), "in_folder", (F.col("size_kb") * 1024 > 2 * F.col("rows")).alias("has_size"),
        (F.col("modified") > F.current_timestamp() - F.expr("interval 1 hour")).alias("has_time"))


@query("S5_newest", """
SELECT 'skeleton_part.csv' AS name, count(*) AS rows FROM part UNION ALL
SELECT 'dataset_events.csv', count(*) FROM events""")
def s5(spark, sf_dir):
    return S.newest(_saved_sets(spark, sf_dir), 2).select("name", "rows")


@query("S6_latest_dataset", "SELECT 'dataset_events.csv' AS name, count(*) AS rows FROM events")
def s6(spark, sf_dir):
    return S.latest_dataset(_saved_sets(spark, sf_dir)).select("name", "rows")


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", "source", "lang")


PROGRESS_SQL = """
SELECT 'quality' AS task_name, CAST(count(*) FILTER (filled = n) AS INTEGER) AS completed_batches,
       CAST(count(*) AS INTEGER) AS total_batches, CAST(sum(filled) AS BIGINT) AS completed_rows,
       CAST(sum(n) AS BIGINT) AS total_rows, 30 AS batch_size, 'text' AS primary_column
FROM (SELECT doc_id // 30 AS b, count(*) AS n, count(*) FILTER (length(trim(text, chr(10) || ' ')) >= 300) AS filled
      FROM documents GROUP BY 1)"""


@query("S7_progress_record", PROGRESS_SQL)
def s7(spark, sf_dir):
    return L.batch_progress(_documents(spark, sf_dir), TEXT_TASK)


def _ledger(spark, sf_dir):
    """Ledger files: one record per source and language, and lines that are no records."""
    docs = table(spark, sf_dir, "documents")
    records = docs.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("completed_rows"), F.max("doc_id").alias("last")
    ).select(
        F.col("source").alias("task_name"),
        F.col("completed_rows").cast("int").alias("completed_batches"),
        (F.col("completed_rows") + F.col("last") % 2).cast("int").alias("total_batches"),
        "completed_rows",
        F.when(F.col("lang") == "es", 0).otherwise(F.col("completed_rows") + 10 * (F.col("last") % 3)).cast("long").alias("total_rows"),
        F.lit(30).alias("batch_size"),
        F.col("lang").alias("model"),
        F.lit("p").alias("profile"),
        F.format_string("2024-01-01 %08d", "last").alias("last_saved"),
        F.lit("text").alias("primary_column"),
        F.lit("d").alias("dataset_fingerprint"),
        F.lit(0).cast("long").alias("saved_us"),
    )
    path = new_run_dir(spark) + "/ledger"
    records.write.json(path)
    docs.select(F.concat(F.lit('{"task_name": "'), F.substring("source", 1, 3)).alias("value")).write.mode(
        "append"
    ).text(path)
    return L.read_ledger(spark, path)


_LEDGER_SQL = """
SELECT source AS task_name, CAST(count(*) AS INTEGER) AS completed_batches,
       CAST(count(*) + max(doc_id) % 2 AS INTEGER) AS total_batches, count(*) AS completed_rows,
       CAST(CASE WHEN lang = 'es' THEN 0 ELSE count(*) + 10 * (max(doc_id) % 3) END AS BIGINT) AS total_rows, lang AS model,
       printf('2024-01-01 %08d', max(doc_id)) AS last_saved
FROM documents GROUP BY source, lang"""
_LATEST_SQL = f"SELECT * FROM ({_LEDGER_SQL}) QUALIFY row_number() OVER (PARTITION BY task_name ORDER BY last_saved DESC) = 1"


@query("S8_ledger_read", f"SELECT * FROM ({_LATEST_SQL}) WHERE completed_batches < total_batches OR completed_rows < total_rows")
def s8(spark, sf_dir):
    found = L.resumable(L.latest_records(_ledger(spark, sf_dir)))
    return found.select(
        "task_name", "completed_batches", "total_batches", "completed_rows", "total_rows", "model", "last_saved"
    )


@query("S3_S6_latest_final_save", "SELECT 'dataset_text_' || count(*) || 'rows_20240131_120000.csv' AS name, count(*) AS rows FROM part")
def s3_s6(spark, sf_dir):
    """A skeleton saved after a data set is passed over."""
    base = new_run_dir(spark)
    S.save_final(table(spark, sf_dir, "part"), base, "text", datetime(2024, 1, 31, 12))
    S.save_final(table(spark, sf_dir, "orders"), base, "skeleton", datetime(2024, 1, 31, 13))
    return S.latest_dataset(S.inventory(spark, [base])).select("name", "rows")


@query("S9_snapshot_read", """
SELECT doc_id AS row_id, 1 AS phase, source AS text FROM documents WHERE doc_id % 2 = 0
UNION ALL SELECT doc_id, 2, lang FROM documents WHERE doc_id % 2 = 1""")
def s9(spark, sf_dir):
    """Two waves of saved values in ranges of 150 rows, one of them compacted; rows saved twice keep the later value."""
    docs = _documents(spark, sf_dir)
    store = L.ProgressStore(new_run_dir(spark) + "/progress", range_batches=5)
    waves = [
        docs.select("row_id", F.lit(1).alias("phase"), F.col("source").alias("text"), F.lit(1).cast("long").alias("saved_us")),
        docs.where("row_id % 2 = 1").select("row_id", F.lit(2).alias("phase"), F.col("lang").alias("text"), F.lit(2).cast("long").alias("saved_us")),
    ]
    for wave in waves:
        store.append_values(wave, "quality", "d", 30)
    store.compact(spark, TEXT_TASK, "d", 1)
    return store.snapshot(spark, TEXT_TASK, "d").select("row_id", "phase", "text")


@query("S10_status", f"""
SELECT task_name, completed_batches, total_batches, completed_rows, total_rows, pct,
       CAST(floor(pct * 40 / 100) AS INTEGER) AS bar, model, last_saved
FROM (SELECT *, CASE WHEN total_rows > 0 THEN completed_rows * 100.0::DOUBLE / total_rows ELSE 0.0 END AS pct FROM ({_LATEST_SQL}))""")
def s10(spark, sf_dir):
    return L.status(_ledger(spark, sf_dir))


@query("S11_response_log", f"""
SELECT printf('b%03d_p', conv_id + 1) || CASE WHEN turn % 2 = 0 THEN '1_a' ELSE '2_a' END || turn AS label,
       length(text) AS chars, ({sql_list(['1', '2'])})[turn % 2 + 1]::INTEGER AS phase
FROM conversations WHERE role <> 'system'""")
def s11(spark, sf_dir):
    answers = table(spark, sf_dir, "conversations").select(
        F.concat(
            F.format_string("b%03d_p", F.col("conv_id") + 1),
            F.when(F.col("turn") % 2 == 0, "1_a").otherwise("2_a"), F.col("turn").cast("string"),
        ).alias("label"),
        F.when(F.col("role") != "system", F.col("text")).alias("raw"),
        (F.col("turn") % 2 + 1).cast("int").alias("phase"),
    )
    path = new_run_dir(spark) + "/responses"
    L.append_responses(answers, path)
    return spark.read.parquet(path).select("label", F.length("raw").cast("long").alias("chars"), "phase")
