"""Compare registered queries with their SQL: python tests/oracle.py [sf_dir] [name prefix ...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "~" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canon(r[i]) for i in order) for r in rows)


DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def type_notes(con, df, sql):
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{n}: {t} vs {want.get(n)}" for n, t in df.dtypes if DUCK_TYPES.get(t) != want.get(n)
    ]


def compare(con, df, sql):
    """None if equal, else what differs."""
    notes = type_notes(con, df, sql)
    if notes:
        print("    types:", "; ".join(notes))
    rel = con.execute(sql)
    want_cols = [d[0] for d in rel.description]
    want = rows_of(want_cols, rel.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return None if not bad else f"{len(bad)} rows differ, first: {str(bad[0][0])[:700]}\n   vs {str(bad[0][1])[:700]}"


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    prefixes = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(con, df, sqls[name]) if name in sqls else None
            note = "" if name in sqls else f" (rows only: {df.count()})"
        except Exception as e:  # report and go on
            problem, note = f"{type(e).__name__}: {str(e)[:900]}", ""
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{note} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
