"""CSV read in segments: quote parity, records that cross segments, counts."""

import pytest
from pyspark.sql import functions as F

from evenweave.session import new_run_dir
from evenweave.sources import csvfiles, segments


@pytest.fixture
def small_segments(spark):
    """Segments of 20 kB, so that a small file has many."""
    names = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cells(n):
    """Rows with separators, quotes, line breaks, blank lines and cells longer than segments."""
    out = []
    for i in range(n):
        text = [f"plain {i}", f'two\nlines "{i}", and\n\na blank one', None, '"', '""\n"', ",", " \n ", "\n" * (i % 7) + "x"][i % 8]
        out.append((i, text, "é\n" * (30_000 if i == n // 2 else i % 90) if i % 5 == 0 else f"b{i}", i / 7))
    return out


SCHEMA = "id long, a string, b string, c double"


def one_reader(spark, path):
    return spark.read.options(**csvfiles.CSV_OPTIONS).schema(SCHEMA).csv(path)


@pytest.mark.parametrize("files", [1, 3])
def test_segments_equal_one_reader(spark, small_segments, files):
    path = f"{new_run_dir(spark)}/cells.csv"
    csvfiles.write_table(spark.createDataFrame(cells(1500), SCHEMA).repartition(files, "id"), path)
    got, want = csvfiles.read_table(spark, path, SCHEMA), one_reader(spark, path)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == 1500
    assert segments.record_counts(spark, path).agg(F.sum("rows")).first()[0] == 1500


def test_several_tasks_read_one_file(spark, small_segments):
    path = f"{new_run_dir(spark)}/cells.csv"
    csvfiles.write_table(spark.createDataFrame(cells(1500), SCHEMA).coalesce(1), path)
    lines = segments.lines_of(spark, path)
    found = segments.parities(segments.summaries(lines)).collect()
    tasks = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5 and len(found) == len({(r.file, r.block) for r in found}) > 5
    assert {r.inside for r in found} == {True, False}
    assert one_reader(spark, path).rdd.getNumPartitions() == 1


def test_many_segments_are_joined_by_shuffle(spark, small_segments, monkeypatch):
    monkeypatch.setattr(segments, "BROADCAST_ROWS", 0)
    path = f"{new_run_dir(spark)}/cells.csv"
    csvfiles.write_table(spark.createDataFrame(cells(800), SCHEMA).coalesce(1), path)
    got, want = csvfiles.read_table(spark, path, SCHEMA), one_reader(spark, path)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def texts(spark, tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    return str(tmp_path / name)


def records_of(spark, path):
    return sorted(r.text for r in segments.records(spark, path).collect())


def test_a_quote_that_is_never_closed(spark, tmp_path):
    """What follows it is one record, and counts as one."""
    path = texts(spark, tmp_path, "open.csv", b'a,b\n1,x\n2,"y\n3,z\n4,"w""\n')
    assert records_of(spark, path) == ["1,x", '2,"y\n3,z\n4,"w""']
    assert [r.rows for r in segments.record_counts(spark, path).collect()] == [2]


@pytest.mark.parametrize("data, want", [
    (b"", None), (b"a,b\n", 0), (b"a,b", 0), (b"a,b\n1,x", 1), (b"a,b\r\n1,x\r\n\r\n2,y\r\n", 2), (b'a,b\n\n1,"\n"\n\n', 1),
])
def test_small_files(spark, tmp_path, data, want):
    path = texts(spark, tmp_path, "small.csv", data)
    assert [r.rows for r in segments.record_counts(spark, path).collect()] == ([] if want is None else [want])
    assert len(records_of(spark, path)) == (want or 0)


def test_line_ends_of_two_characters(spark, tmp_path):
    path = texts(spark, tmp_path, "ends.csv", b'id,a\r\n1,x\r\n2,"p\r\nq"\r\n')
    got = {r.id: r.a for r in csvfiles.read_table(spark, path, "id long, a string").collect()}
    assert got[1] == "x" and got[2].split() == ["p", "q"]


def test_no_task_writes_a_file_of_all_texts(spark, monkeypatch):
    """Beyond a bound several tasks write, a file each of about that size, and the rows come back whole."""
    from evenweave.catalog import storage

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit('a "b"\n'), F.repeat(F.lit("x"), 93)).alias("text"))
    assert storage._in_files(docs).rdd.getNumPartitions() == 1
    monkeypatch.setattr(storage, "FILE_BYTES", 4000)
    dealt = storage._in_files(docs)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 60
    path = new_run_dir(spark)
    csvfiles.write_table(dealt, path)
    found = csvfiles.read_table(spark, path, docs.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
