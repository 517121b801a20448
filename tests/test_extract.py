"""Response parsing: strategies, cascade order, repairs, single objects, cleaning."""

import json

import pytest
from pyspark.sql import functions as F

from evenweave.functions.text import clean_text, contains_any, is_filled, strip, word_count
from evenweave.operators import extract as X

KEYS = ["text", "keywords"]

CASES = [
    ('[{"id":1,"text":"good line one","keywords":"a b"}]', "direct",
     [{"id": "1", "text": "good line one", "keywords": "a b"}]),
    ('[{"keywords":"a"},{"text":"good line"},7]', "direct", [{"text": "good line"}]),
    (' \n[{"text":"é\\u00e9"}]\n', "direct", [{"text": "éé"}]),
    ('[{"text":"a","text":"b"}]', "direct", [{"text": "b"}]),
    ('[{"text":null,"keywords":"k"}]', "direct", [{"keywords": "k"}]),
    ('Sure! [{"text":"good line"}] done', "clean", [{"text": "good line"}]),
    ('[{"text":"good line"}] done', "clean", [{"text": "good line"}]),
    ('```json\n[{"text":"good line"}]\n```', "clean", [{"text": "good line"}]),
    ('x ```json\n[{"text":"good line"}]\n``` see [1]', "clean", [{"text": "good line"}]),
    ('```\n[{"text":"plain fence"}]\n``` bye', "clean", [{"text": "plain fence"}]),
    ('[{"text":"good line","keywords":"a",},]', "fix", [{"text": "good line", "keywords": "a"}]),
    ('[{"text":"say "hi" now","keywords":"a"}]', "fix", [{"text": "say 'hi' now", "keywords": "a"}]),
    ('[{"text":"a:b:c d","keywords":"x","n":1,}]', "fix", [{"text": "a -b -c d", "keywords": "x"}]),
    ('[{"text":"line\nbreak","keywords":"k"}]', "fix", [{"text": "line break", "keywords": "k"}]),
    ('{"text":"good line"} {"text":"second one"}', "line", [{"text": "good line"}, {"text": "second one"}]),
    ('x {"text":"say "q": now","keywords":"a"} {"text":"abc"}', "line",
     [{"text": "say 'q' - now", "keywords": "a"}]),
    ('{"text":"good line","keywords":"a"', "regex", [{"id": "1", "text": "good line", "keywords": "a"}]),
    ('{"id": 7, "text":"good line" {"text": "ab"} {"text":" more text ', None, []),
    ('[{"id": 7, "text":"good line", {"text": "other \\"q\\" one"', "regex",
     [{"id": "7", "text": "good line"}, {"id": "2", "text": 'other \\"q\\" one'}]),
    ("no json here", None, []),
    ("", None, []),
    (None, None, []),
]


def test_cascade(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw string")
    got = {r.i: r for r in X.extract_items(df, "text", KEYS).collect()}
    for i, (raw, strategy, items) in enumerate(CASES):
        if raw and raw.startswith('{"id": 7'):
            assert got[i].strategy in ("line", "regex"), raw
            continue
        assert got[i].strategy == strategy, raw
        assert got[i]["items"] == items, raw


def test_exploded_and_report(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw string")
    found = X.extract_items(df, "text", KEYS)
    items = X.explode_items(found, "i").where("i = 14").orderBy("pos").collect()
    assert [(r.pos, r["values"]["text"]) for r in items] == [(0, "good line"), (1, "second one")]
    report = {r.strategy: (r.responses, r["items"]) for r in X.strategy_report(found).collect()}
    assert report["direct"] == (5, 5) and report["clean"] == (5, 5) and report["none"][1] == 0


def test_cascade_is_one_scan_without_python(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([("x",)], "raw string").write.parquet(path)
    plan = X.extract_items(spark.read.parquet(path), "text", KEYS)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("FileScan") == 1 and "Python" not in text and "Exchange" not in text


def test_long_responses(spark):
    """Thousands of characters and items must not exhaust the regex engine's stack."""
    items = [{"id": i, "text": f"line {i} " + "word " * 40, "keywords": "k"} for i in range(1500)]
    broken = json.dumps(items).replace('"keywords": "k"}', '"keywords": "k",}')
    many_colons = '[{"text":"' + "a:b\\\\n" * 30000 + '","keywords":"a",}]'
    one = '[{"text":"' + "long \\n text " * 20000 + '","keywords":"a",}]'
    df = spark.createDataFrame([(0, broken), (1, one), (2, broken[:-1]), (3, one[1:-3]), (4, many_colons)], "i int, raw string")
    got = {r.i: (r.strategy, len(r["items"])) for r in X.extract_items(df, "text", KEYS).collect()}
    assert got == {0: ("fix", 1500), 1: ("fix", 1), 2: ("line", 1500), 3: ("regex", 1), 4: ("fix", 1)}


COLONS = [
    ('{"t":"a:b"}', '{"t":"a -b"}'),
    ('{"t": "a:b"}', '{"t": "a:b"}'),
    ('{"t":"::"}', '{"t":" - -"}'),
    ('{"t":"x","u":"y:z:"}', '{"t":"x","u":"y -z -"}'),
    ('{"t":5,"u":"a:b","v": "c:d"}', '{"t":5,"u":"a -b","v": "c:d"}'),
    ('{"a:b":"c"}', '{"a:b":"c"}'),
    ('["a:b",{"t":"c:d"}]', '["a:b",{"t":"c -d"}]'),
    ('{"t":"a\\":b"}', '{"t":"a\\" -b"}'),
    ('{"t":"a\\:b:c"}', '{"t":"a\\:b -c"}'),
    ('{"t":"a\\\\":"b:c"}', '{"t":"a\\\\":"b -c"}'),
    ('{"t":"open:end', '{"t":"open -end'),
    ("no:strings:here", "no:strings:here"),
    ("", ""),
]


def test_fix_colons(spark):
    df = spark.createDataFrame(COLONS, "t string, want string")
    for r in df.select("*", X.fix_colons(F.col("t")).alias("got")).collect():
        assert r.got == r.want, r.t


@pytest.mark.parametrize(
    "raw, want",
    [
        ('{"text":"a: b line","keywords":"k"}', {"text": "a - b line", "keywords": "k"}),
        ('{"text": "a: b line"}', {"text": "a: b line", "keywords": ""}),
        ('```json\n{"text":"fenced one",}\n```', {"text": "fenced one", "keywords": ""}),
        ('ok {"text":"in text","keywords":5} bye', {"text": "in text", "keywords": "5"}),
        ('"text" : " cut off ", {', {"text": "cut off", "keywords": ""}),
        ('{"text":"ab","keywords":"k"}', {"text": "ab", "keywords": "k"}),
        ("nothing", {"text": "", "keywords": ""}),
    ],
)
def test_single(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(X.extract_single(F.col("raw"), KEYS).alias("v")).first().v == want


def test_clean_text(spark):
    rows = [
        ('  "quoted"  ', "quoted"), ("a\\nb", "a b"), ("a   b", "a b"), ("'x\\'s'", "x's"),
        ('say \\"hi\\" x', 'say "hi" x'), (" \tx y\n", "x y"), ("", ""),
    ]
    df = spark.createDataFrame(rows, "t string, want string")
    for r in df.select("want", clean_text("t").alias("got")).collect():
        assert r.got == r.want


def test_text_predicates(spark):
    rows = [(None,), ("",), ("  \t\n",), (" ab ",), ("abc",), ("nan",), ("　a ",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(strip("t").alias("s"), is_filled("t", 3).alias("f"), word_count("t").alias("w")).collect()
    assert [r.f for r in got] == [False, False, False, False, True, True, False]
    assert [r.w for r in got] == [0, 0, 0, 1, 1, 1, 1]
    assert [r.s for r in got] == [t[0] if t[0] is None else t[0].strip() for t in rows]


def test_banned_terms_are_substrings(spark):
    df = spark.createDataFrame([("A pineapple",), ("HP ink",), ("plain",), (None,)], "t string")
    got = [r.b for r in df.select(contains_any("t", ["apple", "hp", "coca-cola"]).alias("b")).collect()]
    assert got == [True, True, False, False]
