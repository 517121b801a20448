"""Merkle manifest and fill-in-the-middle against brute force, with nulls, ties, repeats and clashing column names."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from evenweave.llm import fill_in_middle, merkle
from test_llm_operators import same, sample_texts, table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 --------------------------------------------------------------------------------------------------------------

def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(leaves, arity):
    """Top, and for every leaf its steps (left siblings, right siblings)."""
    nodes, ways = list(leaves), [[] for _ in leaves]
    level = [[i] for i in range(len(leaves))]  # leaves below each node
    while len(nodes) > 1:
        up, below = [], []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for k in range(len(run)):
                for i in level[at + k]:
                    ways[i].append((run[:k], run[k + 1 :]))
            up.append(sha("".join(run)))
            below.append([i for g in level[at : at + arity] for i in g])
        nodes, level = up, below
    return nodes[0], ways


def expected_manifest(rows, arity=3):
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        members = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((members, *tree_of([leaf(*r) for r in members], arity)))
    root, upper = tree_of([t[1] for t in trees], arity)
    for (members, subroot, ways), above in zip(trees, upper):
        for r, way in zip(members, ways):
            steps = way + above
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                changed[4] = r[4].replace("\n", "")
            node = leaf(*changed)
            for left, right in steps:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join(h for left, right in steps for h in left + right))
            out.append((r[0], leaf(*r), subroot, root, proof, node, node == root))
    return out


def manifest_rows():
    sources = ["hot"] * 40 + ["b", None, "", "é", "hot2", "b", "hot", "hot"]
    rows = [(i % 37, sources[i % len(sources)], "en" if i % 3 else None, i % 5 or None, f"line {i}\nnext\n" if i % 4 else None)
            for i in range(120)]
    rows += [(7, "b", "en", 3, "same\nrow"), (7, "b", "en", 3, "same\nrow"), (None, "b", "en", 3, "no id\n"),
             (None, None, None, None, None), (900, "alone", "fr", 9, ""), (901, "long", "fr", 9, "x\n" * 40_000)]
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
CLASHES = ("digest", "idx", "n", "tree", "path", "leaf", "root", "place", "first", "t", "i")
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def test_manifest(spark):
    rows = manifest_rows()
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = expected_manifest(rows)
    assert {w[-1] for w in want} == {True, False}
    same(merkle.verified(docs), COLUMNS, want)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "s", "en", i, f"t\n{i}") for i in range(n)]
    same(merkle.verified(spark.createDataFrame(rows, SCHEMA)), COLUMNS, expected_manifest(rows))


def test_binary_manifest(spark):
    """Runs of two find their sibling by XOR."""
    rows = manifest_rows()[:30]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), arity=2)
    got = found.select("doc_id", F.lower(F.hex("root")).alias("root"), merkle.proof_digest(F.col("path")).alias("proof"),
                       F.lower(F.hex(merkle.folded(F.col("leaf"), F.col("path")))).alias("folded"))
    want = [(w[0], w[3], w[4], w[3]) for w in expected_manifest(rows, 2)]
    same(got, ["doc_id", "root", "proof", "folded"], want)


def test_manifest_of_nothing(spark):
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).collect() == []


def test_levels_are_joined_by_equality(spark):
    nodes = spark.range(100).select(F.lit(0).cast("long").alias("tree"), F.col("id").alias("idx"), F.lit(100).alias("n"),
                                    F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    plan = merkle._with_siblings(nodes, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


# --- 12 --------------------------------------------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), sha(out), sha(text)


FIM_COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def middle_rows():
    odd = ["", None, " ", " \n\t", "a", " a", "a ", "a b <P> c", "x <S", "<M> y", "$1 \\2 $ {3}", "日本 語 😀 é z   q\x0bv\x0c",
           "x" * 300_000, "ab " * 200_000, " " * 200_000 + "end", "<<S <P <M P> S> M>", "line\nline\r\nline"]
    return [(i, odd[i % len(odd)]) for i in range(len(odd) * 6)] + sample_texts()


def test_fill_in_middle(spark):
    rows = middle_rows()
    docs = table(spark, rows).withColumns({c: F.lit("x") for c in ("n", "form", "output", "a", "digest", "h1")})
    want = [expected_middle(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    same(fill_in_middle.digest(fill_in_middle.rearranged(docs)), FIM_COLUMNS, want)


def test_fill_in_middle_restores_every_text(spark):
    made = fill_in_middle.rearranged(table(spark, middle_rows()), rate=100)
    back = made.select("text", fill_in_middle.restored(F.col("output"), F.col("form")).alias("back"), "form")
    assert back.where(~F.col("text").eqNullSafe(F.col("back"))).count() == 0
    assert back.where("form <> 'plain'").count() > 50


def test_fill_in_middle_of_nothing(spark):
    assert fill_in_middle.rearranged(table(spark, []).limit(0)).collect() == []


def test_fill_in_middle_is_native(spark):
    plan = fill_in_middle.digest(fill_in_middle.rearranged(table(spark, sample_texts())))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange hash" not in text
