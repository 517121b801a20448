"""Repeated passages against brute force: interval trees, anchors, and the whole job."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenweave.llm import repeats
from evenweave.llm.common import bit_table, bits_as_array, in_bit_table, maybe_in
from test_llm_operators import key, sample_texts, table


def all_repeats(pieces, least):
    """Every string of at least ``least`` bytes with several places that no longer string has in all of them."""
    places = collections.defaultdict(list)
    for p, t in enumerate(pieces):
        for i in range(len(t)):
            for j in range(i + least, len(t) + 1):
                places[t[i:j]].append((p, i))
    out = set()
    for s, found in places.items():
        before = {pieces[p][i - 1] if i else ("start", p) for p, i in found}
        behind = {pieces[p][i + len(s)] if i + len(s) < len(pieces[p]) else ("end", p) for p, i in found}
        if len(found) > 1 and len(before) > 1 and len(behind) > 1:
            out.add((len(s), tuple(sorted(found))))
    return out


@pytest.mark.parametrize("least", [2, 3, 5])
def test_maximal_repeats(least):
    r = random.Random(least)
    for _ in range(200):
        pieces = [bytes(r.choices(b"ab", k=r.randrange(14))) for _ in range(r.randrange(1, 6))]
        pieces += pieces[: r.randrange(2)]
        got = [(n, tuple(sorted(found))) for n, found in repeats.maximal_repeats(pieces, least)]
        assert len(got) == len(set(got)) and set(got) == all_repeats(pieces, least)


def test_equal_passages_share_an_anchor_and_equal_contexts_a_class():
    r = random.Random(3)
    texts = [bytes(r.choices(b"abcdefgh ", k=600)) for _ in range(4)]
    texts += [texts[0][100:350] + texts[1][:300], b"x" * 700, b"", b"a" * 99, b"a" * 100, texts[0]]
    doc, pos, fp, ctx = (c.tolist() for c in repeats.anchors(texts))
    grams = collections.defaultdict(set)
    classes = collections.defaultdict(set)
    for d, p, f, c in zip(doc, pos, fp, ctx):
        text = texts[d]
        grams[d, p].add(f)
        ends = (p if p < 68 else None, len(text) - p if len(text) - p < 100 else None)
        classes[c].add((text[max(0, p - 68) : p + 100], ends))
    assert all(len(v) == 1 for v in grams.values()) and all(len(v) == 1 for v in classes.values())
    assert len({next(iter(v)) for v in classes.values()}) == len(classes)
    for d, text in enumerate(texts):
        at = sorted(p for e, p in grams if e == d)
        assert all(any(s <= p <= s + 68 for p in at) for s in range(len(text) - 99))


def test_anchors_of_a_long_text_do_not_depend_on_how_it_is_read():
    data = np.random.default_rng(1).integers(97, 101, 1_300_000).astype(np.uint8).tobytes()
    _, pos, fp, ctx = repeats.anchors([data, data[:500]])
    whole = {p: (f, c) for p, f, c in zip(pos[:-20].tolist(), fp.tolist(), ctx.tolist())}
    for low in (0, 400_000, 524_000, 1_000_000):
        _, p, f, c = repeats.anchors([data[low : low + 100_000]])
        inner = (p > 200) & (p < 99_700)
        assert all(whole[a + low] == (b, d) for a, b, d in zip(p[inner].tolist(), f[inner].tolist(), c[inner].tolist()))


def expected(rows, least=100):
    data = [(t or "").encode() for _, t in rows]
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        for s in range(len(data[i]) - least + 1):
            first.setdefault(data[i][s : s + least], (rows[i][0], i, s))
    out = []
    for i, t in enumerate(data):
        cut = np.zeros(len(t), bool)
        for s in range(len(t) - least + 1):
            owner = first[t[s : s + least]]
            if owner[0] != rows[i][0] or owner[2] < s:
                cut[s : s + least] = True
        kept = np.frombuffer(t, np.uint8)[~cut].tobytes()
        spans = int((np.diff(np.concatenate([[0], cut.astype(int)])) == 1).sum())
        out.append((rows[i][0], len(t), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(n, seed=1):
    """Documents that share passages and lines, near and exact copies, and repeats of their own."""
    r = random.Random(seed)

    def prose(k):
        return " ".join(f"w{int(r.paretovariate(0.7)) % 3000}" for _ in range(k))

    shared = [prose(r.randrange(15, 60)) for _ in range(4)]
    near = prose(120).split()
    rows = []
    for i in range(n):
        kind = i % 8
        if kind < 3:
            text = f"{prose(r.randrange(30))} {shared[kind]} {prose(r.randrange(30))}"
        elif kind == 3:
            copy = list(near)
            copy[r.randrange(len(copy))] = f"changed{i}"
            text = " ".join(copy)
        elif kind == 4:
            text = shared[3] + "\n" + shared[3] + prose(5)
        elif kind == 5:
            text = rows[i - 3][1] if i > 8 else prose(40)
        elif kind == 6:
            text = "é" * r.randrange(200) + "z" * r.randrange(300)
        else:
            text = prose(r.randrange(60))
        rows.append((i, text))
    return rows


COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def check(spark, rows, docs=None):
    got = [tuple(r[c] for c in COLUMNS) for r in repeats.without_repeats(table(spark, rows) if docs is None else docs).collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


ODD = [(0, None), (1, ""), (2, "a" * 99), (3, "b" * 100), (4, "b" * 101), (5, "b" * 100), (None, "c" * 150), (6, "c" * 120),
       (8, "no id twice " * 12), (8, "no id twice " * 12), (9, "x" * 5000), (10, "日本語のテキスト" * 40)]


def test_without_repeats(spark):
    r = random.Random(9)
    rows = passages(160)
    r.shuffle(rows)
    rows += [(1000 + i, t) for i, t in ODD if i is not None] + [(None, "c" * 150), (None, "c" * 150)]
    check(spark, rows, table(spark, rows).withColumns({c: F.lit("x") for c in ("d", "row", "pos", "word", "bits", "spans", "fp")}))


def test_common_grams_are_settled_the_same_way(spark, monkeypatch):
    """Every gram counts as hot: salted places, passages instead of suffixes."""
    monkeypatch.setattr(repeats, "GROUP", 1)
    check(spark, passages(120, seed=4))


def test_every_passage_lies_in_the_piece_of_one_anchor():
    """Also of texts that repeat themselves every few bytes, which have an anchor every few bytes."""
    r = random.Random(5)
    texts = [b"the " * 200, bytes(r.choices(b"ab ", k=900)), b"x" * 300 + bytes(r.choices(b"abcdefg ", k=400)) + b"the " * 90, b"q" * 100]
    doc, pos, _, _ = (c.tolist() for c in repeats.anchors(texts))
    leads = [min(p, 68) for p in pos]
    first, count = repeats.own_passages([texts[d][p - n : p + 100] for d, p, n in zip(doc, pos, leads)], leads)
    got = collections.Counter((d, p - n + f + i) for d, p, n, f, c in zip(doc, pos, leads, first.tolist(), count.tolist()) for i in range(c))
    assert got == collections.Counter((d, s) for d, t in enumerate(texts) for s in range(len(t) - 99))


def rows_written(monkeypatch):
    written = collections.Counter()

    def materialize(df, path, real=repeats.materialize):
        out = real(df, path)
        written[path.rsplit("/", 1)[1]] += out.count()
        return out

    monkeypatch.setattr(repeats, "materialize", materialize)
    return written


def grams(text):
    return repeats.window_hashes(np.frombuffer(text.encode(), np.uint8).astype(np.int32), repeats.GRAM)


def unlike(r, k):
    return "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=k))


def test_a_crowded_gram_makes_two_rows_a_context_unless_more_is_shared(spark, monkeypatch):
    """A phrase of 40 bytes, chosen for a gram of small hash, between different words: no passage of it is shared, so none is written."""
    r = random.Random(11)
    phrase = min((unlike(r, 40) for _ in range(400)), key=lambda t: grams(t).min())
    rows = [(i, f"{unlike(r, 120)}{phrase}{unlike(r, 120)}") for i in range(60)]
    rows += [(100, rows[3][1][30:250]), (101, rows[4][1][100:])]
    monkeypatch.setattr(repeats, "GROUP", 8)
    written = rows_written(monkeypatch)
    check(spark, rows)
    assert written["wanted"] >= 50
    assert written["passages"] + written["parts_36"] + written["parts_6"] <= 2 * written["wanted"]


def test_a_crowded_gram_of_a_run_of_one_word(spark, monkeypatch):
    """Anchors every four bytes: each passage of the runs is written once, not once an anchor."""
    r = random.Random(12)
    rows = [(i, unlike(r, 80) + " the" * r.randrange(40, 60) + " " + unlike(r, 80)) for i in range(40)]
    monkeypatch.setattr(repeats, "GROUP", 8)
    written = rows_written(monkeypatch)
    check(spark, rows)
    assert 0 < written["passages"] <= sum(len(t) - 99 for _, t in rows)


@pytest.mark.parametrize("group", [3, 12])
def test_crowded_grams_of_near_copies(spark, monkeypatch, group):
    """Parts that few share go to the suffix arrays, crowded ones down to single passages."""
    r = random.Random(group)
    near = unlike(r, 700)
    rows = [(i, "".join(c if r.random() > 0.012 else "#" for c in near[r.randrange(60) :])) for i in range(60)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(passages(60, seed=7))]
    monkeypatch.setattr(repeats, "GROUP", group)
    written = rows_written(monkeypatch)
    check(spark, rows)
    assert written["parts_36"] and written["parts_6"]


def test_rows_that_share_an_id(spark):
    """They count in the order of the hashes of their texts: of what two share, one keeps all and one loses it."""
    shared = " ".join(str(n * n) for n in range(300, 340))
    rows = [(1, "one " + shared), (1, "two " + shared), (2, "three " + shared)]
    got = collections.Counter((r.doc_id, r.n_removed > 0) for r in repeats.without_repeats(table(spark, rows)).collect())
    assert got == {(1, False): 1, (1, True): 1, (2, True): 1}


def test_of_nothing_and_of_nothing_repeated(spark):
    assert repeats.without_repeats(table(spark, []).limit(0)).collect() == []
    check(spark, [(1, "short"), (2, None), (3, "one long text without any other like it " + "".join(map(chr, range(33, 126))))])


def test_long_texts(spark):
    r = random.Random(2)
    long = " ".join(str(r.randrange(10**6)) for _ in range(6_000))
    rows = [(1, long[1_000:9_000]), (2, long), (3, long[30_000:] + "!")]
    check(spark, rows)


def test_kept_text(spark):
    docs = table(spark, passages(40))
    removed = repeats.removed_stretches(docs)
    whole = {r.doc_id: r.text.encode() for r in docs.collect()}
    spans = {r.d: r.spans for r in removed.collect()}
    for r in repeats.kept_texts(docs, removed).collect():
        left = b"".join(whole[r.d][a:b] for a, b in zip([0, *(s.end for s in spans[r.d])], [*(s.start for s in spans[r.d]), None]))
        assert bytes(r.kept) == left and len(left)


def test_bit_table(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("h"))
    some = keys.where("h % 10 = 0")
    left = {r.h for r in maybe_in(keys, "h", bit_table(some, "h")).collect()}
    wanted = {r.h for r in some.collect()}
    assert wanted <= left and len(left) < len(wanted) + 20
    bits = bits_as_array(bit_table(some, "h"))
    everything = np.array([r.h for r in keys.collect()], np.int64).view(np.uint64)
    assert set(everything[in_bit_table(bits, everything)].view(np.int64).tolist()) == left
