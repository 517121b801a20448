"""Each operator against a brute-force version, on rows with nulls, empty and very long texts, ties and repeats."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenweave.llm import (
    brown_lm, components, exact_dedup, fertility, jaccard_join, metric_rounds, packing, pieces, pii, rules, token_counts,
    toxicity, units,
)
from evenweave.llm.common import prepare
from evenweave.session import new_run_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, key string, length string, bucket string"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{int(r.paretovariate(0.8)) % vocabulary}" for _ in range(n))


def sample_texts():
    near = prose(7, 200)
    return [
        (1, prose(1, 60)), (2, prose(1, 60)), (2, prose(1, 60)), (3, prose(1, 60).upper()), (4, None), (5, ""), (6, ""),
        (7, " \n\t "), (8, near), (9, near.replace("w1 ", "x1 ", 1)), (10, near + " tail"), (10, prose(3, 30)),
        (None, near), (None, None), (None, prose(4, 40)), (11, "a b c"), (12, "A  b\nc"), (13, "É b c"), (14, "é b c"),
        (15, "one two three four five"), (16, prose(5, 30_000)), (17, "7" * 20_000), (18, "x" * 20_000), (19, " " * 9_000 + "y"),
        (20, "write to ann.lee@mail.example.org or bob@x.co_tail@y.org, call +1 (206) 555-0100 now"),
        (21, "card 4111 1111 1111 1111, host 10.0.0.255 and 256.1.1.1 and 1.2.3.4.5.6.7.8 GB82 WEST 1234 5698 7654 32"),
        (22, "my social security number is 123-45-6789 but 123-45-6789 elsewhere is " + "far " * 12 + "123-45-6789"),
        (23, "naïve é café <|endoftext|> a  <|endoftext|>b 日本語 😀 don't"), (24, "repeat me now " * 60),
        (25, "same line\nsame line\n\n\nother line\nsame line"), (26, prose(6, 3_000)), (28, "The committee met on Tuesday to review plans for a new library near the river. Several members asked how "
             "the building would be paid for, and whether local schools could share its reading rooms during summer. After a "
             "long discussion they agreed to ask residents for their views before any final decision is made next year."),
        (27, "the ### end $$$ of | it & <b>"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return table(spark, sample_texts())


def table(spark, rows):
    """Documents with columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "h", "k", "l", "b") for i, t in rows], SCHEMA).repartition(3)


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect()) if columns else df.collect()


def key(v):
    return tuple((x is None, x if x is not None else 0) if not isinstance(x, tuple) else x for x in v)


def same(df, columns, want):
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


OPERATORS = {
    "pii": lambda d: pii.digest(pii.find_spans(d)),
    "jaccard": jaccard_join.near_duplicates,
    "tokens": token_counts.token_counts,
    "brown": brown_lm.brown_scores,
    "fertility": fertility.quality_rules,
    "exact": exact_dedup.exact_groups,
    "packing": packing.pack,
    "pieces": pieces.round_trip,
    "redact": pii.redacted_documents,
    "unique": exact_dedup.unique_documents,
    "one of each": jaccard_join.one_of_each,
    "kept": fertility.kept_documents,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](table(spark, []).limit(0)).collect() == []


def test_empty_tables_of_classifiers(spark):
    none = table(spark, []).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(none, toxicity.learn(none, labels)).collect() == []
    assert rules.score(none, rules.learn(none, labels)).collect() == []


# --- 1 ---------------------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, expr) in enumerate(BASE.items()):
        for m in re.finditer(expr, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_pii_base_spans(docs):
    want = []
    for i, t in sample_texts():
        spans = base_spans(t or "")
        counts = [sum(s[1] == k for s in spans) for k in range(4)]
        want.append((i, *counts, hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()))
    same(pii.digest(pii.find_spans(docs)), ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"], want)


def test_pii_other_spans_need_checksum_or_context(docs):
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_spans(docs)).where("doc_id in (21, 22)").collect()}
    assert "iban" in found[21]
    assert found[22].count("ssn") == 1  # the others have no context


def test_pii_iban_groups_and_secrets(spark):
    token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = {
        1: "pay to ES91 2100 0418 4502 0005 1332 BIC CAIXESBB soon", 2: "GB82 WEST 1234 5698 7654 32 XYZ9 AB", 3: "ES91 2100 0418 4502 0005 1333 BIC",
        4: f'token = "{token}" and so on', 5: f"a digest {token} of a file", 6: "api_key: AKIA-9f3b/Q2+xyz77Lm01== end",
        7: "password aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", 8: "secret 1234567890123456789012", 9: "token onlylettersinthislongword",
        10: f"the bearer {token}{token} " + "x" * 50_000, 11: "Token: " + "ab12" * 5_000,
    }
    found = {r.doc_id: r.spans.split(",") if r.spans else [] for r in pii.digest(pii.find_spans(table(spark, texts.items()))).collect()}

    def where(i, kind):
        return [tuple(map(int, s.split(":")[1:])) for s in found[i] if s.startswith(kind)]

    cut = lambda i, kind: [texts[i][a:b] for a, b in where(i, kind)]
    assert cut(1, "iban") == ["ES91 2100 0418 4502 0005 1332"] and cut(2, "iban") == ["GB82 WEST 1234 5698 7654 32"]
    assert cut(3, "iban") == [] and cut(4, "secret") == [token] and cut(6, "secret") == ["AKIA-9f3b/Q2+xyz77Lm01=="]
    assert not any(cut(i, "secret") for i in (5, 7, 8, 9, 11)) and cut(10, "secret") == [token * 2]


def test_sample_of_repeated_ids_is_the_same_in_every_run(spark):
    from evenweave.llm.labelled import sample_of

    rows = [(i, f"text {k} of {i}") for i in range(30) for k in range(3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    runs = [{r.doc_id: r.text for r in sample_of(table(spark, order), labels, "toxic").collect()} for order in (rows, rows[::-1])]
    assert runs[0] == runs[1] and runs[0]
    assert all(t == min((f"text {k} of {i}" for k in range(3)), key=lambda x: hashlib.sha256(x.encode()).hexdigest())
               for i, t in runs[0].items())


def test_only_copies_are_shuffled(spark):
    """A bit table keeps the rows without copies out of the exchange of texts."""
    from evenweave.llm.common import bit_table, maybe_in

    rows = [(i, prose(i, 30)) for i in range(300)] + [(1000 + i, prose(i, 30)) for i in range(5)]
    docs = table(spark, rows)
    assert sorted(r.doc_id for r in exact_dedup.unique_documents(docs).collect()) == sorted([*range(5, 300), *range(1000, 1005)])
    gone = docs.where("doc_id < 5").select(F.xxhash64("doc_id").alias("hid"))
    some = maybe_in(docs.select("text", F.xxhash64("doc_id").alias("hid")), "hid", bit_table(gone, "hid"))
    assert some.count() < 10


def test_pii_random_strings(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("ab@@.._1234+ -()\n4") for _ in range(60)) for _ in range(400)]
    got = pii.digest(pii.find_spans(table(spark, enumerate(texts))))
    want = [(i, hashlib.sha256(",".join(s[2] for s in base_spans(t)).encode()).hexdigest()) for i, t in enumerate(texts)]
    same(got, ["doc_id", "base_sha256"], want)


def test_redaction(docs):
    got = {r.doc_id: r for r in pii.redacted_documents(docs).where("doc_id > 19").collect()}
    assert got[20].text == "write to [EMAIL] or [EMAIL][EMAIL], call [PHONE] now" and got[20].n_chars == len(got[20].text)
    assert "4111" not in got[21].text and "[IBAN]" in got[21].text and got[21].h == "h"


# --- 2 ---------------------------------------------------------------------------------------------------------------

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_groups(rows):
    """(id, size, smallest id of its component) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    low = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(rows)]


COMPONENT = ["doc_id", "n_shingles", "component_id"]


def test_near_duplicates(docs):
    same(jaccard_join.near_duplicates(docs), COMPONENT, near_groups(sample_texts()))


def family(seed, n, words, edits):
    r = random.Random(seed)
    base = [f"v{r.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(words)] = f"z{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [512, 16, 4])
def test_near_duplicates_in_large_groups(spark, monkeypatch, block):
    """Families around the threshold, over pivot rounds, blocks, recursive regions and salted pivots."""
    monkeypatch.setattr(metric_rounds, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SALT_ABOVE", 20)
    monkeypatch.setattr(jaccard_join, "LEAF", 12)
    texts = family(1, 90, 80, 8) + family(2, 40, 30, 4) + [prose(s, 50) for s in range(30)]
    rows = list(enumerate(texts)) + [(500 + k, texts[0]) for k in range(40)]
    same(jaccard_join.near_duplicates(table(spark, rows)), COMPONENT, near_groups(rows))


def quoting(seed, n, words, quotes):
    """Texts with nothing in common but a passage, which each takes from ``quotes`` in turn."""
    r = random.Random(seed)
    texts = [[f"u{r.randrange(10**9)}" for _ in range(words)] for _ in range(n)]
    return [" ".join(t[: words // 2] + quotes[k % len(quotes)] + t[words // 2 :]) for k, t in enumerate(texts)]


def test_a_shared_passage_makes_no_candidates(spark):
    """Passages that more than ``FEW`` texts quote connect none of them; families of more than that stay whole."""
    quotes = [[f"q{k}_{j}" for j in range(15)] for k in range(3)]
    texts = quoting(21, 90, 320, quotes)
    kept = [i for i in (0, 31, 62) for _ in range(24)]  # each of another passage
    r = random.Random(22)
    for i in kept:
        w = texts[i].split()
        w[r.randrange(len(w))] = f"e{r.randrange(10**9)}"
        texts.append(" ".join(w))
    base = table(spark, list(enumerate(texts))).select("doc_id", "text")
    unknown = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    regions = jaccard_join._regions(base, unknown, unknown, 5, 75)
    assert regions.groupBy("pivot").count().where(F.col("count") > jaccard_join.FEW).count() > 0
    got = union_find((e[0], e[1]) for e in jaccard_join._candidate_edges(regions, new_run_dir(spark), 75).collect())
    keys = [jaccard_join.near_key(jaccard_join.set_key(u), len(u)) for u in (jaccard_join.shingles_of(t.encode(), 5)[0] for t in texts)]
    families = collections.defaultdict(set)
    for k, i in enumerate([*range(90), *kept]):
        families[i].add(keys[k])
    want = {frozenset(f) for f in families.values() if len(f) > 1}
    groups = collections.defaultdict(set)
    for k, top in got.items():
        groups[top].add(k)
    assert {frozenset(g) for g in groups.values()} == want


@pytest.mark.parametrize("few", [1, 3])
def test_no_link_is_lost_between_crowded_regions(spark, monkeypatch, few):
    """Families of all sizes that quote the same passages: some pairs meet in small regions only, some in large, some in both."""
    monkeypatch.setattr(jaccard_join, "FEW", few)
    quotes = [prose(s, 60, 10**6).split() for s in range(60, 64)]
    texts = quoting(23, 12, 100, quotes) + quoting(24, 12, 30, quotes)
    r = random.Random(25)
    for i in range(24):
        for _ in range(i % 6):
            w = texts[i].split()
            for _ in range(r.randrange(1, 5)):
                w[r.randrange(len(w))] = f"e{r.randrange(10**9)}"
            texts.append(" ".join(w + [f"t{k}" for k in range(r.randrange(12))]))
    rows = list(enumerate(texts))
    same(jaccard_join.near_duplicates(table(spark, rows)), COMPONENT, near_groups(rows))


def test_metric_join_is_exact():
    r = random.Random(3)
    sets = [np.unique(np.array([hash(x) % 2**62 for x in shingles(t)], np.uint64)) for t in family(4, 150, 60, 9)]
    sets += [np.unique(np.array([r.randrange(2**60) for _ in range(40)], np.uint64)) for _ in range(50)]
    pool = jaccard_join.Sets(sets)
    groups = jaccard_join.Groups(len(sets))
    jaccard_join.metric_join(pool, np.arange(len(sets)), None, groups, 75)
    want = jaccard_join.Groups(len(sets))
    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            want.join(a, np.array([b]))
    assert (groups.all() == want.all()).all()


def links_of(sets):
    """All linked pairs of many sets, by the lists of the sets that hold each shingle."""
    codes, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(which, kind="stable")
    lists = np.split(owner[order], np.cumsum(np.bincount(which))[:-1])
    at = np.split(which, np.cumsum([len(s) for s in sets])[:-1])
    sizes = np.array([len(s) for s in sets])
    for i in range(len(sets)):
        both = np.bincount(np.concatenate([lists[c] for c in at[i]]), minlength=len(sets))
        linked = np.flatnonzero(100 * both >= 75 * (sizes + sizes[i] - both))
        yield from ((i, int(j)) for j in linked if j < i)


def region_rows(spark, sets, names):
    """Rows of one candidate group for each name, as the pivot rounds take them."""
    n = collections.Counter(names)
    size = collections.Counter()
    for s, g in zip(sets, names):
        size[g] += len(s)
    rows = [(g, n[g], size[g], bytearray(k.to_bytes(16, "big")), s.view(np.int64).tolist()) for k, (s, g) in enumerate(zip(sets, names))]
    return spark.createDataFrame(rows, "region long, n_sets long, n_all long, set_key binary, shingles array<long>").repartition(4)


def joined(spark, sets, names):
    path = new_run_dir(spark)
    stars, units, counts = metric_rounds.regions_to_compare(region_rows(spark, sets, names), path, 75)
    links = stars.union(jaccard_join._links(units, 75)).collect()
    got = union_find((int.from_bytes(a, "big"), int.from_bytes(b, "big")) for a, b in links)
    return got, units.count(), counts


def test_large_group_of_near_copies_costs_little(spark):
    """5,000 near copies of one text: hardly a row is sent twice, and none is dealt out in block pairs."""
    sets = [jaccard_join.shingles_of(t.encode(), 5)[0] for t in dict.fromkeys(family(11, 5200, 150, 4))][:5000]
    sets += [jaccard_join.shingles_of(prose(s, 150).encode(), 5)[0] for s in range(40)]
    got, in_units, counts = joined(spark, sets, [1] * len(sets))
    want = union_find(links_of(sets))
    assert {k: v for k, v in got.items() if k != v} == {k: v for k, v in want.items() if k != v}
    assert counts["in block pairs"] == 0 and counts["in rounds"] + in_units <= 2 * len(sets)


@pytest.mark.parametrize("block", [4, 30])
def test_pivot_rounds_are_exact(spark, monkeypatch, block):
    """Several groups of families whose members link or just do not, with visitors on both sides."""
    monkeypatch.setattr(metric_rounds, "BLOCK", block)
    texts = [family(s, 60, 30, 1 + s) for s in range(1, 9)]
    sets = [jaccard_join.shingles_of(t.encode(), 5)[0] for ts in texts for t in ts]
    names = [1 + k // 3 for k, ts in enumerate(texts) for _ in ts]
    kept = {s.tobytes(): (s, g) for s, g in zip(sets, names)}
    sets, names = [v[0] for v in kept.values()], [v[1] for v in kept.values()]
    got, _, counts = joined(spark, sets, names)
    want = union_find((a, b) for a, b in links_of(sets) if names[a] == names[b])
    assert {k: v for k, v in got.items() if k != v} == {k: v for k, v in want.items() if k != v}
    assert counts["rounds"] > 1


def union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_components_equal_union_find(spark):
    graphs = [[(5, 3), (6, 5), (6, 1)], [(k, k - d) for k in range(3, 60) for d in (1, 2)]]
    for seed in range(8):
        r = random.Random(seed)
        graphs.append([tuple(sorted(r.sample(range(200), 2), reverse=True)) for _ in range(90 + 40 * (seed % 5))])
    # disjoint graphs in one table: a graph's nodes lie in a range of their own
    edges = [(1000 * g + a, 1000 * g + b) for g, es in enumerate(graphs) for a, b in es]
    named = {}
    for kind, of in (("long", int), ("binary", lambda n: bytearray(n.to_bytes(4, "big")))):
        table = spark.createDataFrame([(of(a), of(b)) for a, b in edges], f"a {kind}, b {kind}").repartition(3)
        rows = components.components(table, new_run_dir(spark)).collect()
        named[kind] = [(r["node"], r["label"]) for r in rows]
    want = union_find(edges)
    assert sorted(named["long"]) == sorted(want.items())
    assert sorted((int.from_bytes(n, "big"), int.from_bytes(x, "big")) for n, x in named["binary"]) == sorted(want.items())


def test_one_of_each_group_stays(docs):
    rows = sample_texts()
    kept = collections.Counter((r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).collect())
    groups = near_groups(rows)
    for (i, t), (_, n, low) in zip(rows, groups):
        if n and low is not None:
            assert kept[i, t] == (1 if i == low and kept[i, t] else 0)
    for low in {g[2] for g in groups if g[1] and g[2] is not None}:
        assert sum(kept[i, t] for i, t in {r for r, g in zip(rows, groups) if g[2] == low and g[1]}) == 1


# --- 3 and 10 --------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(units.model_path(None))


def ids_by_library(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(n):
    r = random.Random(9)
    letters = "ab \n\t\r'sé日<|>\x1c\x85\xa0 ́😀　᠎﻿​²½9Ⅷaaa"
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_token_counts(docs, tokenizer):
    want = []
    for i, t in sample_texts():
        n = len(ids_by_library(tokenizer, t))
        want.append((i, len((t or "").encode()), n, n > 1024))
    same(token_counts.token_counts(docs), ["doc_id", "n_bytes", "n_tokens", "over_limit"], want)


def test_units_and_merges_equal_the_library(tokenizer):
    texts = odd_texts(3000)
    want = [ids_by_library(tokenizer, t) for t in texts]
    path = units.model_path(None)
    assert token_counts.counts_of(path).count([t.encode() for t in texts]) == [len(w) for w in want]
    assert [units.ids_of(path).encode(t.encode()) for t in texts] == [units.packed(w) for w in want]


@pytest.mark.parametrize("length", [2048, 64])
def test_packing(docs, tokenizer, length):
    got = packing.pack(docs, length=length).collect()
    whole = collections.Counter()
    parts = collections.defaultdict(list)
    for i, t in sample_texts():
        whole[i, tuple(ids_by_library(tokenizer, t) + [1])] += 1
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    padding = 0
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    total = sum(len(ids) * n for (_, ids), n in whole.items())
    assert sum(r.length for r in got) == total and padding <= 0.05 * total
    for (i, ids), n in whole.items():
        mine = [p for p in parts[i, len(ids)] if zlib.crc32(np.array(ids[p[0] : p[0] + p[1]], "<u4").tobytes()) == p[2]]
        covered = np.zeros(len(ids) + 1, int)
        for start, size, _ in mine:
            covered[start : start + size] += 1
        assert (covered[:-1] >= n).all()


def test_column_generation_bound():
    sizes, demand = np.array([3, 5, 7, 11]), np.array([40.0, 31, 22, 13])
    patterns, used = packing.column_generation(sizes, demand, 16)
    assert np.allclose(patterns.T @ used, demand) and (patterns @ sizes <= 16).all()
    assert demand @ sizes / 16 <= used.sum() <= 1.08 * demand @ sizes / 16


# --- 4 ---------------------------------------------------------------------------------------------------------------

def test_brown_scores(docs):
    rows = sample_texts()
    tokens = [((t or "").encode().lower().split() + [b""]) for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    counts = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        want.append((i, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 4)))
    got = brown_lm.brown_scores(docs).collect()
    assert all(r.score < 0 for r in got)
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_brown_model_is_a_distribution_and_rare_words_are_joined(spark, docs, monkeypatch):
    from evenweave.session import new_run_dir

    full = {r.doc_id: r.score for r in brown_lm.brown_scores(docs).where("doc_id > 0").collect()}
    monkeypatch.setattr(brown_lm, "HEAD", 50)
    few = {r.doc_id: r.score for r in brown_lm.brown_scores(docs).where("doc_id > 0").collect()}
    assert all(abs(full[i] - few[i]) < 1e-6 * abs(full[i]) + 1e-6 for i in full if i not in (2, 10))
    training = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    model, counts = brown_lm.learn(training, new_run_dir(spark))
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    classes = model.clusters.table()
    mass = collections.defaultdict(float)
    for r in counts.collect():
        k = classes[bytes(r.word)]
        mass[k] += 10 ** model.emission(r.c, k)
    for k in range(len(model.class_words)):
        assert mass[k] + 10 ** model.emission(0, k) == pytest.approx(1)


def likeliest_classes(model, texts, before):
    """Class of each clustered word from the contexts of all its occurrences, word by word."""
    k = model.clusters.size()
    table = before.table()
    between, contexts = np.zeros((k, k)), collections.defaultdict(list)
    for t in texts:
        ws = [b"", *t.encode().lower().split(), b""]
        of = [table[w] for w in ws]
        np.add.at(between, (of[:-1], of[1:]), 1)
        for i in range(1, len(ws) - 1):
            if table.slot(ws[i]) >= 0:
                contexts[ws[i]].append((of[i - 1], of[i + 1]))
    share = (between.sum(axis=0) + 0.5) / (between.sum() + 0.5 * k)
    step = np.log10((between + 10 * share) / (between.sum(axis=1, keepdims=True) + 10))
    out = {}
    for w, seen in contexts.items():
        score = [sum(step[a, j] + step[j, b] for a, b in seen) - len(seen) * math.log10(between[:, j].sum() + 1) for j in range(k)]
        score[int(model.clusters.classes[1])] = -math.inf
        out[w] = score
    return out


def test_words_are_clustered_by_their_contexts(spark, monkeypatch):
    """All words above the threshold, more in a larger table; their classes are the likeliest by brute force."""
    from evenweave.session import new_run_dir

    monkeypatch.setattr(brown_lm, "ROUNDS", 1)
    monkeypatch.setattr(brown_lm, "WORD_ITEMS", 30)
    texts = [prose(s, 300, 900) for s in range(60)]
    clustered = []
    for n in (15, 60):
        training = table(spark, list(enumerate(texts[:n]))).select("doc_id", "text")
        model, counts = brown_lm.learn(training, new_run_dir(spark))
        often = {bytes(r.word) for r in counts.where("c >= 8").collect()} - set(model.clusters.own)
        assert {brown_lm.word_hash(w) for w in often} == set(model.clusters.hashes.tolist())
        clustered.append(len(often))
        # before the round every word had the class of its ending
        start = brown_lm.Clusters(*(getattr(model.clusters, f) for f in ("own", "endings", "classes", "hashes")), model.clusters.moved.copy())
        items = brown_lm.Items(start.own, start.endings)
        for w in often:
            start.moved[start.table().slot(w)] = start.classes[items[w]]
        table_now = model.clusters.table()
        for w, score in likeliest_classes(model, texts[:n], start).items():
            assert score[table_now[w]] == pytest.approx(max(score), abs=1e-6)
    assert clustered[1] > 1.5 * clustered[0]


def test_chain_of_tokens():
    """Odd whitespace, letters outside ASCII, empty texts, a batch without rows."""
    texts = ["", " ", "A b", "  a\tB\x0b\x0c\r\na ", "\x1ca\x1c \x85 \u2003B\xa0c\xc4\u212a", "\0 \0a", "b", "\ud7ff " * 3]
    for some in (texts, texts[2:3], texts[:2], []):
        for kind in (pa.string(), pa.large_string()):
            codes, distinct, edges = brown_lm.chain(pa.array([None, *some], kind).slice(1))
            words = distinct.to_pylist()
            assert len(set(words)) == len(words)
            got = [[words[c] for c in codes[a:b]] for a, b in zip(edges[:-1], edges[1:])]
            assert got == [[*t.encode().lower().split(), b""] for t in some]
            assert words[codes[0]] == b"" and edges[0] == 1 and edges[-1] == len(codes)


def test_contexts_are_put_together_over_batches(spark):
    """One row a clustered word and task, not one a batch, with a byte for each neighbour of all its occurrences."""
    from evenweave.session import new_run_dir

    texts = [prose(s, 300, 900) for s in range(40)]
    training = table(spark, list(enumerate(texts))).select("doc_id", "text").coalesce(1)
    model, _ = brown_lm.learn(training, new_run_dir(spark))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        rows = brown_lm._contexts(training, model.clusters).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = {r.slot: collections.Counter(bytes(r.seen)) for r in rows if r.slot >= 0}
    assert len(got) == sum(r.slot >= 0 for r in rows) == len(model.clusters.hashes)
    k, classes, want = model.clusters.size(), model.clusters.table(), collections.defaultdict(collections.Counter)
    for t in texts:
        ws = [b"", *t.encode().lower().split(), b""]
        for a, w, b in zip(ws, ws[1:], ws[2:]):
            if classes.slot(w) >= 0:
                want[classes.slot(w)].update([classes[a], k + classes[b]])
    assert got == want


def test_exchange_finds_classes():
    r = np.random.default_rng(0)
    pairs = np.zeros((42, 42))
    for _ in range(20_000):  # items 2 to 21 are followed by 22 to 41 and the other way round
        a = r.integers(2, 22)
        b = r.integers(22, 42)
        pairs[a, b] += 1
        pairs[b, r.integers(2, 22)] += 1
    classes = brown_lm.exchange(pairs, classes=3)
    assert len(set(classes[2:22])) == 1 and len(set(classes[22:])) == 1 and classes[2] != classes[22]


# --- 5 and 6 ---------------------------------------------------------------------------------------------------------

def base_measures(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    spans = collections.defaultdict(list)
    for i in range(len(ws) - 7):
        spans[tuple(ws[i : i + 8])].append(i)
    hit = {i + k for at in spans.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(ws) < 20 or 100 * len(hit) > 30 * len(ws)


def test_quality_rules(docs):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = fertility.quality_rules(docs)
    same(scored, columns, [(i, *base_measures(t)) for i, t in sample_texts()])
    rows = scored.collect()
    assert not any(r.kept and r.base_failed for r in rows)
    assert next(r for r in rows if r.doc_id == 28).kept
    assert fertility.kept_documents(docs).count() == sum(r.kept for r in rows)


def test_fertility_by_library():
    text = "The quick brown fox, naïve café 日本 runs " * 3
    got = dict(zip([f.split()[0] for f in fertility.FIELDS.split(", ")], next(fertility.measure([text.encode()], fertility.pieces(fertility.model_path(None))))))
    model = fertility.pieces(fertility.model_path(None)).model
    ids = [i for w in text.split() for i in model.encode(w)]
    p = np.array(list(collections.Counter(ids).values())) / len(ids)
    assert got["n_tokens"] == len(ids) and got["chars_per_token"] == pytest.approx(len(text.replace(" ", "")) / len(ids))
    assert got["entropy"] == pytest.approx(-(p * np.log2(p)).sum())
    assert got["script"] == "latin"


def test_fertility_fences_reject_what_the_corpus_does_not_look_like(spark):
    r = random.Random(4)
    parts = ["the", "in", "er", "an", "re", "on", "at", "en", "or", "is", "al", "st", "ing", "ed", "con", "pro"]
    lexicon = ["".join(r.choice(parts) for _ in range(r.randrange(2, 5))) for _ in range(3000)]
    good = [(i, " ".join(r.choice(lexicon) for _ in range(80))) for i in range(1200)]
    # junk that passes the base rule and the outer bands: few words, in an order that does not repeat
    junk = [(5000 + i, " ".join(r.choice(lexicon[:12]) for _ in range(80))) for i in range(40)]
    docs = table(spark, good + junk)
    rows = fertility.quality_rules(docs).collect()
    mine = [x for x in rows if x.doc_id >= 5000 and not x.base_failed]
    assert len(mine) > 20 and not any(x.kept for x in mine)
    assert sum(x.kept for x in rows if x.doc_id < 5000) > 0.98 * len(good)
    kept = {x.doc_id for x in rows if x.kept}
    assert {x.doc_id for x in fertility.kept_documents(docs).collect()} == kept


def expected_fences(rows):
    """Fences by brute force; quartiles as elements of the sorted values."""
    by_script = collections.defaultdict(list)
    for r in rows:
        if not r.base_failed and min(r.n_tokens, r.n_byte_tokens) >= 40:
            share = lambda bits, n: bits / math.log2(min(n, 256))
            by_script[r.script].append((r.chars_per_token, share(r.entropy, r.n_tokens), r.byte_chars_per_token,
                                        share(r.byte_entropy, r.n_byte_tokens)))
    out = {}
    for script, floors in fertility.FLOORS.items():
        found = by_script[script]
        out[script] = list(floors)
        for k in range(4) if found else ():
            values, n = sorted(v[k] for v in found), len(found)
            q1, q2, q3 = (values[max(0, math.ceil(n * p) - 1)] for p in (0.25, 0.5, 0.75))
            out[script][k] = (n * min(q1 - 1.5 * (q3 - q1), 0.9 * q2) + 100 * floors[k]) / (n + 100)
    return out


def above(r, floors):
    """Whether measures lie above the fences, if there are tokens enough."""
    if min(r.n_tokens, r.n_byte_tokens) < 40:
        return True
    mine = (r.chars_per_token, r.entropy / math.log2(min(r.n_tokens, 256)), r.byte_chars_per_token,
            r.byte_entropy / math.log2(min(r.n_byte_tokens, 256)))
    return all(a >= b for a, b in zip(mine, floors))


@pytest.mark.parametrize("n", [0, 12, 400])
def test_fences_by_brute_force(spark, n):
    rows = [(i, prose(i, 60 + i % 50)) for i in range(n)] + [(9000 + i, "это длинный русский текст о погоде " + prose(i, 50)) for i in range(n // 4)]
    rows += [(9500 + i, " ".join(chr(0x430 + (i * k) % 32) * (k % 6 + 1) for k in range(60))) for i in range(n // 3)]
    measured = fertility.quality_rules(table(spark, rows))
    got = fertility.fences(measured)
    want = expected_fences(measured.collect())
    for script in fertility.FLOORS:
        assert list(got[script].values()) == pytest.approx(want[script], rel=1e-9), script
    for r in measured.collect():
        inside = fertility.within(fertility.BANDS[r.script], r.n_tokens, r.chars_per_token, r.byte_share, r.entropy)
        assert r.kept == (not r.base_failed and inside and above(r, want[r.script]))


def test_long_words_are_encoded_whole():
    word = "".join(chr(97 + k * k % 26) for k in range(5_001))
    assert fertility.byte_units()[word.encode()] == np.array(fertility.byte_units().encode(" " + word), np.uint16).tobytes()


def test_exact_groups(docs):
    groups = collections.defaultdict(list)
    lower = lambda t: (t or "").encode().lower()
    for i, t in sample_texts():
        groups[lower(t)].append(i)
    want = []
    for i, t in sample_texts():
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), hashlib.sha256(lower(t)).hexdigest()))
    scored = exact_dedup.exact_groups(docs)
    same(scored, ["doc_id", "keep_id", "group_size", "text_sha256"], want)
    assert scored.where("kept").count() == len(groups)
    rows = exact_dedup.unique_documents(docs).collect()
    assert len(rows) == len(groups) and len({lower(r.text) for r in rows}) == len(groups) and rows[0].key == "k"


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    """With a hash of two values, bytes decide."""
    import pyarrow as pa

    monkeypatch.setattr(exact_dedup, "md5", lambda t: bytes([len(t) % 2]))
    monkeypatch.setattr(exact_dedup, "_unequal", lambda *a: spark.createDataFrame([(bytearray([0]),), (bytearray([1]),)], "h binary"))
    rows = [(1, "aa"), (2, "bb"), (3, "AA"), (4, "c")]
    same(exact_dedup.exact_groups(table(spark, rows)), ["doc_id", "keep_id", "group_size"], [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)])
    assert pa


# --- 7 and 8 ---------------------------------------------------------------------------------------------------------

def labelled(spark, n=400):
    r = random.Random(11)
    bad = ["vilenous", "grubbish", "vilenost"]
    docs, labels = [], []
    for i in range(n):
        toxic = int(r.random() < 0.3)
        w = prose(1000 + i, 40).split()
        if toxic:
            for _ in range(3):
                w[r.randrange(40)] = r.choice(bad)
        good = int(r.random() < 0.8)
        docs.append((i, " ".join(w) if good else " ".join(x + "$$$" for x in w)))
        labels.append((i, good, toxic))
    return table(spark, docs + sample_texts()), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = labelled(spark)
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    mine = [r for r in rows if r.doc_id is not None and r.doc_id > 30 and r.held_out]
    assert mine and sum(r.predicted == truth[r.doc_id] for r in mine) > 0.95 * len(mine)
    assert all(r.evidence for r in mine if r.predicted)


def plain_terms(text):
    """Counts of words without marks around them and of their beginnings."""
    out = collections.Counter()
    for w in text.lower().split():
        w = w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        out.update([w] * bool(w) + ["^" + w[:k] for k in (4, 5) if len(w) > k])
    return out


class PlainNeighbours:
    """Vocabulary, weights, cosines, votes and calibration without index, bounds, blocks or matrices."""

    def __init__(self, texts, truth):
        self.truth, n, bad = truth, len(texts), sum(truth)
        found = [plain_terms(t) for t in texts]
        df, toxic = collections.Counter(), collections.Counter()
        for f, y in zip(found, truth):
            df.update(f.keys())
            toxic.update({t: y for t in f})
        self.weight = {}
        for t, d in df.items():
            a, c = toxic[t] + 0.5, d - toxic[t] + 0.5
            odds = math.log(a / (bad + 1)) - math.log(c / (n - bad + 1)) - math.sqrt(1 / a + 1 / c)
            self.weight[t] = math.log((n + 1) / (d + 0.5)) * (1 + max(odds, 0) ** 2)
        self.rate = (bad + 0.5) / (n + 1)
        self.vectors = [self.vector(f) for f in found]
        votes = [self.vote(v, k) for k, v in enumerate(self.vectors)]
        self.points = self.steps(votes)

    def vector(self, counts):
        v = {t: (1 + math.log(c)) * self.weight[t] for t, c in counts.items() if t in self.weight}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    def vote(self, v, without=-1):
        cosines = [(sum(x * o.get(t, 0.0) for t, x in v.items()), k) for k, o in enumerate(self.vectors) if k != without]
        best = sorted((c for c in cosines if c[0] > 0), reverse=True)[:15]
        if not best:
            return self.rate if not v else None
        weights = [(c * c, self.truth[k]) for c, k in best]
        return (sum(w * y for w, y in weights) + 0.02 * self.rate) / (sum(w for w, _ in weights) + 0.02)

    def steps(self, votes):
        """Isotonic fit by its min-max formula, then the steps as runs of one value."""
        rows = sorted((v if v is not None else self.rate, y) for v, y in zip(votes, self.truth))
        mean = lambda xs: sum(xs) / len(xs)
        ys = [y for _, y in rows]
        fit = [max(min(mean(ys[a : b + 1]) for b in range(i, len(ys))) for a in range(i + 1)) for i in range(len(ys))]
        points, top = [], 0
        for _, run in itertools.groupby(range(len(ys)), key=lambda i: round(fit[i], 12)):
            run = list(run)
            top = max(top, (sum(ys[i] for i in run) + 0.5) / (len(run) + 1))
            points.append((mean([rows[i][0] for i in run]), top))
        return [(0.0, points[0][1] / 2), *points, (1.0, (1 + points[-1][1]) / 2)]

    def score(self, text):
        v = self.vector({t: c for t, c in plain_terms(text).items()}) if any(t in self.weight for t in plain_terms(text)) else {}
        vote = self.vote(v)
        return self.rate if not v or vote is None else float(np.interp(vote, *zip(*self.points)))


def test_toxicity_by_brute_force(spark):
    """Vocabulary, examples, neighbours, votes and calibration, over more blocks and rare terms than one."""
    r = random.Random(8)

    def text(toxic):
        ws = [f"{r.choice('abcdefgh')}{int(r.paretovariate(0.5)) % 900}word" for _ in range(r.randrange(3, 40))]
        ws += r.sample(["nasty", "nastily,", "vile", "mild"], r.randrange(1, 3)) if toxic or r.random() < 0.1 else []
        r.shuffle(ws)
        return " ".join(ws)

    rows = [(i, text(i % 5 == 0)) for i in range(420)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows if i % 7], "doc_id long, toxic int")
    train = [(t, int(i % 5 == 0)) for i, t in rows if i % 7 and zlib.crc32(str(i).encode()) % 5]
    plain = PlainNeighbours([t for t, _ in train], [y for _, y in train])
    rows += [(1000, ""), (1001, None), (1002, "unseen"), (1003, "nasty"), (1004, "w " * 3000)]
    docs = table(spark, rows)
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(plain.score(t or ""), abs=2e-4), i
    assert len(set(got.values())) > 300


def test_block_max_search_is_exact():
    r = random.Random(2)
    vectors = []
    for _ in range(1500):
        some = {int(r.paretovariate(0.4)) % 4000: r.randrange(1, 5) for _ in range(r.randrange(30))}
        keys = np.array(sorted(some), np.uint64)
        vectors.append((keys, np.array([some[int(k)] for k in keys], np.int64)))
    index = toxicity.build_index(vectors, np.array([r.randrange(2) for _ in vectors]), list(range(1500))).ready()
    dense = np.zeros((len(index.ids), len(index.terms)))
    for place, i in enumerate(index.ids):
        terms, w = index.vector(*vectors[i])
        dense[place, terms] = w
    some = [index.vector(*v) for v in vectors[:200]]
    for (terms, w), common in zip(some, index.common(some)):
        if len(terms):
            want = np.sort(dense[:, terms] @ w)[::-1][: toxicity.NEIGHBOURS]
            where, cosines = index.nearest(terms, w, common)
            assert len(cosines) == (want > 0).sum() and np.allclose(cosines, want[want > 0], atol=1e-6)
            assert np.allclose(dense[where][:, terms] @ w, cosines, atol=1e-6)


def test_rule_ensemble(spark):
    docs, labels = labelled(spark)
    model = rules.learn(docs, labels)
    rows = rules.score(docs, model).collect()
    assert model.rules and str(model)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    mine = [r for r in rows if r.doc_id is not None and r.doc_id > 30 and r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in mine) > 0.95 * len(mine)
    for r in rows[:60]:  # the compiled expression is the model
        x = np.array([[r[s] for s in rules.STATISTICS]])
        total = model.intercept + sum(w for q, w in zip(model.rules, model.weights) if all(t.holds(x)[0] for t in q))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)))


def test_lasso_is_optimal():
    r = np.random.default_rng(1)
    z = (r.random((400, 12)) < 0.4).astype(float)
    y = (r.random(400) < 1 / (1 + np.exp(-(2 * z[:, 0] - 2 * z[:, 3])))).astype(float)
    w, b = rules.lasso(z, y, 0.02, 3000)
    p = 1 / (1 + np.exp(-(z @ w + b)))
    slope = ((z - z.mean(axis=0)) / z.std(axis=0)).T @ (p - y) / len(y)
    assert abs((p - y).mean()) < 1e-4
    assert np.allclose(slope[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-3) and (np.abs(slope) <= 0.02 + 1e-3).all()


# --- 9 ---------------------------------------------------------------------------------------------------------------

def best_score(model, part):
    known = {t: model.automaton.get(t)[1] for t in model.automaton.keys()}
    best = [0.0]
    for e in range(1, len(part) + 1):
        choices = [best[s] + known[part[s:e]] for s in range(max(0, e - 16), e) if part[s:e] in known]
        if part[e - 1] not in known:
            choices.append(best[e - 1] + model.penalty)
        best.append(max(choices))
    return best[-1]


def test_pieces(docs):
    rows = pieces.round_trip(docs).collect()
    assert len(rows) == len(sample_texts()) and all(r.exact for r in rows)
    back = pieces.decode(pieces.encode(docs)).collect()
    same_texts = collections.Counter((r.doc_id, r.text) for r in back)
    assert same_texts == collections.Counter((i, t or "") for i, t in sample_texts())


def test_viterbi_is_optimal():
    model = pieces.pieces_of(pieces.model_path(None))
    for text in [t for t in odd_texts(300) if "▁" not in t]:
        ids, score = model.encode(text)
        assert model.decode(ids) == text
        if text:
            assert score == pytest.approx(best_score(model, model.escaped(text)))
