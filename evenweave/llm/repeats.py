"""Repeated passages, byte for byte: maximal repeats from interval trees over enhanced suffix arrays.

A passage of ``LEAST`` bytes that starts earlier too - in a document of a smaller id, or earlier in the same one - is
removed from the later places. All is judged on the texts as they come in. Matches never cross documents.

1. Anchors bring equal passages together. Of the ``GRAM``-byte grams inside any ``LEAST`` bytes the one of the least
   hash is an anchor, so equal passages have an anchor in common at the same place. About one byte in 35 starts an anchor. Only
   grams that occur twice go on; a bit table of fixed size keeps most others from being shuffled.
2. An anchor's context is all that a passage around it can reach. Equal contexts form one class; all its places but the first
   are covered whole. So interiors of copies and shared passages are settled by a window over 16 bytes a row, and
   their number of copies costs nothing later. Anchors that many documents share are salted: first the earliest place of each salt,
   then of these.
3. Where an anchor has several classes, the contexts of the classes' first places are read, as far as their passages choose this
   anchor (a passage lies in one context only, also where a text repeats itself every few bytes), and joined by gram. A task
   sorts their suffixes into a suffix array with common-prefix lengths, and scans it with a stack for the intervals of at
   least ``LEAST`` bytes. An interval whose places are preceded by different bytes is a maximal repeat, with all its
   places. Suffixes in no such interval are left out before sorting.
4. An anchor with more classes than a task should hold (``GROUP``, or a 2^16th of all) is divided. The passages of a context are
   taken in at most two parts; all passages of a part have its middle bytes in common, 65 with the gram among them,
   so equal passages lie in parts of equal middles. Parts whose middle no other has are done, few equal ones go through 3, and
   only those that are again too many are divided further: six passages at a time, with 95 bytes in common, and at last one by
   one by their hashes, again salted.

Results are exact but for collisions of 128-bit hashes. Texts are read again only for documents that hold a first place of
3 and 4 or lose some but not all bytes. Ids are integers; null ids come before all others. Rows that share an id count in the
order of the hash of their texts; rows alike in id and text are one document. Null, empty and short texts lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenweave.llm.common import bit_table, bits_as_array, id_and_text, in_bit_table, maybe_in, utf8
from evenweave.session import materialize, new_run_dir

LEAST = 100
GRAM = 32
GROUP = 1024  # contexts of one gram that a task may hold
MOST_HOT = 1 << 16  # grams treated apart because they hold more than this share of all rows
SALTS = 64
FINE = 6  # passages of a crowded gram taken together before they are told apart one by one
UNIT = 2048  # contexts solved together
CHUNK = 1 << 17  # symbols hashed at once; arrays of this size stay in a core's cache
_OUTSIDE = 256  # the symbol before and behind a text
_LOW = np.uint64(CHUNK - 1)
_SHIFT = np.uint64(32)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
PLACE = ("d", "row", "pos")


def _letters() -> np.ndarray:
    """A random-looking number for every byte and for what lies outside."""
    x = (np.arange(1, 258, dtype=np.uint64)) * _ODD
    for _ in range(3):
        x = (x ^ (x >> _SHIFT)) * _MIX
    return x ^ (x >> _SHIFT)


_LETTERS = _letters()


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbours from their hashes."""
    x = a >> _SHIFT
    x ^= a
    x *= _ODD
    x += b
    return x


def _final(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MIX
    return x ^ (x >> _SHIFT)


def window_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive symbols, by doubling."""
    h, width = _LETTERS[symbols], 1
    while width * 2 <= size:
        h = _both(h[:-width], h[width:])
        width *= 2
    if width < size:
        h = _both(h[: len(h) - (size - width)], h[size - width :])
    return _final(h)


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (size - width)], x[size - width :]) if width < size else x


def _segments(texts: list[bytes], least: int) -> Iterator[tuple[int, int, bytes, int, int]]:
    """(document, place of the segment, its bytes, first window, number of windows); long texts in overlapping ones."""
    step = CHUNK // 2
    for i, text in enumerate(texts):
        windows = len(text) - least + 1
        for a in range(0, max(windows, 0), step):
            b = min(a + step, windows)
            low = max(0, a - least)
            yield i, low, text[low : b + 2 * least], a - low, b - a


def anchors(texts: list[bytes], least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of all texts together: document, place, gram hash and context hash of every anchor."""
    parts, held, size = [], [], 0
    for seg in _segments(texts, least):
        if held and size + len(seg[2]) + least > CHUNK - 2 * least:
            parts.append(_anchors_of(held, least, gram))
            held, size = [], 0
        held.append(seg)
        size += len(seg[2]) + least
    if held:
        parts.append(_anchors_of(held, least, gram))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    doc, pos, fp, ctx = (np.concatenate(c) for c in zip(*parts))
    once = np.ones(len(doc), bool)  # segments of one text overlap
    once[1:] = (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1])
    return doc[once], pos[once], fp[once], ctx[once]


def _anchors_of(segments: list, least: int, gram: int) -> tuple[np.ndarray, ...]:
    n = sum(len(s[2]) + least for s in segments) + least
    symbols = np.full(n, _OUTSIDE, np.int32)
    at, origin, first, count = least, [], [], []
    for _, low, data, skip, windows in segments:
        symbols[at : at + len(data)] = np.frombuffer(data, np.uint8)
        origin.append(at - low), first.append(at + skip), count.append(windows)
        at += len(data) + least
    h = window_hashes(symbols, gram)
    # Least hash first, and of equal ones the last: its place is in the low bits.
    keys = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
    best = (_LOW - (_sliding_least(keys, least - gram + 1) & _LOW)).astype(np.int64)
    count, first = np.array(count), np.array(first)
    of = np.repeat(np.arange(len(segments)), count)
    window = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]
    place = best[window]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    place, of = place[new], of[new]
    before, after = least - gram, least
    ctx = np.zeros(len(place), np.uint64)
    for shift in [*range(-before, after - gram, gram), after - gram]:
        ctx = _both(_final(ctx), h[place + shift])
    documents = np.array([s[0] for s in segments])
    # Anchors have small hashes; mixed again, all their bits are alike.
    return documents[of], place - np.array(origin)[of], _final(h[place] * _ODD), _final(ctx)


def own_passages(pieces: list[bytes], leads: list[int], least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Of contexts whose anchors lie ``leads`` bytes behind their start: first passage that chooses the anchor, and number of these."""
    before, width = least - gram, 2 * least - gram
    shift = before - np.array(leads, np.int64)  # all anchors in one column
    flat = b"".join((bytes(a) + p).ljust(width, b"\0") for a, p in zip(shift.tolist(), pieces))
    h = window_hashes(np.frombuffer(flat, np.uint8).astype(np.int32), gram) & ~_LOW
    h = np.concatenate([h, np.zeros(gram - 1, np.uint64)]).reshape(-1, width)[:, : width - gram + 1]
    ends = shift + np.array([len(p) for p in pieces])
    column = np.arange(before)
    own = h[:, before, None]
    left = (h[:, :before] < own) & (column >= shift[:, None])
    first = np.maximum(shift, np.where(left, column + 1, 0).max(axis=1))
    right = (h[:, before + 1 :] <= own) & (column + before + 1 + gram <= ends[:, None])
    last = np.minimum(np.where(right, column, before).min(axis=1), ends - least)
    return first - shift, last - first + 1


# --- maximal repeats of the contexts of one task -----------------------------------------------------------------------

_MIXED = -1


class Suffixes:
    """Enhanced suffix array of pieces of text, of those suffixes that can take part in a maximal repeat.

    ``places`` are (piece, offset) in the order of the suffixes, ``left`` the symbol before each; a piece's first suffix has
    one of its own, as nothing is known before it.
    """

    def __init__(self, pieces: list[bytes], least: int):
        self.least, self.places, self.left, self.suffixes = least, [], [], []
        flat = b"".join(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(sizes)
        if len(flat) < least:
            return
        symbols = np.frombuffer(flat, np.uint8).astype(np.int32)
        piece = np.repeat(np.arange(len(pieces)), sizes)
        start = np.flatnonzero(np.arange(len(flat)) + least <= ends[piece])
        if len(start) < 2:
            return
        h = window_hashes(symbols, least)[start]
        left = np.where(start > (ends - sizes)[piece[start]], symbols[start - 1], _OUTSIDE + piece[start])
        order = np.argsort(h, kind="stable")
        h, start, left = h[order], start[order], left[order]
        bounds = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        many = np.diff(np.append(bounds, len(h)))
        # Suffixes that share their first bytes but are all preceded by the same byte hold no maximal repeat.
        diverse = (many > 1) & (np.minimum.reduceat(left, bounds) != np.maximum.reduceat(left, bounds))
        chosen = np.repeat(diverse, many)
        start, left = start[chosen], left[chosen]
        of = piece[start]
        text = [flat[a:b] for a, b in zip(start.tolist(), ends[of].tolist())]
        order = sorted(range(len(text)), key=text.__getitem__)
        offset = (start - (ends - sizes)[of]).tolist()
        of, left = of.tolist(), left.tolist()
        self.suffixes = [text[i] for i in order]
        self.places = [(of[i], offset[i]) for i in order]
        self.left = [left[i] for i in order]

    def intervals(self, rank: list[int] | None = None, shared: list[int] | None = None) -> Iterator[tuple[int, int, int]]:
        """Stack scan over common prefixes: (length, first, last) of the intervals that different bytes precede.

        With a ``rank`` of every suffix, ``shared`` is filled with the longest prefix each has in common with one of lower
        rank. Of an interval's parts each has one suffix of lowest rank, for which that is not known yet; the lowest of these goes
        on to the interval around, the others share the interval's prefix. So each suffix is met once.
        """
        suffixes, left, least = self.suffixes, self.left, self.least
        stack: list[list[int]] = []  # common prefix, first suffix, the byte before all of them, the suffix of lowest rank
        for i in range(1, len(suffixes) + 1):
            common = _common(suffixes[i - 1], suffixes[i]) if i < len(suffixes) else 0
            first, before, lowest = i - 1, left[i - 1], i - 1
            while stack and stack[-1][0] > common:
                length, first, mine, known = stack.pop()
                before = mine if mine == before else _MIXED
                lowest = _settle(known, lowest, length, rank, shared)
                if before == _MIXED:
                    yield length, first, i - 1
            if common >= least:
                if stack and stack[-1][0] == common:
                    top = stack[-1]
                    if top[2] != before:
                        top[2] = _MIXED
                    top[3] = _settle(top[3], lowest, common, rank, shared)
                else:
                    stack.append([common, first, before, lowest])


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def _settle(a: int, b: int, length: int, rank: list[int] | None, shared: list[int] | None) -> int:
    """The suffix of lower rank; the other one shares ``length`` bytes with it. Equal places are one."""
    if rank is None:
        return a
    if rank[b] < rank[a]:
        a, b = b, a
    if rank[a] < rank[b]:
        shared[b] = length
    return a


def maximal_repeats(pieces: list[bytes], least: int = LEAST) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, places) of every maximal repeat of at least ``least`` bytes; a place is (piece, offset)."""
    array = Suffixes(pieces, least)
    for length, low, high in array.intervals():
        yield length, array.places[low : high + 1]


def _later_places(rows: list[tuple[int, int, int, bytes]], least: int) -> list[tuple[int, int, int, int]]:
    """Covered stretches (d, row, start, end) of contexts (d, row, place, bytes): what starts earlier in another place too."""
    array = Suffixes([r[3] for r in rows], least)
    documents = {d: i for i, d in enumerate(sorted({r[:2] for r in rows}))}
    rank = [documents[rows[p][:2]] << 40 | rows[p][2] + at for p, at in array.places]
    shared = [0] * len(rank)
    for _ in array.intervals(rank, shared):
        pass
    covered: dict[int, list[tuple[int, int]]] = {}
    for (p, at), length in zip(array.places, shared):
        if length:
            covered.setdefault(p, []).append((rows[p][2] + at, rows[p][2] + at + length))
    return [(*rows[p][:2], a, b) for p, spans in covered.items() for a, b in merged(spans)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


# --- Spark jobs ------------------------------------------------------------------------------------------------------

_SPAN = "d long, row long, start int, end int"


def _records(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _gram_counts(texts: DataFrame, least: int) -> DataFrame:
    """fp, n: how often each gram is an anchor, added up within a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, n = np.unique(anchors(utf8(batch.column("text")), least)[2], return_counts=True)
            yield _records({"fp": fp.view(np.int64), "n": n})

    return texts.select("text").mapInArrow(run, "fp long, n long")


def _occurrences(texts: DataFrame, repeated: np.ndarray, hot: list[tuple[int, int]], least: int) -> DataFrame:
    """fp, salt (-1 unless the gram is hot), ctx, d, row, pos of the anchors whose grams may occur twice."""
    known = np.array([h[0] for h in hot], np.int64).view(np.uint64)
    order = np.argsort(known)
    shared = texts.sparkSession.sparkContext.broadcast(
        (repeated, known[order], np.array([h[1] for h in hot], np.int64)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known, salts = shared.value
        for batch in batches:
            doc, pos, fp, ctx = anchors(utf8(batch.column("text")), least)
            some = in_bit_table(bits, fp)
            doc, pos, fp, ctx = doc[some], pos[some], fp[some], ctx[some]
            d, row = (batch.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("d", "row"))
            salt = np.full(len(doc), -1, np.int64)
            if len(known) and len(doc):
                at = np.minimum(np.searchsorted(known, fp), len(known) - 1)
                salt = np.where(known[at] == fp, row % salts[at], -1)
            yield _records({"fp": fp.view(np.int64), "salt": salt.astype(np.int32), "ctx": ctx.view(np.int64), "d": d,
                            "row": row, "pos": pos.astype(np.int32)})

    return texts.mapInArrow(run, "fp long, salt int, ctx long, d long, row long, pos int")


def _earliest(rows: DataFrame, keys: list[str], place: tuple[str, ...] = PLACE) -> DataFrame:
    """``rows`` with ``own``: whether a row holds the earliest place among those of its keys."""
    here = F.struct(*place)
    first = F.first(here).over(Window.partitionBy(*keys).orderBy(*place))
    return rows.withColumn("own", first == here)


def _earliest_salted(rows: DataFrame, keys: list[str], path: str, place: tuple[str, ...] = PLACE) -> DataFrame:
    """As ``_earliest`` over keys that a salt divides (none at -1): within the salts, then among what is left of them."""
    once = materialize(_earliest(rows, [*keys, "salt"], place), path)
    rest = _earliest(once.where("own AND salt >= 0").drop("own"), keys, place)
    return once.where("NOT own OR salt < 0").unionByName(rest.select(*once.columns))


def _contexts(texts: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """fp, hot, d, row, start, place, piece for the ``wanted`` anchors (fp, hot, d, row, pos).

    A piece, from ``place`` on, holds those passages that choose the anchor, so every passage of a text lies in one piece only.
    ``start`` is as far before the anchor as a passage can begin, negative if the text begins later.
    """
    lists = wanted.groupBy("d", "row").agg(F.collect_list(F.struct("fp", "hot", "pos")).alias("places"))
    met = maybe_in(texts, "row", bit_table(wanted, "row")).join(lists, ["d", "row"]).select("d", "row", "text", "places")
    before = least - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            leads: list[int] = []
            d, row = batch.column("d").to_pylist(), batch.column("row").to_pylist()
            for i, text in enumerate(utf8(batch.column("text"))):
                flat = batch.column("places")[i].values
                fps, hots, places = (flat.field(k).to_pylist() for k in range(3))
                for fp, hot, pos in zip(fps, hots, places):
                    leads.append(min(pos, before))
                    piece = text[pos - leads[-1] : pos + least]
                    for column, value in zip(out, (fp, hot, d[i], row[i], pos - before, piece)):
                        column.append(value)
            pieces, places = out.pop(), []
            for a in range(0, len(pieces), UNIT):
                some = slice(a, a + UNIT)
                first, count = (c.tolist() for c in own_passages(pieces[some], leads[some], least))
                pieces[some] = [p[f : f + n - 1 + least] for p, f, n in zip(pieces[some], first, count)]
                places += [s + before - lead + f for s, lead, f in zip(out[4][some], leads[some], first)]
            out += [places, pieces]
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    names = ["fp", "hot", "d", "row", "start", "place", "piece"]
    return met.mapInArrow(run, "fp long, hot boolean, d long, row long, start int, place int, piece binary")


def _repeats_by_suffix(contexts: DataFrame, least: int) -> DataFrame:
    """Covered stretches from the contexts of each gram; several grams are solved together, none is divided."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None

        def solved() -> pa.RecordBatch:
            found = _later_places(held, least)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            columns = list(zip(*found)) if found else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["d", "row", "start", "end"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("fp", "d", "row", "place", "piece")]
            for fp, *rest in zip(*columns):
                if fp != last and len(held) >= UNIT:
                    yield solved()
                    held = []
                held.append(tuple(rest))
                last = fp
        if held:
            yield solved()

    return contexts.select("fp", "d", "row", "place", "piece").repartition("fp").sortWithinPartitions("fp").mapInArrow(run, _SPAN)


def _parts(contexts: DataFrame, width: int, least: int) -> DataFrame:
    """one, two, d, row, start, place, piece: the passages of contexts (d, row, start, place, piece), ``width`` at a time.

    ``one`` and ``two`` hash the bytes that all passages of a part have in common. Parts are counted from ``start``, so that of
    contexts aligned by their gram equal passages come into like parts. Of single passages there is no piece.
    """
    common = least - width + 1
    kinds = "one long, two long, d long, row long, start int, place int" + (", piece binary" if width > 1 else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch.column("piece").to_pylist()
            flat = b"".join(pieces)
            symbols = np.frombuffer(flat, np.uint8).astype(np.int32)
            sizes = np.array([len(p) for p in pieces], np.int64)
            d, row, start, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "row", "start", "place"))
            last = place + sizes - least
            skipped = (place - start) // width
            count = (last - start) // width - skipped + 1
            of = np.repeat(np.arange(len(pieces)), count)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + skipped[of]
            begin = start[of] + nth * width
            origin = (np.cumsum(sizes) - sizes - place)[of]  # of places of the text among the symbols
            at = origin + begin + width - 1
            one = window_hashes(symbols, common)[at] if len(at) else np.zeros(0, np.uint64)
            two = window_hashes(symbols + 1, common)[at] if len(at) else one
            first, final = np.maximum(begin, place[of]), np.minimum(begin + width - 1, last[of])
            columns = {"one": one.view(np.int64), "two": two.view(np.int64), "d": d[of], "row": row[of],
                       "start": begin.astype(np.int32), "place": first.astype(np.int32)}
            if width > 1:
                ends = zip((origin + first).tolist(), (origin + final + least).tolist())
                columns["piece"] = pa.array([flat[a:b] for a, b in ends], pa.binary())
            yield _records(columns)

    return contexts.select("d", "row", "start", "place", "piece").mapInArrow(run, kinds)


def _repeats_by_parts(contexts: DataFrame, least: int, path: str, widths: list[int]) -> DataFrame:
    """Covered stretches of contexts that are too many for a task: by parts of their passages, only crowded ones divided further."""
    width, *narrower = widths
    keys = ["one", "two"]
    parts = _parts(contexts, width, least)
    if not narrower:
        salted = parts.withColumn("salt", F.expr(f"cast(pmod(row, {SALTS}) as int)"))
        later = _earliest_salted(salted, keys, f"{path}/passages", ("d", "row", "place")).where("NOT own")
        return later.select("d", "row", F.col("place").alias("start"), (F.col("place") + least).alias("end"))
    parts = materialize(parts, f"{path}/parts_{width}")
    counts = materialize(parts.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), f"{path}/shared_{width}")
    bound = _bound(counts.agg(F.sum("n")).first()[0] or 0)
    few, crowd = counts.where(F.col("n") <= bound).select(*keys), counts.where(F.col("n") > bound).select(*keys)
    some = maybe_in(parts.join(F.broadcast(crowd), keys, "left_anti"), "one", bit_table(few, "one")).join(few, keys)
    spans = _repeats_by_suffix(some.withColumn("fp", F.col("one")), least)
    if crowd.isEmpty():
        return spans
    return spans.union(_repeats_by_parts(parts.join(F.broadcast(crowd), keys), least, path, narrower))


def _bound(total: int) -> int:
    """Rows of one key that a task may hold; at most ``MOST_HOT`` keys have more."""
    return max(GROUP, total // MOST_HOT)


def _hot(counts: DataFrame, total: int) -> tuple[list[tuple[int, int]], int]:
    """Grams that hold more rows than a task should, at most ``MOST_HOT`` of them, with a number of parts; and that bound."""
    bound = _bound(total)
    rows = counts.where(F.col("n") > bound).select("fp", F.ceil(F.col("n") / bound).alias("parts"))
    return [(r["fp"], r["parts"]) for r in rows.collect()], bound


def removed_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """d, row, n_bytes, spans (maximal removed stretches as start and end, in order) of documents that lose bytes.

    ``d`` is the id, the smallest number for null; ``row`` is the hash of the text.
    """
    run = new_run_dir(docs.sparkSession)
    texts = keyed(docs, id_col, text_col).drop("doc_id")
    counts = _gram_counts(texts, least).groupBy("fp").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n > 1"), f"{run}/grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot, _ = _hot(counts, total)
    repeated = bits_as_array(bit_table(counts, "fp"))

    places = _occurrences(texts, repeated, hot, least)
    places = materialize(_earliest_salted(places, ["fp", "ctx"], f"{run}/places"), f"{run}/classes")
    covered = places.where("NOT own").select(
        "d", "row", F.greatest(F.lit(0), F.col("pos") - (least - GRAM)).alias("start"), (F.col("pos") + least).alias("end"))
    classes = places.where("own")
    several = materialize(classes.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1"), f"{run}/several")
    total = several.agg(F.sum("n")).first()[0] or 0
    crowded, bound = _hot(several, total)
    crowd = docs.sparkSession.createDataFrame(crowded, "fp long, parts long").select("fp")
    few = classes.join(several.where(F.col("n") <= bound).select("fp"), "fp").withColumn("hot", F.lit(False))
    many = classes.join(F.broadcast(crowd), "fp").withColumn("hot", F.lit(True))
    wanted = materialize(few.union(many).select("fp", "hot", *PLACE), f"{run}/wanted")
    contexts = materialize(_contexts(texts, wanted, least), f"{run}/contexts")
    spans = covered.union(_repeats_by_suffix(contexts.where("NOT hot"), least))
    if crowded:
        half = -(-(least - GRAM + 1) // 2 // FINE) * FINE
        spans = spans.union(_repeats_by_parts(contexts.where("hot"), least, run, [half, FINE, 1]))

    lists = spans.groupBy("d", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    sizes = texts.select("d", "row", F.octet_length("text").alias("n_bytes")).distinct()
    return materialize(_merged_spans(lists.join(sizes, ["d", "row"])), f"{run}/removed")


def _merged_spans(lists: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_bytes").to_pylist()
            out = []
            for i, n in enumerate(sizes):
                flat = batch.column("spans")[i].values
                starts, ends = flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)
                order = np.argsort(starts, kind="stable")
                starts, ends = starts[order], np.maximum.accumulate(np.minimum(ends[order], n))
                gap = np.flatnonzero(starts[1:] > ends[:-1])
                first, last = np.concatenate([[0], gap + 1]), np.concatenate([gap, [len(starts) - 1]])
                out.append([{"start": a, "end": b} for a, b in zip(starts[first].tolist(), ends[last].tolist())])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("row"), batch.column("n_bytes"), pa.array(out, kind)],
                names=["d", "row", "n_bytes", "spans"])

    rows = lists.select("d", "row", "n_bytes", "spans")
    return rows.mapInArrow(run, "d long, row long, n_bytes int, spans array<struct<start: int, end: int>>")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, d, row, text: what tells documents apart and in which order they count."""
    base = id_and_text(docs, id_col, text_col)
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    return base.select("doc_id", d.alias("d"), F.xxhash64("text").alias("row"), "text")


def _lost(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])


def kept_texts(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """d, row, kept (bytes) of the documents that lose some but not all of their text."""
    some = removed.where(_lost(F.col("spans")) < F.col("n_bytes")).select("d", "row", "spans")
    texts = keyed(docs, id_col, text_col).select("d", "row", "text")
    met = maybe_in(texts, "row", bit_table(some, "row")).join(some, ["d", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text in enumerate(utf8(batch.column("text"))):
                flat = batch.column("spans")[i].values
                starts, ends = (flat.field(k).to_pylist() for k in range(2))
                out.append(b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("row"), pa.array(out, pa.binary())], names=["d", "row", "kept"])

    return met.select("d", "row", "text", "spans").mapInArrow(run, "d long, row long, kept binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    run = new_run_dir(docs.sparkSession)
    removed = removed_stretches(docs, id_col, text_col, least)
    kept = kept_texts(docs, removed, id_col, text_col).select("d", "row", F.sha2("kept", 256).alias("rest")).distinct()
    kept = materialize(kept, f"{run}/kept")
    facts = removed.select("d", "row", _lost(F.col("spans")).alias("lost"), F.size("spans").alias("parts"))
    own = keyed(docs, id_col, text_col).select(
        "doc_id", "d", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    met = own.join(facts, ["d", "row"], "left").join(kept, ["d", "row"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return met.select(
        "doc_id", "n_bytes", F.coalesce("lost", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("parts", F.lit(0)).cast("long").alias("n_spans"),
        F.when(F.col("lost").isNull(), F.col("whole")).when(F.col("lost") == F.col("n_bytes"), nothing)
        .otherwise(F.col("rest")).alias("kept_sha256"))
