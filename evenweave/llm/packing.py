"""Packing by cutting stock: column generation over a histogram of lengths, then ranks decide who goes where.

A document's ids end with the id 1. Ids are cut into pieces of ``LENGTH``; the rest of a document is one piece. The
counts of pieces by length, at most ``LENGTH`` numbers, are all the driver sees. Lengths are rounded up to classes of
``UNIT`` ids; a linear program over patterns (multisets of classes that fit a sequence) minimises the number of
sequences: its duals price new patterns by a knapsack dynamic program until none helps by more than ``GAP``. Patterns
are used as often as the solution says, rounded down; the pieces left over, fewer than a pattern's worth per class,
fill further sequences greedily, and the last piece of such a sequence is cut where the sequence ends. What does not
fill a last sequence is cut into sequences of powers of two, which are not padded.

Every piece has a rank among those of its length, found without sorting more than one bucket at a time; rank and length
give sequence and offset by arithmetic on tables whose size depends on ``LENGTH`` only.

A null or empty text is the single id 1. Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.llm.common import id_and_text, utf8, with_id_type
from evenweave.llm.units import ids_of, model_path, packed
from evenweave.session import materialize, new_run_dir

LENGTH = 2048
UNIT = 8
GAP = 1e-3
PULL = 0.8
BUCKET = 512
END = packed([1])


def pieces(docs: DataFrame, model: str | None, id_col: str, text_col: str, length: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: every document cut at multiples of ``length``."""
    path = model_path(model)
    schema = with_id_type(docs, id_col, "start long, length long, ids_crc32 long, doc_tokens long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for batch in batches:
            row, start, size, crc, total = [], [], [], [], []
            for i, text in enumerate(utf8(batch.column(1))):
                data = ids.encode(text) + END
                n = len(data) // 4
                for s in range(0, n, length):
                    part = data[4 * s : 4 * (s + length)]
                    row.append(i), start.append(s), size.append(len(part) // 4)
                    crc.append(zlib.crc32(part)), total.append(n)
            columns = [pa.array(c, pa.int64()) for c in (start, size, crc, total)]
            who = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([who, *columns], names=schema.names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable multiset of sizes that fits."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        n = np.searchsorted(sizes, c, "right")
        best[c] = best[c - 1]
        if n:
            with_item = best[c - sizes[:n]] + values[:n]
            k = int(with_item.argmax())
            if with_item[k] > best[c] + 1e-15:
                best[c], last[c] = with_item[k], k
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= sizes[last[c]]
    return best[capacity], counts


def full_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A first basis: the largest size left and what fills the rest best, as often as the sizes in it last.

    Each pattern uses up one size, and no later one has it, so the basis is triangular and its solution is positive.
    """
    m = len(sizes)
    basis, used, left, open_ = np.zeros((m, m)), np.zeros(m), demand.astype(float), np.ones(m, bool)
    inverse = np.eye(m)
    while open_.any():
        rest = np.flatnonzero(open_)
        most = rest[-1]
        counts = best_pattern(sizes[rest], sizes[rest].astype(float), int(capacity - sizes[most]))[1]
        counts[-1] += 1
        ratios = left[rest] / np.where(counts > 0, counts, 1)
        ends = int(np.where(counts > 0, ratios, np.inf).argmin())
        step = ratios[ends]
        left[rest] -= step * counts
        basis[rest, rest[ends]], used[rest[ends]] = counts, step
        open_[rest[ends]] = False
        enter(inverse, basis[:, rest[ends]], rest[ends])
        for k in np.flatnonzero(open_ & (left < 1e-9)):
            basis[k, k], open_[k] = capacity // sizes[k], False
            enter(inverse, basis[:, k], k)
    return basis, used, inverse


def times_vector(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", matrix, vector)  # small, and free of the threads of a linear algebra library


def enter(inverse: np.ndarray, column: np.ndarray, row: int) -> None:
    """Updates the inverse of the basis, in place, for a column that replaces the one at ``row``."""
    direction = times_vector(inverse, column)
    inverse[row] /= direction[row]
    direction[row] = 0.0
    inverse -= direction[:, None] * inverse[row]


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP):
    """Patterns (one a row) and how often each is used in a fractional solution within ``gap`` of the best.

    Patterns are priced at duals drawn towards the best feasible ones known, at first each size's share of a sequence:
    that keeps the first patterns full. A feasible dual solution bounds the best solution from below.
    """
    m = len(sizes)
    basis, used, inverse = full_patterns(sizes, demand, capacity)
    centre = sizes / capacity
    bound = float(centre @ demand)
    weight = PULL
    for _ in range(40 * m + 200):
        if used.sum() <= bound * (1 + gap):
            break
        duals = inverse.sum(axis=0)
        asked = weight * centre + (1 - weight) * duals
        value, pattern = best_pattern(sizes, asked, capacity)
        lower = float(asked @ demand) / value
        if lower > bound:
            bound, centre = lower, asked / value
        if duals @ pattern <= 1 + 1e-7:  # nothing gained at this pull
            if weight == 0.0:
                break
            weight = 0.0
            continue
        weight = PULL
        direction = times_vector(inverse, pattern)
        positive = np.flatnonzero(direction > 1e-11)
        ratios = used[positive] / direction[positive]
        leaves = positive[ratios.argmin()]
        step = max(0.0, ratios.min())
        used = used - step * direction
        used[leaves] = step
        enter(inverse, pattern, leaves)
        basis[:, leaves] = pattern
    return basis.T, np.maximum(used, 0.0)


@dataclass
class Plan:
    """Where the pieces go, by length and rank; tables of at most a few entries per length.

    ``first[l]`` is the place of the first piece of length l among the pieces of its class, longest first. Slots are
    sorted by class and first place: the pieces from there on fill this slot of one sequence after another.
    ``cuts`` has what the left-over pieces become: (length, rank) -> [(start, length, sequence, offset)].
    """

    first: np.ndarray
    slot_class: np.ndarray
    slot_place: np.ndarray
    slot_pattern: np.ndarray
    pattern_slots: list[list[int]]
    pattern_sequence: np.ndarray
    lengths_by_class: dict[int, tuple[np.ndarray, np.ndarray]]
    cuts: dict[tuple[int, int], list[tuple[int, int, int, int]]]

    def length_at(self, cls: int, place: np.ndarray) -> np.ndarray:
        lengths, ends = self.lengths_by_class[cls]
        return lengths[np.searchsorted(ends, place, "right")]

    def whole(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces that a pattern places; sequence -1 for those left over."""
        cls = -(-lengths // UNIT)
        place = self.first[lengths] + ranks
        sequence, offset = np.full(len(lengths), -1), np.zeros(len(lengths), np.int64)
        base = int(place.max(initial=0)) + int(self.slot_place.max(initial=0)) + 1
        slot = np.searchsorted(self.slot_class * base + self.slot_place, cls * base + place, "right") - 1
        for s in np.unique(slot):
            p = self.slot_pattern[s]
            if p < 0:
                continue
            rows = np.flatnonzero(slot == s)
            turn = place[rows] - self.slot_place[s]
            sequence[rows] = self.pattern_sequence[p] + turn
            for before in self.pattern_slots[p]:
                if before == s:
                    break
                offset[rows] += self.length_at(int(self.slot_class[before]), self.slot_place[before] + turn)
        return sequence, offset


def make_plan(histogram: dict[int, int], length: int = LENGTH) -> Plan:
    """Column generation over the histogram, rounding, and the left-over pieces."""
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    counts = np.array([histogram[x] for x in lengths], np.int64)
    classes = -(-lengths // UNIT)
    first = np.zeros(length + 1, np.int64)
    by_class: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for c in np.unique(classes):
        at = np.flatnonzero(classes == c)
        ends = np.cumsum(counts[at])
        first[lengths[at]] = ends - counts[at]
        by_class[int(c)] = (lengths[at], ends)
    sizes = np.array(sorted(by_class), np.int64)
    demand = np.array([by_class[c][1][-1] for c in sizes.tolist()], np.int64)
    patterns, used = column_generation(sizes, demand.astype(float), length // UNIT)
    times = np.floor(used + 1e-6).astype(np.int64)
    taken = np.zeros(len(sizes), np.int64)
    slots, members, starts, sequences = [], [], [], 0
    for pattern, n in zip(patterns, times):
        items = np.repeat(np.arange(len(sizes)), np.rint(pattern).astype(np.int64))
        need = np.bincount(items, minlength=len(sizes))
        with np.errstate(divide="ignore"):
            n = int(min(n, np.where(need > 0, (demand - taken) // np.maximum(need, 1), n).min()))
        if n <= 0:
            continue
        own = []
        for k in items[::-1]:
            own.append(len(slots))
            slots.append((int(sizes[k]), int(taken[k]), len(members)))
            taken[k] += n
        members.append(own)
        starts.append(sequences)
        sequences += n
    left = [(int(sizes[k]), int(taken[k]), -1) for k in range(len(sizes)) if taken[k] < demand[k]]
    order = sorted(range(len(slots) + len(left)), key=lambda i: (slots + left)[i][:2])
    table = np.array([(slots + left)[i] for i in order], np.int64).reshape(-1, 3)
    new_place = {old: new for new, old in enumerate(order)}
    plan = Plan(first, table[:, 0], table[:, 1], table[:, 2], [[new_place[s] for s in own] for own in members],
                np.array(starts, np.int64), by_class, {})
    plan.cuts = fill_left_over(plan, sizes, taken, demand, sequences, length)
    return plan


def fill_left_over(plan: Plan, sizes, taken, demand, sequence: int, length: int):
    """Greedy sequences of what the rounded patterns leave, largest piece first; the one that would not fit is cut."""
    items = []  # (remaining length, piece length, rank, start within the piece)
    for k, c in enumerate(sizes.tolist()):
        places = np.arange(taken[k], demand[k])
        for size, place in zip(plan.length_at(c, places).tolist(), places.tolist()):
            items.append((size, size, place - int(plan.first[size]), 0))
    items.sort()
    out: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}

    def put(item, n: int, where: int, offset: int):
        rest, size, rank, start = item
        out.setdefault((size, rank), []).append((start, n, where, offset))
        return (rest - n, size, rank, start + n)

    import bisect

    total = sum(i[0] for i in items)
    while total >= length:
        room = length
        while room:
            k = bisect.bisect_right(items, (room, length + 1)) - 1
            item = items.pop(max(k, 0))
            rest = put(item, min(item[0], room), sequence, length - room)
            room -= min(item[0], room)
            if rest[0]:
                bisect.insort(items, rest)
        total -= length
        sequence += 1
    while total:  # powers of two need no padding
        room = size = 1 << (total.bit_length() - 1)
        while room:
            k = bisect.bisect_right(items, (room, length + 1)) - 1
            item = items.pop(max(k, 0))
            rest = put(item, min(item[0], room), sequence, size - room)
            room -= min(item[0], room)
            if rest[0]:
                bisect.insort(items, rest)
        total -= size
        sequence += 1
    return out


def ranked(found: DataFrame, histogram: dict[int, int], run: str) -> DataFrame:
    """Adds each piece's rank among the pieces of its length. Frequent lengths are spread over buckets."""
    spread = {n: -(-c // BUCKET) for n, c in histogram.items() if c > BUCKET}
    parts = F.lit(1)
    if spread:  # at most as many entries as there are lengths
        table = F.create_map(*[F.lit(x) for pair in spread.items() for x in pair])
        parts = F.coalesce(F.element_at(table, F.col("length").cast("int")), F.lit(1))
    keyed = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), parts).cast("int"))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = keyed.withColumn("nth", F.row_number().over(inside))
    return numbered.join(materialize(offsets, f"{run}/offsets"), ["length", "bucket"]).withColumn(
        "rank", F.col("base") + F.col("nth") - 1
    ).drop("bucket", "base", "nth")


def pack(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    run = new_run_dir(docs.sparkSession)
    found = materialize(pieces(docs, model, id_col, text_col, length), f"{run}/pieces")
    histogram = {int(r[0]): int(r[1]) for r in found.groupBy("length").count().collect()}  # at most `length` rows
    if not histogram:
        return found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    plan = make_plan(histogram, length)
    schema = T.StructType([
        *found.schema.fields, *T.StructType.fromDDL("sequence_id long, offset long, from long, whole long, crc long").fields
    ])
    placed = ranked(found, histogram, run).mapInArrow(lambda batches: _place(batches, plan, schema.names), schema)
    placed = materialize(placed, f"{run}/placed")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = _cut_again(docs, placed.where("ids_crc32 IS NULL"), model, id_col, text_col)
    return placed.where("ids_crc32 IS NOT NULL").select(names).unionByName(cut.select(names))


def _place(batches: Iterator[pa.RecordBatch], plan: Plan, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Sequence and offset; pieces that are cut have a row for each part, without a checksum as yet."""
    for batch in batches:
        col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("start", "length", "ids_crc32", "doc_tokens", "rank")}
        sequence, offset = plan.whole(col["length"], col["rank"])
        rows = np.flatnonzero(sequence >= 0)
        take, parts = rows.tolist(), [
            col["start"][rows], col["length"][rows], col["ids_crc32"][rows], sequence[rows], offset[rows]
        ]
        more = []
        for i in np.flatnonzero(sequence < 0).tolist():
            for s, n, q, o in plan.cuts[int(col["length"][i]), int(col["rank"][i])]:
                same = n == col["length"][i]
                more.append((i, int(col["start"][i]) + s, n, int(col["ids_crc32"][i]) if same else None, q, o))
        take += [m[0] for m in more]
        at = pa.array(take, pa.int64())
        start, size, crc, seq, off = (
            pa.array([*p.tolist(), *(m[k + 1] for m in more)], pa.int64()) for k, p in enumerate(parts)
        )
        old = lambda name: batch.column(name).take(at)
        yield pa.RecordBatch.from_arrays(
            [old("doc_id"), start, size, crc, old("doc_tokens"), seq, off, old("start"), old("length"), old("ids_crc32")],
            names=names,
        )


def _cut_again(docs: DataFrame, cut: DataFrame, model: str | None, id_col: str, text_col: str) -> DataFrame:
    """Checksums of the parts of pieces that were cut: at most one piece a left-over sequence, so few documents."""
    path = model_path(model)
    parts = F.broadcast(cut.drop("ids_crc32").withColumn("hid", F.xxhash64("doc_id")).drop("doc_id"))
    texts = id_and_text(docs, id_col, text_col).withColumn("hid", F.xxhash64("doc_id"))
    met = texts.join(parts, "hid").drop("hid")
    schema = T.StructType([cut.schema["doc_id"], *(cut.schema[n] for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for batch in batches:
            at = {n: batch.column(n).to_pylist() for n in batch.schema.names if n not in ("doc_id", "text")}
            rows, crcs = [], []
            text_before, data = None, b""
            for i, text in enumerate(utf8(batch.column("text"))):
                if text != text_before:
                    text_before, data = text, ids.encode(text) + END
                whole = data[4 * at["from"][i] : 4 * (at["from"][i] + at["whole"][i])]
                if len(data) // 4 == at["doc_tokens"][i] and zlib.crc32(whole) == at["crc"][i]:
                    rows.append(i)
                    crcs.append(zlib.crc32(data[4 * at["start"][i] : 4 * (at["start"][i] + at["length"][i])]))
            take = pa.array(rows, pa.int64())
            columns = [pa.array(crcs, pa.int64()) if n == "ids_crc32" else batch.column(n).take(take) for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return met.mapInArrow(run, schema).dropDuplicates(["sequence_id", "offset"])
