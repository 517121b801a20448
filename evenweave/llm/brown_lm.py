"""Brown class n-grams: exchange clustering assigns words to classes; P(w | v) = P(class w | class v) P(w | class w).

Tokens are the words of the ASCII-lower-cased text and one end per document. The clustering has two steps:

1. The most frequent words and, for all other words, their endings of ``ENDING`` bytes are items, at most ``ITEMS``; the end has
   a class of its own. Item pairs are counted over all training documents; the exchange algorithm moves items
   between classes as long as the likelihood of the class bigrams rises. Every word starts in the class of its item.
2. Every other word that occurs ``LEAST`` times then moves on its own: the classes before and behind all its occurrences are
   counted, and it goes to the class in which they are likeliest. This is done ``ROUNDS`` times, or until few words
   move; a round is one pass over the documents. The number of these words grows with the corpus, up to ``CLUSTERED``, which bounds the table (nine
   bytes a word) that is sent to the tasks; only rarer words and unseen ones keep the class of their ending.

Smoothing: class transitions are drawn towards class frequencies with weight ``PULL``; in each class every word has half a
count more than it has and unseen words share one more half, as in the unigram base. So every context's probabilities
sum to one over the vocabulary plus one unseen word per class.

Counts are of all training documents and stay distributed; sent to the tasks are the counts of at most ``HEAD`` words
of at most ``LONGEST`` bytes. The counts of all other words are joined, and none of these is frequent enough to
make a partition large. A null or empty text is the end alone.

Python's work is by the distinct words of a batch: Arrow splits and numbers the tokens, and classes, places and counts
are looked up once a word and spread over the tokens by their numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.llm.common import id_and_text, most_frequent, remainder
from evenweave.session import materialize, new_run_dir

HELD_OUT = 1
CLASSES = 48
ITEMS = 1024
WORD_ITEMS = 640
ENDING = 3
HEAD = 1 << 17
LONGEST = 256
PULL = 10.0
SWEEPS = 12
LEAST = 8
CLUSTERED = 1 << 19
ROUNDS = 1
FEW = 0.05  # of the words
END = b""  # no word is empty
_ROWS = 1_000_000  # word counts of batches added up together
_HELD = 1 << 21  # occurrences of clustered words put together
_OTHER = 0  # the item of words whose ending is none
_END_ITEM = 1


def chain(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """One chain of all texts, an end and then every text with an end behind it: the tokens as places among the distinct words;
    these words; and where in the chain the texts begin, with the chain's length last.
    """
    if not len(texts):
        return np.zeros(1, np.int64), pa.array([END], pa.large_binary()), np.ones(1, np.int64)
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    coded = parts.flatten().dictionary_encode()
    index, distinct = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary())
    end = pc.index(distinct, pa.scalar(END, pa.large_binary())).as_py()
    if end < 0:
        end, distinct = len(distinct), pa.concat_arrays([distinct, pa.array([END], pa.large_binary())])
    word = index != end  # before leading and behind trailing space stand empty parts
    before = np.concatenate([[0], np.cumsum(word)])[parts.offsets.to_numpy()]
    out = np.full(before[-1] + len(texts) + 1, end, np.int64)
    out[np.arange(before[-1]) + np.repeat(np.arange(1, len(texts) + 1), np.diff(before))] = index[word]
    return out, distinct, before + np.arange(1, len(texts) + 2)


def word_counts(training: DataFrame) -> DataFrame:
    """word, c over all training documents; counted in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).combine_chunks()
            kinds = {"word": pa.binary(), "c_sum": pa.int64()}
            for part in sums.to_batches():
                yield pa.RecordBatch.from_arrays([part.column(c).cast(k) for c, k in kinds.items()], names=["word", "c"])

        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, distinct, _ = chain(batch.column(1))
            n = np.bincount(codes[1:], minlength=len(distinct))
            held.append(pa.table({"word": distinct, "c": n}))
            rows += len(distinct)
            if rows > _ROWS:
                yield from added(held)
                held, rows = [], 0
        if held:
            yield from added(held)

    return training.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Items(dict):
    """Word -> item: its own, its ending's, or that of all others."""

    BOUND = 400_000

    def __init__(self, own: dict[bytes, int], endings: dict[bytes, int]):
        self.own, self.endings = own, endings

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        item = self.own.get(word)
        if item is None:
            item = self.endings.get(word[-ENDING:], _OTHER)
        self[word] = item
        return item

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The items of many words, looked up together."""
        own = np.fromiter(map(self.own.get, words, repeat(-1)), np.int64, len(words))
        ending = np.fromiter(map(self.endings.get, [w[-ENDING:] for w in words], repeat(_OTHER)), np.int64, len(words))
        return np.where(own >= 0, own, ending)


def choose_items(counts: DataFrame) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """The most frequent words, and the most frequent endings of all others."""
    top = counts.where(F.octet_length("word").between(1, LONGEST)).orderBy(F.desc("c"), "word").limit(WORD_ITEMS)
    own = {END: _END_ITEM}
    for r in top.collect():
        own[bytes(r["word"])] = len(own) + 1
    listed = counts.sparkSession.createDataFrame([(bytearray(w),) for w in own], "word binary")
    rest = counts.join(F.broadcast(listed), "word", "left_anti")
    ending = F.expr(f"substring(word, greatest(octet_length(word) - {ENDING - 1}, 1), {ENDING})")
    mass = rest.groupBy(ending.alias("ending")).agg(F.sum("c").alias("c"))
    rows = mass.orderBy(F.desc("c"), "ending").limit(ITEMS - len(own) - 1).collect()
    return own, {bytes(r["ending"]): len(own) + 1 + i for i, r in enumerate(rows)}


def pair_counts(training: DataFrame, make: Callable[[], Items | Classes], size: int) -> np.ndarray:
    """How often b follows a, over all training documents; ``make`` gives a table from words to numbers below ``size``.

    Before the first word stands an end.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = make(), np.zeros(size * size, np.int64)
        for batch in batches:
            codes, distinct, _ = chain(batch.column(1))
            ids = table.numbers(distinct.to_pylist())[codes]
            total += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    summed = training.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = summed.toArrow()  # at most ITEMS squared numbers
    out = np.zeros(size * size)
    out[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each item, by moving one item at a time to where the likelihood of the class bigrams is highest."""
    size = len(pairs)
    order = np.argsort(-pairs.sum(axis=0), kind="stable")
    movable = [int(i) for i in order if i != _END_ITEM]
    k = min(classes, size)
    own = np.zeros(size, np.int64)
    for n, i in enumerate(movable):
        own[i] = 1 + n % max(1, k - 1)
    member = np.zeros((size, k))
    member[np.arange(size), own] = 1
    n = np.einsum("ig,ih->gh", member, np.stack([np.bincount(own, row, k) for row in pairs]))
    for _ in range(sweeps):
        moved = 0
        for i in movable:
            a, itself = own[i], pairs[i, i]
            after, before = np.bincount(own, pairs[i], k), np.bincount(own, pairs[:, i], k)
            n[a] -= after
            n[:, a] -= before
            n[a, a] += itself
            after[a] -= itself
            before[a] -= itself
            gain = (_xlogx(n + after) - _xlogx(n)).sum(axis=1) + (_xlogx(n.T + before) - _xlogx(n.T)).sum(axis=1)
            same = np.diag(n)
            gain -= _xlogx(same + after) + _xlogx(same + before) - 2 * _xlogx(same)
            gain += _xlogx(same + after + before + itself) - _xlogx(same)
            for total, mine in ((n.sum(axis=1), after.sum() + itself), (n.sum(axis=0), before.sum() + itself)):
                gain -= _xlogx(total + mine) - _xlogx(total)
            gain[0] = -np.inf  # the end's class
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            n[b] += after
            n[:, b] += before
            n[b, b] += itself
            own[i] = b
            moved += b != a
        if not moved:
            break
    return own


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


@dataclass
class Clusters:
    """Class of every word: its item's, or its own if it is one of the clustered words."""

    own: dict[bytes, int]
    endings: dict[bytes, int]
    classes: np.ndarray  # of the items
    hashes: np.ndarray  # of the clustered words, ascending
    moved: np.ndarray  # their classes

    def size(self) -> int:
        return int(self.classes.max()) + 1

    def table(self) -> Classes:
        return Classes(self)


class Classes(dict):
    """Word -> class, remembered up to a bound."""

    BOUND = 400_000

    def __init__(self, clusters: Clusters):
        self.items, self.classes = Items(clusters.own, clusters.endings), clusters.classes.tolist()
        self.hashes, self.moved = clusters.hashes, clusters.moved

    def slots(self, words: list[bytes]) -> np.ndarray:
        """Places among the clustered words, -1 for others."""
        if not len(self.hashes) or not words:
            return np.full(len(words), -1)
        h = np.fromiter(map(word_hash, words), np.uint64, len(words))
        at = np.minimum(self.hashes.searchsorted(h), len(self.hashes) - 1)
        own = np.fromiter(map(self.items.own.__contains__, words), bool, len(words))
        return np.where((self.hashes[at] == h) & ~own, at, -1)

    def numbers(self, words: list[bytes], slots: np.ndarray | None = None) -> np.ndarray:
        """The classes of many words, looked up together; ``slots`` are their places if these are known."""
        of = np.array(self.classes)[self.items.numbers(words)]
        if len(self.hashes):
            slots = self.slots(words) if slots is None else slots
            of = np.where(slots >= 0, self.moved[slots], of)
        return of

    def slot(self, word: bytes) -> int:
        """Place among the clustered words, -1 for others."""
        h = word_hash(word)
        at = int(self.hashes.searchsorted(np.uint64(h))) if len(self.hashes) else 0
        return at if at < len(self.hashes) and int(self.hashes[at]) == h and word not in self.items.own else -1

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        slot = self.slot(word)
        value = self[word] = int(self.moved[slot]) if slot >= 0 else self.classes[self.items[word]]
        return value


def words_to_cluster(counts: DataFrame, own: dict[bytes, int]) -> DataFrame:
    """h, word, c: all words of ``LEAST`` occurrences but the items, as far as ``CLUSTERED`` allows."""
    listed = counts.sparkSession.createDataFrame([(bytearray(w),) for w in own], "word binary")
    often = counts.where((F.col("c") >= LEAST) & (F.octet_length("word") <= LONGEST)).join(F.broadcast(listed), "word", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.fromiter(map(word_hash, batch.column(0).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *batch.columns], names=["h", "word", "c"])

    return most_frequent(often, "c", CLUSTERED).select("word", "c").mapInArrow(run, "h long, word binary, c long")


def _contexts(training: DataFrame, clusters: Clusters) -> DataFrame:
    """slot, seen: for each clustered word of some batches a byte per neighbour, its class, plus K if it stands behind.

    Rows of slot -1 - p hold, once a task, how often the class pair p occurred, as eight bytes.
    """
    k = clusters.size()
    shared = training.sparkSession.sparkContext.broadcast(clusters)

    def rows(slots: np.ndarray, seen: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), seen], names=["slot", "seen"])

    def together(held: list[np.ndarray]) -> pa.RecordBatch:
        # slot, class before and class behind in one number; in order, the last two are the bytes wanted
        x = np.sort(np.concatenate(held))
        slot = x >> 16
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        offsets = (2 * np.append(first, len(x))).astype(np.int32)
        data = (x & 0xFFFF).astype(">u2")
        return rows(slot[first], pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, pairs, held, size = shared.value.table(), np.zeros(k * k, np.int64), [], 0
        for batch in batches:
            codes, distinct, _ = chain(batch.column(1))
            listed = distinct.to_pylist()
            slots = table.slots(listed)
            of = table.numbers(listed, slots).astype(np.int64)[codes]
            pairs += np.bincount(of[:-1] * k + of[1:], minlength=k * k)
            slot = slots[codes]
            at = np.flatnonzero(slot >= 0)  # never the first or last of the chain, which are ends
            held.append(slot[at] << 16 | of[at - 1] << 8 | k + of[at + 1])
            size += len(at)
            if size > _HELD:
                yield together(held)
                held, size = [], 0
        if size:
            yield together(held)
        some = np.flatnonzero(pairs)
        yield rows(-1 - some, pa.array([int(n).to_bytes(8, "big") for n in pairs[some]], pa.binary()))

    return training.mapInArrow(run, "slot int, seen binary")


def _pairs_seen(contexts: DataFrame, k: int) -> np.ndarray:
    """The class pairs that ``_contexts`` counted."""
    n = F.conv(F.hex("seen"), 16, 10).cast("long")
    table = contexts.where("slot < 0").groupBy("slot").agg(F.sum(n).alias("n")).toArrow()  # at most K squared numbers
    out = np.zeros(k * k)
    out[-1 - table["slot"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(k, k)


def transitions(between: np.ndarray) -> np.ndarray:
    """log10 of the smoothed class transitions."""
    share = (between.sum(axis=0) + 0.5) / (between.sum() + 0.5 * len(between))
    return np.log10((between + PULL * share) / (between.sum(axis=1, keepdims=True) + PULL))


def _reassign(contexts: DataFrame, clusters: Clusters, between: np.ndarray) -> tuple[np.ndarray, int]:
    """New classes of the clustered words, each the likeliest for its own contexts, and how many words moved.

    A word with c occurrences in class k gives c * log(1 / size of k) and the transitions from and to its neighbours.
    """
    k, end = clusters.size(), int(clusters.classes[_END_ITEM])
    step = transitions(between)
    size = np.log10(between.sum(axis=0) + 1.0)
    some = len(clusters.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts, known = np.full(some, -1, np.int64), np.zeros((1024, 2 * k)), 0
        slots: list[np.ndarray] = []
        for batch in batches:
            slot, seen = batch.column(0).to_numpy(), batch.column(1).cast(pa.large_binary())
            new = np.unique(slot[place[slot] < 0])
            place[new] = known + np.arange(len(new))
            slots.append(new)
            known += len(new)
            while known > len(counts):
                counts = np.concatenate([counts, np.zeros_like(counts)])
            edges = np.frombuffer(seen.buffers()[1], np.int64)[seen.offset : seen.offset + len(seen) + 1]
            codes = np.frombuffer(seen.buffers()[2], np.uint8)[edges[0] : edges[-1]]
            np.add.at(counts.reshape(-1), np.repeat(place[slot] * 2 * k, np.diff(edges)) + codes, 1)
        if known:
            before, behind = counts[:known, :k], counts[:known, k:]
            score = before @ step + behind @ step.T - before.sum(axis=1, keepdims=True) * size
            score[:, end] = -np.inf
            best = score.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(slots).astype(np.int32)), pa.array(best.astype(np.int32))], names=["slot", "k"])

    found = contexts.where("slot >= 0").repartition("slot").mapInArrow(run, "slot int, k int").toArrow()  # at most CLUSTERED rows
    moved = clusters.moved.copy()
    moved[found["slot"].to_numpy()] = found["k"].to_numpy()
    return moved, int((moved != clusters.moved).sum())


def cluster(training: DataFrame, counts: DataFrame, run: str) -> tuple[Clusters, np.ndarray]:
    """Classes of all words, and the counts of the class pairs."""
    own, endings = choose_items(counts)
    size = len(own) + len(endings) + 1
    classes = exchange(pair_counts(training, lambda: Items(own, endings), size))
    rest = words_to_cluster(counts, own).select("h", "word").toArrow()
    hashes = rest["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    items = Items(own, endings)
    start = classes[items.numbers(rest["word"].to_pylist())]
    clusters = Clusters(own, endings, classes, hashes[order], start[order].astype(np.uint8))
    k = clusters.size()
    for turn in range(ROUNDS if len(hashes) else 0):
        contexts = materialize(_contexts(training, clusters), f"{run}/contexts-{turn}")
        moved, n = _reassign(contexts, clusters, _pairs_seen(contexts, k))
        clusters = replace(clusters, moved=moved)
        if n <= FEW * len(hashes):
            break
    return clusters, pair_counts(training, clusters.table, k)


@dataclass
class Model:
    """Everything of bounded size: classes of words, transitions, class sizes, counts of the head words."""

    clusters: Clusters
    transition: np.ndarray  # log10, from row to column
    class_tokens: np.ndarray
    class_words: np.ndarray
    train_tokens: int
    distinct: int
    head: dict[bytes, int]

    def base(self, c):
        return np.log10((c + 0.5) / (self.train_tokens + 0.5 * (self.distinct + 1)))

    def emission(self, c, k):
        return np.log10((c + 0.5) / (self.class_tokens[k] + 0.5 * (self.class_words[k] + 1)))


def learn(training: DataFrame, run: str) -> tuple[Model, DataFrame]:
    """The model of doc_id, text rows, and the counts of all their words."""
    counts = materialize(word_counts(training), f"{run}/counts")
    size = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    clusters, between = cluster(training, counts, run)
    k = clusters.size()
    shared = training.sparkSession.sparkContext.broadcast(clusters)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tokens_of, words_of = shared.value.table(), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            of = table.numbers(batch.column(0).to_pylist()).astype(np.int64)
            np.add.at(tokens_of, of, batch.column(1).to_numpy())
            words_of += np.bincount(of, minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(tokens_of), pa.array(words_of)], names=["k", "n", "v"])

    per_class = counts.mapInArrow(sizes, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    class_tokens, class_words = np.zeros(k), np.zeros(k)
    for r in per_class.collect():
        class_tokens[r["k"]], class_words[r["k"]] = r["n"], r["v"]
    head = most_frequent(counts.where(F.octet_length("word") <= LONGEST), "c", HEAD).toArrow()
    known = dict(zip(head.column(0).to_pylist(), head.column(1).to_pylist()))
    return Model(clusters, transitions(between), class_tokens, class_words, size["n"] or 0, size["v"], known), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, run: str) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score for rows doc_id, text, held_out."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.schema.fields[:1] + [docs.schema["held_out"]] + T.StructType.fromDDL(
        "n_tokens long, n_known long, base_score double, score double, rare array<struct<word:binary,k:int,n:int>>").fields
    schema = T.StructType(fields)
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int32()), ("n", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table, places = model.clusters.table(), {w: i + 1 for i, w in enumerate(model.head)}
        c = np.array([0, *model.head.values()], float)
        k_of = np.append(0, table.numbers(list(model.head))).astype(np.int64)
        base, emitted = model.base(c), model.emission(c, k_of)
        base[0] = emitted[0] = 0.0
        for batch in batches:
            codes, distinct, edges = chain(batch.column(1))
            listed = distinct.to_pylist()
            k_of_word = table.numbers(listed).astype(np.int64)
            k = k_of_word[codes]
            place = np.fromiter(map(places.get, listed, repeat(0)), np.int64, len(listed))[codes]  # 0: not a head word
            values = base[place], model.transition[k[:-1], k[1:]], emitted[place]
            sizes = np.diff(edges)
            of = np.repeat(np.arange(len(sizes)), sizes)  # the text of each token but the first end
            at = np.flatnonzero(place[1:] == 0)
            rare, n = np.unique(of[at] * len(distinct) + codes[1:][at], return_counts=True)
            text, word = np.divmod(rare, len(distinct))
            fields = distinct.take(pa.array(word)).cast(pa.binary()), pa.array(k_of_word[word], pa.int32()), pa.array(n, pa.int32())
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)), pa.int32()),
                pa.StructArray.from_arrays(fields, fields=list(rare_type.value_type)))
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            columns = (sizes, sizes - np.bincount(of[at], minlength=len(sizes)), [values[0][a:b].sum() for a, b in spans],
                       [values[1][a - 1 : b - 1].sum() + values[2][a:b].sum() for a, b in spans])
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(x, t) for x, t in zip(columns, types)), lists], names=schema.names)

    scored = docs.mapInArrow(rows, schema).withColumn("row", F.monotonically_increasing_id())
    scored = materialize(scored, f"{run}/scored")  # written, so a row keeps its number
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    met = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    size = F.lit(float(model.train_tokens) + 0.5 * (model.distinct + 1))
    room = (model.class_tokens + 0.5 * (model.class_words + 1)).tolist()
    class_size = F.element_at(F.array(*map(F.lit, room)), F.col("k") + 1)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / size)).alias("base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / class_size)).alias("emitted"),
    )
    zero = F.lit(0)
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("emitted", F.lit(0.0))).alias("score"),
    )


def brown_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = HELD_OUT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(id) mod 5 is ``held_out`` are scored but not learnt from; a null id is learnt from.
    """
    run = new_run_dir(docs.sparkSession)
    fold = remainder("doc_id") == held_out
    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", fold)
    model, counts = learn(rows.where(~fold).select("doc_id", "text"), run)
    return score(rows, model, counts, run)
