"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words without the marks around them and their beginnings of 4 and 5 characters, so that inflected forms share
terms. A bounded sample of labelled documents (``SAMPLE``), toxic or not, gives the vocabulary - all of its terms - and the
examples - all of its documents. A term weighs (1 + log of its count) times idf, times a factor that grows with the log
odds, less a standard error, of being in a toxic document; no term is left out.

The index keeps postings by block of ``BLOCK`` examples and each term's largest weight in each block. The ``FREQUENT`` terms of
most examples, whose postings are long, are a matrix instead, multiplied with a batch of queries at once. A query's bound of a
block is the largest of these sums in it plus its other terms' block maxima. Blocks are read by falling bound until none
exceeds the worst of the ``NEIGHBOURS`` best cosines so far, so the neighbours are exact. Votes are weighted by the square of
the cosine, with the rate of toxic documents as one more vote of weight ``PRIOR``. A monotone step function, fitted on the votes of
the sample with each example left out, turns votes into probabilities; lines between the middles of its steps keep votes
apart that fall on one step. Documents without any known term, null and empty texts among them, get the rate alone.

All documents are scored; labels, language, source and id are no inputs. Terms are told apart by 64-bit hashes. The sample and
what is made of it pass through the driver, bounded by ``SAMPLE`` documents; everything else stays distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenweave.llm.common import map_texts, remainder, utf8
from evenweave.llm.labelled import sample_of
from evenweave.session import materialize, new_run_dir

SAMPLE = 2500
NEIGHBOURS = 15
BLOCK = 256
FREQUENT = 512
PRIOR = 0.02
EVIDENCE = 5
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def terms_of(word: str) -> list[str]:
    """The terms of a lower-cased word; beginnings carry a mark of their own."""
    core = word.strip(_MARKS)
    return [core, *(f"^{core[:k]}" for k in (4, 5) if len(core) > k)] if core else []


class WordTerms(dict):
    """Word -> hashes of its terms, remembered up to a bound."""

    BOUND = 300_000

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = b"".join(xxhash.xxh3_64_intdigest(t).to_bytes(8, "little") for t in terms_of(word))
        return value

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the terms of a text, ascending, and how often each occurs."""
        ws = text.decode("utf-8", "replace").lower().split()
        return np.unique(np.frombuffer(b"".join(map(self.__getitem__, ws)), "<u8"), return_counts=True)


@dataclass
class Index:
    """Examples as normalised weighted vectors; postings by term, cut at the borders of blocks."""

    terms: np.ndarray  # hashes, ascending
    weight: np.ndarray  # idf times the factor of the odds
    labels: np.ndarray
    ids: list
    starts: np.ndarray  # terms x (blocks + 1): where each block's postings of a term begin
    where: np.ndarray
    value: np.ndarray
    background: float
    steps: tuple[np.ndarray, np.ndarray] = field(default=(np.zeros(0), np.zeros(0)))
    block_max: np.ndarray | None = None
    column: np.ndarray | None = None  # of a frequent term in the matrix, else -1
    matrix: np.ndarray | None = None

    def ready(self) -> Index:
        """With what follows from the postings: block maxima, and the matrix of the frequent terms."""
        n, blocks = len(self.labels), self.starts.shape[1] - 1
        df = self.starts[:, -1] - self.starts[:, 0]
        column = np.full(len(df), -1)
        frequent = np.argsort(-df, kind="stable")[:FREQUENT]
        column[frequent] = np.arange(len(frequent))
        matrix = np.zeros((len(frequent), blocks * BLOCK))
        for j, t in enumerate(frequent.tolist()):
            low, high = self.starts[t, 0], self.starts[t, -1]
            matrix[j, self.where[low:high]] = self.value[low:high]
        low, high = self.starts[:, :-1].ravel(), self.starts[:, 1:].ravel()
        some = np.flatnonzero(high > low)
        most = np.zeros(len(low), np.float32)
        if len(some):
            most[some] = np.maximum.reduceat(self.value, low[some])
        return replace(self, block_max=most.reshape(-1, blocks), column=column, matrix=matrix)

    def common(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent terms give to the cosine of every vector with every example."""
        queries = np.zeros((len(vectors), len(self.matrix)))
        for q, (terms, w) in zip(queries, vectors):
            column = self.column[terms]
            q[column[column >= 0]] = w[column >= 0]
        return queries @ self.matrix

    def vector(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and normalised weights of the known terms."""
        if not len(self.terms) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = self.terms[at] == hashes
        at = at[known]
        w = (1 + np.log(counts[known])) * self.weight[at]
        return at, w / np.sqrt((w * w).sum()) if len(w) else w

    def nearest(self, terms: np.ndarray, w: np.ndarray, common: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the best examples; all that tie at the end are ordered by position."""
        rare = self.column[terms] < 0
        terms, w = terms[rare], w[rare]
        bounds = common.reshape(-1, BLOCK).max(axis=1) + w @ self.block_max[terms]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or len(best) >= NEIGHBOURS and bounds[b] < best[-1] - 1e-6:
                break
            low, high = self.starts[terms, b], self.starts[terms, b + 1]
            n = high - low
            some = np.flatnonzero(n)
            scores = common[b * BLOCK : (b + 1) * BLOCK]
            if len(some):
                low, n = low[some], n[some]
                ends = np.cumsum(n)
                at = np.arange(ends[-1]) + np.repeat(low - ends + n, n)
                scores = scores + np.bincount(self.where[at] - b * BLOCK, np.repeat(w[some], n) * self.value[at], BLOCK)
            hits = np.flatnonzero(scores > (best[-1] - 1e-6 if len(best) >= NEIGHBOURS else 0)) + b * BLOCK
            hits = hits[hits != without]
            best_at, best = np.concatenate([best_at, hits]), np.concatenate([best, np.round(scores[hits - b * BLOCK], 9)])
            order = np.lexsort((best_at, -best))[:NEIGHBOURS]
            best_at, best = best_at[order], best[order]
        return best_at, best

    def vote(self, where: np.ndarray, cosines: np.ndarray) -> float:
        w = cosines**2
        return float(((w * self.labels[where]).sum() + PRIOR * self.background) / (w.sum() + PRIOR))

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list]]:
        """Calibrated probability and the examples that weigh most in it, for (hashes, counts) of several texts."""
        vectors = [self.vector(*f) for f in found]
        for (terms, w), common in zip(vectors, self.common(vectors)):
            where, cosines = self.nearest(terms, w, common) if len(terms) else (np.zeros(0, np.int64), np.zeros(0))
            if not len(where):
                yield self.background, []
                continue
            p = float(np.interp(self.vote(where, cosines), *self.steps)) if len(self.steps[0]) else self.background
            yield p, [(self.ids[i], float(c), int(self.labels[i])) for i, c in zip(where[:EVIDENCE].tolist(), cosines)]


def monotone_steps(votes: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean vote and smoothed rate of each step, rising; rates between follow by lines."""
    middle, good, n = [], [], []
    values, which = np.unique(votes, return_inverse=True)
    for v, g, k in zip(values.tolist(), np.bincount(which, truth).tolist(), np.bincount(which).tolist()):
        middle.append(v), good.append(g), n.append(float(k))
        while len(n) > 1 and good[-2] / n[-2] >= good[-1] / n[-1]:
            v, g, k = middle.pop(), good.pop(), n.pop()
            middle[-1] = (middle[-1] * n[-1] + v * k) / (n[-1] + k)
            good[-1] += g
            n[-1] += k
    rates = np.maximum.accumulate((np.array(good) + 0.5) / (np.array(n) + 1.0))
    return np.array([0.0, *middle, 1.0]), np.array([rates[0] / 2, *rates, (1 + rates[-1]) / 2])


def term_weights(df: np.ndarray, toxic: np.ndarray, n: int, bad: int) -> np.ndarray:
    """idf times 1 + the square of the log odds of toxic less a standard error, where that is above zero."""
    t, c = toxic + 0.5, df - toxic + 0.5
    odds = np.log(t / (bad + 1.0)) - np.log(c / (n - bad + 1.0)) - np.sqrt(1 / t + 1 / c)
    return np.log((n + 1.0) / (df + 0.5)) * (1 + np.maximum(odds, 0.0) ** 2)


def build_index(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: list) -> Index:
    """Index over all examples, (term hashes, counts) each, and its calibration."""
    n, bad = len(labels), int(labels.sum())
    sizes = np.array([len(v[0]) for v in vectors], np.int64)
    flat = np.concatenate([v[0] for v in vectors]) if n else np.zeros(0, np.uint64)
    terms, code = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    df = np.bincount(code, minlength=len(terms))
    weight = term_weights(df, np.bincount(code, labels[owner], len(terms)), n, bad)
    counts = np.concatenate([v[1] for v in vectors]) if n else np.zeros(0)
    w = (1 + np.log(counts)) * weight[code]
    length = np.sqrt(np.bincount(owner, w * w, n))
    w = w / np.maximum(length, 1e-300)[owner]
    # Examples that share their heaviest term lie together, which keeps block maxima low elsewhere.
    heaviest = np.full(n, -1)
    order = np.lexsort((w, owner))
    last = np.cumsum(sizes)[sizes > 0] - 1
    heaviest[sizes > 0] = code[order][last]
    place = np.empty(n, np.int64)
    place[np.argsort(heaviest, kind="stable")] = np.arange(n)
    at = place[owner]
    order = np.lexsort((at, code))
    blocks = max(1, -(-n // BLOCK))
    slot = code[order] * blocks + at[order] // BLOCK
    starts = np.zeros(len(terms) * blocks + 1, np.int64)
    np.cumsum(np.bincount(slot, minlength=len(terms) * blocks), out=starts[1:])
    grid = np.arange(len(terms))[:, None] * blocks + np.arange(blocks + 1)[None, :]
    by_place = np.argsort(place)
    index = Index(
        terms, weight, labels[by_place].astype(float), [ids[i] for i in by_place.tolist()], starts[grid].astype(np.int32),
        at[order].astype(np.int32), w[order].astype(np.float32), (bad + 0.5) / (n + 1.0))
    if n:
        full = index.ready()
        known = [full.vector(*vectors[i]) for i in by_place.tolist()]
        votes = [index.vote(*full.nearest(*v, c, k)) if len(v[0]) else index.background
                 for k, (v, c) in enumerate(zip(known, full.common(known)))]
        index.steps = monotone_steps(np.round(votes, 6), index.labels)
    return index


def learn(docs: DataFrame, labels: DataFrame, target: str = "toxic", most: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> Index:
    """Index over at most ``most`` labelled documents."""
    run = new_run_dir(docs.sparkSession)
    sample = materialize(sample_of(docs, labels, target, most, id_col, text_col), f"{run}/sample")
    kept: list = []

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept[0] if kept else WordTerms()
        for batch in batches:
            found = [words.counts(t) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([f[0].view(np.int64) for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["doc_id", "y", "terms", "counts"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    table = sample.select("doc_id", "text", "y").mapInArrow(rows, f"doc_id {kind}, y int, terms array<long>, counts array<long>")
    found = table.toArrow().sort_by("doc_id").combine_chunks()  # at most `most` rows
    vectors = [(np.array(t.values).view(np.uint64), np.array(c.values)) for t, c in zip(found["terms"], found["counts"])]
    return build_index(vectors, np.array(found["y"].to_pylist(), np.int64), found["doc_id"].to_pylist())


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence. Map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by SAMPLE
    kept: list = []  # one task's terms of words

    def rows(texts: list[bytes]):
        if not kept:
            kept.extend((WordTerms(), shared.value.ready()))
        words, index = kept
        for p, evidence in index.scores([words.counts(t) for t in texts]):
            yield p, [{"example": str(i), "cosine": c, "label": y} for i, c, y in evidence]

    fields = "score double, evidence array<struct<example:string,cosine:double,label:int>>"
    scored = map_texts(docs, fields, rows, id_col, text_col)
    return scored.select(
        "doc_id", (remainder("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )
