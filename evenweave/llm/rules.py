"""Quality by a sparse ensemble of rules: tree paths as conjunctions, lasso logistic weights, Spark column expressions.

Boosted shallow trees are grown on statistics of a bounded sample of labelled documents (``labelled.SAMPLE``). Each path
from a root to a node is a rule: a conjunction of comparisons of statistics with thresholds. A lasso logistic
regression keeps few of them. The model is compiled into one column expression over the statistics, so scoring has no
model in the tasks, and the expression shows what it does.

Statistics are shares and means, so a text of any length is judged alike; null and empty texts have all of them 0.
Labels, language, source and id are no inputs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenweave.llm.common import map_texts, remainder, windows, words
from evenweave.llm.labelled import SAMPLE, sample_of
from evenweave.session import materialize, new_run_dir

STATISTICS = [
    "log_words", "word_length", "symbol_share", "mark_share", "digit_share", "upper_share", "bang_share", "bar_share",
    "duplicate_lines", "repeated_windows", "distinct_words", "equal_neighbours", "top_word", "words_per_line",
]
FIELDS = ", ".join(f"{s} double" for s in STATISTICS)
TREES = 24
DEPTH = 3
LEAST_ROWS = 20
CUTS = 32
PENALTY = 0.002
_SYMBOLS = b"#*$%&<>"
_MARKS = b".,;:'\"()-?"
_DIGITS = b"0123456789"
_UPPER = re.compile("[A-Z\\xc0-\\xd6\\xd8-\\xde]")


def statistics(text: bytes) -> tuple[float, ...]:
    ws = words(text)
    n = len(ws)
    if not n:
        return (0.0,) * len(STATISTICS)
    joined = b"".join(ws)
    size = len(joined)
    decoded = joined.decode("utf-8", "replace")

    def share(chars: bytes) -> float:
        return (size - len(joined.translate(None, chars))) / size

    hashes = np.fromiter(map(hash, ws), np.int64, n)
    counts = np.unique(hashes, return_counts=True)[1]
    spans = windows(hashes.view(np.uint64), 8)
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return (
        float(np.log1p(n)), len(decoded) / n, share(_SYMBOLS), share(_MARKS), share(_DIGITS),
        len(_UPPER.findall(decoded)) / len(decoded), share(b"!"), share(b"|"),
        1 - len(set(lines)) / len(lines), 1 - len(np.unique(spans)) / len(spans), len(counts) / n,
        float((hashes[1:] == hashes[:-1]).sum()) / n, float(counts.max()) / n, n / len(lines),
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return map_texts(docs, FIELDS, lambda texts: map(statistics, texts), id_col, text_col)


@dataclass(frozen=True)
class Test:
    """statistic <= cut, or > cut."""

    statistic: int
    below: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.statistic]
        return v <= self.cut if self.below else v > self.cut

    def column(self) -> Column:
        c = F.col(STATISTICS[self.statistic])
        return c <= self.cut if self.below else c > self.cut

    def __str__(self) -> str:
        return f"{STATISTICS[self.statistic]} {'<=' if self.below else '>'} {self.cut:.4g}"


Rule = tuple[Test, ...]


@dataclass
class Model:
    """Rules, their weights and the intercept."""

    rules: list[Rule]
    weights: list[float]
    intercept: float

    def column(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            holds = rule[0].column()
            for test in rule[1:]:
                holds = holds & test.column()
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def __str__(self) -> str:
        lines = [f"{w:+.3f}  {' and '.join(map(str, r))}" for r, w in zip(self.rules, self.weights)]
        return "\n".join([f"{self.intercept:+.3f}", *lines])


def grow(x: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray,
         path: Rule, found: list[Rule], step: np.ndarray) -> None:
    """One regression tree: adds every path to ``found`` and the leaf values to ``step``."""
    g, h = gradient[rows].sum(), curvature[rows].sum()
    best = (1e-6, None, None)
    if len(path) < DEPTH and len(rows) >= 2 * LEAST_ROWS:
        for s, edges in enumerate(cuts):
            if not len(edges):
                continue
            bins = np.searchsorted(edges, x[rows, s], "left")  # bin b: at most edges[b]
            k = len(edges) + 1
            gs = np.cumsum(np.bincount(bins, gradient[rows], k))[:-1]
            hs = np.cumsum(np.bincount(bins, curvature[rows], k))[:-1]
            n = np.cumsum(np.bincount(bins, minlength=k))[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(n < LEAST_ROWS) | (n > len(rows) - LEAST_ROWS)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], s, float(edges[at]))
    if best[1] is None:
        step[rows] = -g / (h + 1)
        return
    _, s, cut = best
    low = x[rows, s] <= cut
    for below, part in ((True, rows[low]), (False, rows[~low])):
        longer = (*path, Test(s, below, cut))
        found.append(longer)
        grow(x, gradient, curvature, cuts, part, longer, found, step)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees for the logistic loss, without repeats."""
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0, 1, CUTS + 1)[1:-1])) for s in range(x.shape[1])]
    score, found = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        step = np.zeros(len(y))
        grow(x, p - y, p * (1 - p) + 1e-6, cuts, np.arange(len(y)), (), found, step)
        score += 0.3 * step
    return list(dict.fromkeys(tuple(sorted(r, key=lambda t: (t.statistic, t.below, t.cut))) for r in found))


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient; the intercept is free."""
    n, m = z.shape
    scale = np.maximum(z.std(axis=0), 1e-3)
    a = np.ascontiguousarray((z - z.mean(axis=0)) / scale)
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c, t = w.copy(), b, 1.0
    rate = 4.0 / (1 + _largest_square(a) / n)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.einsum("ij,j->i", a, v) + c)))
        error = (p - y) / n
        w2 = v - rate * np.einsum("ij,i->j", a, error)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * penalty, 0)
        b2 = c - rate * error.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    weights = w / scale
    return weights, float(b - (weights * z.mean(axis=0)).sum())


def _largest_square(a: np.ndarray) -> float:
    """Largest eigenvalue of a'a by power iteration."""
    v = np.ones(a.shape[1]) / max(1.0, np.sqrt(a.shape[1]))
    top = 1.0
    for _ in range(20):
        v = np.einsum("ij,i->j", a, np.einsum("ij,j->i", a, v))
        top = float(np.sqrt((v * v).sum()))
        if top == 0:
            return 1.0
        v = v / top
    return top


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y):
        return Model([], [], 0.0)
    if y.min() == y.max():
        return Model([], [], float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    rules = tree_rules(x, y)
    if not rules:
        return Model([], [], float(np.log(y.mean() / (1 - y.mean()))))
    held = np.empty((len(y), len(rules)))
    for k, rule in enumerate(rules):
        held[:, k] = np.logical_and.reduce([t.holds(x) for t in rule])
    weights, intercept = lasso(held, y)
    some = np.flatnonzero(np.abs(weights) > 1e-6)
    return Model([rules[k] for k in some], [float(weights[k]) for k in some], intercept)


def learn(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """Model from at most ``most`` labelled documents; only their statistics come to the driver."""
    run = new_run_dir(docs.sparkSession)
    sample = materialize(sample_of(docs, labels, target, most, id_col, text_col), f"{run}/sample")
    rows = with_statistics(sample).join(sample.select("doc_id", "y"), "doc_id").orderBy("doc_id").collect()
    x = np.array([[r[s] for s in STATISTICS] for r in rows], float).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and the statistics. Map-only."""
    scored = with_statistics(docs, id_col, text_col).withColumn("score", model.column())
    return scored.select(
        "doc_id", (remainder("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), *STATISTICS,
    )
