"""Token counts of a byte-level BPE by merging the arrays of many pre-tokens at once, rank by rank.

Pre-tokens of a batch lie one after another in one array of symbols (ragged: an owner per symbol). In every step each
sequence finds the lowest rank among its adjacent pairs and merges all occurrences of that pair, from the left where
they overlap; sequences without a known pair are done and leave the array. What is left of a sequence is its number of
tokens. A merge only makes symbols that later merges use, so this is what one merge at a time gives.

Counts are remembered by unit (see ``units``), up to a bound. Special strings inside texts are one token each, as the
library's default has it. A null or empty text has 0 bytes and 0 tokens.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenweave.llm.common import map_texts
from evenweave.llm.units import PRE_TOKENS, model_path, to_bytes, units

LIMIT = 1024
_NONE = np.iinfo(np.int64).max


class Merges:
    """The merges of a vocabulary file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special tokens that take in what surrounds them are not supported")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.size = max(vocabulary.values()) + 1
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.of_byte = np.zeros(256, np.int64)
        for token, i in vocabulary.items():
            raw = to_bytes(token)
            if len(raw) == 1:
                self.of_byte[raw[0]] = i

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each sequence after all merges."""
        sizes = np.array([len(s) for s in sequences], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), sizes)
        left = np.zeros(len(sequences), np.int64)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lengths = np.diff(np.concatenate([starts, [len(owner)]]))
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = (self.keys[at] == keys) & (owner[:-1] == owner[1:])
            rank = np.concatenate([np.where(known, self.ranks[at], _NONE), [_NONE]])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            left[owner[starts[done]]] = lengths[done]
            hit = np.flatnonzero((rank == np.repeat(lowest, lengths)) & (rank < _NONE))
            if len(hit):
                first = np.concatenate([[True], np.diff(hit) > 1])
                begin = np.flatnonzero(first)[np.cumsum(first) - 1]
                hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
                symbols[hit] = self.merged[at[hit]]
            keep = ~np.repeat(done, lengths)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return left


class Counts(dict):
    """Unit -> number of tokens."""

    BOUND = 1_000_000
    LONGEST = 64

    def __init__(self, path: str):
        self.merges = Merges(path)
        specials = [re.escape(s) for s in self.merges.specials]
        self.split = re.compile("|".join(specials)) if specials else None

    def learn(self, batch: list[list[str]]) -> dict[str, int]:
        """Counts of the new units of a batch; the short ones are kept."""
        if len(self) >= self.BOUND:
            self.clear()
        new = list({u for us in batch for u in us if u not in self})
        parts = [PRE_TOKENS.findall(u) for u in new]
        flat = [p.encode() for ps in parts for p in ps]
        total = np.concatenate([[0], np.cumsum(self.merges.count(flat))])
        ends = np.cumsum([len(ps) for ps in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([[0], total[ends]])).tolist()
        long = {}
        for unit, n in zip(new, counts):
            (self if len(unit) <= self.LONGEST else long)[unit] = n
        return long

    def count(self, texts: list[bytes]) -> list[int]:
        split, specials = [], []
        for text in texts:
            decoded = text.decode("utf-8", "replace")
            found = 0
            if self.split and self.split.search(decoded):
                stretches = self.split.split(decoded)
                found = len(stretches) - 1
                split.append([u for s in stretches for u in units(s)])
            else:
                split.append(units(decoded))
            specials.append(found)
        long = self.learn(split)
        if not long:
            get = self.__getitem__
            return [sum(map(get, us)) + n for us, n in zip(split, specials)]
        return [sum(long[u] if u in long else self[u] for u in us) + n for us, n in zip(split, specials)]


_LOADED: dict[str, Counts] = {}


def counts_of(path: str) -> Counts:
    if path not in _LOADED:
        _LOADED[path] = Counts(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. Map-only."""
    path = model_path(model)

    def rows(texts: list[bytes]):
        return zip(map(len, texts), counts_of(path).count(texts))

    counted = map_texts(docs, "n_bytes long, n_tokens long", rows, id_col, text_col)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
