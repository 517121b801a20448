"""Texts that contain any of very many terms: sorted tables of all terms, one pass over every text.

A search per term costs time by the length of the list; here every place of a text is looked up by its next eight bytes,
whatever the number of terms. A term that begins with another one is left out, as a text that holds it holds the other too. So
at most one of the sorted terms can begin at a place, the last that is not greater than the text from there.

The tables take some 30 bytes a term beyond its own. Terms are grouped so that a group stays below ``MOST_CHARACTERS``; of a
longer list each group is one more pass, whose result is written before the next, in which only texts without a hit are
read. So a task holds one group at a time, and any list fits in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.session import materialize, new_run_dir

MOST_CHARACTERS = 32_000_000  # bytes of UTF-8
BLOCK = 1 << 19  # places looked up together
_WORD = 8
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def term_groups(terms: DataFrame, column: str) -> list[DataFrame]:
    """Distinct lower-cased terms, empty ones left out, in groups of at most about ``MOST_CHARACTERS``."""
    found = terms.select(F.lower(column).alias("term")).where("term <> ''").distinct()
    size = found.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    groups = max(1, -(-size // MOST_CHARACTERS))
    if groups == 1:
        return [found]
    found = materialize(found, f"{new_run_dir(terms.sparkSession)}/terms")
    place = F.pmod(F.xxhash64("term"), F.lit(groups))
    return [found.where(place == k) for k in range(groups)]


class Terms:
    """Which texts contain any of the terms."""

    def __init__(self, terms: list[bytes]):
        kept: list[bytes] = []
        for term in sorted(terms):
            if not kept or not term.startswith(kept[-1]):
                kept.append(term)
        long = [t for t in kept if len(t) >= _WORD]
        self.blob = b"".join(long)
        self.ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, long), np.int64, len(long)))])
        self.keys: dict[int, np.ndarray] = {}  # by length, ascending; of all long terms their first eight bytes
        for length in range(1, _WORD + 1):
            of = long if length == _WORD else [t for t in kept if len(t) == length]
            if of:
                self.keys[length] = np.fromiter((int.from_bytes(t[:length], "big") for t in of), np.uint64, len(of))
        self._bits: dict[int, tuple[np.uint64, np.ndarray]] = {}

    def __len__(self) -> int:
        return sum(map(len, self.keys.values()))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_bits": {}}

    def _maybe(self, length: int, key: np.ndarray) -> np.ndarray:
        """Places of the keys that a bit table, of 16 to 32 bits a term, does not rule out."""
        if length not in self._bits:
            own = self.keys[length]
            wide = min(26, max(10, (16 * len(own)).bit_length()))
            table = np.zeros(1 << (wide - 3), np.uint8)
            h = (own * _SPREAD) >> np.uint64(64 - wide)
            np.bitwise_or.at(table, h >> np.uint64(3), np.uint8(1) << (h & np.uint64(7)).astype(np.uint8))
            self._bits[length] = np.uint64(64 - wide), table
        shift, table = self._bits[length]
        h = (key * _SPREAD) >> shift
        return np.flatnonzero((table[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1)

    def hits(self, texts: pa.Array) -> np.ndarray:
        """A flag per text; null texts contain none."""
        texts = texts.cast(pa.large_binary())
        out = np.zeros(len(texts), bool)
        _, offsets, data = texts.buffers()
        if data is None or not len(texts):
            return out
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data, last = memoryview(data).cast("B"), int(offsets[-1])
        for start in range(int(offsets[0]), last, BLOCK):
            n = min(BLOCK, last - start)
            piece = bytes(data[start : min(last, start + n + _WORD)]).ljust(n + 2 * _WORD, b"\0")
            words = np.empty(n, np.uint64)  # the eight bytes from each place on
            for o in range(min(_WORD, n)):
                part = words[o::_WORD]
                part[:] = np.frombuffer(piece, ">u8", len(part), o)
            for length, keys in self.keys.items():
                key = words >> np.uint64(8 * (_WORD - length))
                at = self._maybe(length, key)
                key = key[at]
                low = keys.searchsorted(key)
                known = keys[np.minimum(low, len(keys) - 1)] == key
                at, key, low = at[known] + start, key[known], low[known]
                of = offsets.searchsorted(at, "right") - 1
                fits = (at + length <= offsets[of + 1]) & ~out[of]
                if length < _WORD:
                    out[of[fits]] = True
                else:
                    high = keys.searchsorted(key[fits], "right")
                    self._compare(data, offsets, at[fits], of[fits], low[fits], high, out)
        return out

    def _compare(self, data: memoryview, offsets: np.ndarray, at, of, low, high, out: np.ndarray) -> None:
        """Whether a long term begins at any of the places ``at`` of the texts ``of``; it is one from ``low`` to ``high``."""
        done = -1
        for p, t, a, b in zip(at.tolist(), of.tolist(), low.tolist(), high.tolist()):
            if t == done:
                continue
            end = int(offsets[t + 1])
            while b - a > 1:  # the last term that is not greater than the text from here
                mid = (a + b) // 2
                term = self._term(mid)
                if bytes(data[p : min(end, p + len(term))]) >= term:
                    a = mid
                else:
                    b = mid
            term = self._term(a)
            if p + len(term) <= end and data[p : p + len(term)] == term:
                out[t], done = True, t

    def _term(self, i: int) -> bytes:
        return self.blob[self.ends[i] : self.ends[i + 1]]


def flag_terms(df: DataFrame, column: str, terms: DataFrame, term_column: str, flag: str = "banned") -> DataFrame:
    """``df`` with ``flag``: whether the lower-cased text of ``column`` contains any term; null texts contain none.

    Map-only. Rows are neither shuffled nor repeated, and every group of terms is sent to the tasks once. With several
    groups the rows are written after each but the last.
    """
    out, passes = df.withColumn(flag, F.lit(False)), 0
    for group in term_groups(terms, term_column):
        found = group.select(F.col("term").cast("binary")).toArrow()  # at most about MOST_CHARACTERS
        listed = Terms(found.column(0).to_pylist())
        if len(listed):
            if passes:  # or all groups would be in memory at once
                out = materialize(out, f"{new_run_dir(df.sparkSession)}/flagged")
            out, passes = _flag_group(out, column, listed, flag), passes + 1
    return out


def _flag_group(df: DataFrame, column: str, listed: Terms, flag: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(listed)
    columns = [f"`{c}`" for c in df.columns]
    # Spark lower-cases terms and texts alike; a text that has a hit already is not sent again.
    text = F.when(~F.col(flag), F.lower(F.col(column)).cast("binary"))
    rows = df.select(F.struct(*columns).alias("row"), text.alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("hit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = shared.value.hits(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits)], names=["row", "hit"])

    met = rows.mapInArrow(run, schema)
    return met.select(*(F.col(f"row.{c}").alias(n) for c, n in zip(columns, df.columns) if n != flag),
                      (F.col(f"row.`{flag}`") | F.col("hit")).alias(flag))
