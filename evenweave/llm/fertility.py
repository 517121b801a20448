"""Quality rules by tokeniser fertility: public vocabularies tell text from noise.

Words are encoded by a sentencepiece model with byte fallback and by a byte-level vocabulary, each as a word of its own,
and memoised. Measured per document: characters per token, share of tokens that are bytes of unknown characters, and
entropy of the token counts in bits. Bands per script say what is rejected; the script of a document is that of most of
its letters.

Fixed outer bands hold for every document. Inside them there are lower fences for characters per token and entropy under both
vocabularies, one rule for tables of every size: the mean of what the script's documents say and of a documented value
for the script (``FLOORS``), weighted by their number and by ``WEIGHT``. The documents' own fence lies ``REACH`` quartile
distances below the first quartile of all that pass the base rule, and ``LEAST_MARGIN`` below the median at least. There are
no such fences above, because text that a vocabulary knows well is no noise. Entropy of n tokens is at most log2(n) and
levels off in long texts, so it is judged as a share of log2(n), n at most ``LEVEL``, and only from ``MIN_TOKENS`` tokens
on, as are the fences. Words are encoded whole, however long.

A null or empty text has no words and fails the base rule.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenweave.llm.common import arrow_type, map_texts, utf8, windows, words
from evenweave.session import materialize, new_run_dir

MODEL = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"
MIN_TOKENS = 40
LEVEL = 256
WEIGHT = 100  # documents that the documented floors count for
REACH = 1.5
LEAST_MARGIN = 0.1  # of the median; a corpus of copies has no quartile distance


@dataclass(frozen=True)
class Band:
    """What a script's documents may measure; outside it they are rejected."""

    chars_per_token: tuple[float, float]
    byte_share: float
    entropy_share: float


BANDS = {
    "latin": Band((1.5, 9.0), 0.10, 0.50),
    "cyrillic": Band((1.0, 9.0), 0.20, 0.40),
    "greek": Band((0.6, 9.0), 0.35, 0.35),
    "arabic": Band((0.5, 9.0), 0.60, 0.30),
    "cjk": Band((0.3, 4.0), 0.75, 0.30),
    "other": Band((0.15, 9.0), 1.00, 0.20),
}
# Floors by script: characters per piece, its entropy share, characters per byte-level unit, its entropy share. Running text has
# well above three characters a token and above 0.85 of the entropy in a script the vocabulary knows.
FLOORS = {
    "latin": (1.6, 0.72, 1.4, 0.72),
    "cyrillic": (1.1, 0.65, 0.6, 0.65),
    "greek": (0.7, 0.60, 0.5, 0.60),
    "arabic": (0.6, 0.60, 0.5, 0.60),
    "cjk": (0.35, 0.60, 0.25, 0.60),
    "other": (0.2, 0.45, 0.2, 0.45),
}
_SCRIPTS = [
    ("latin", re.compile("[A-Za-z\\u00c0-\\u024f]")), ("cyrillic", re.compile("[\\u0400-\\u052f]")),
    ("greek", re.compile("[\\u0370-\\u03ff]")), ("arabic", re.compile("[\\u0600-\\u06ff]")),
    ("cjk", re.compile("[\\u3040-\\u30ff\\u3400-\\u9fff\\uac00-\\ud7af]")),
]
_BEYOND_LATIN = re.compile("[\u0250-\U0010ffff]")
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "script string, n_tokens long, chars_per_token double, byte_share double, entropy double, "
    "n_byte_tokens long, byte_chars_per_token double, byte_entropy double, kept boolean"
)
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"


class Pieces(dict):
    """Ids of a word's pieces as uint16 bytes, remembered up to a bound."""

    BOUND = 250_000

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.first_byte = self.model.piece_to_id("<0x00>")

    def learn(self, batch: list[list[bytes]]) -> None:
        """Encodes the words of a batch that are new, all in one call."""
        if len(self) >= self.BOUND:
            self.clear()
        new = list({w for ws in batch for w in ws if w not in self})
        if new:
            encoded = self.model.encode([w.decode("utf-8", "replace") for w in new], num_threads=1)
            self.update((w, array("H", ids).tobytes()) for w, ids in zip(new, encoded))


class ByteUnits(dict):
    """Ids of a word, with the space before it, in the byte-level vocabulary as uint16 bytes, remembered up to a bound."""

    BOUND = 250_000

    def __init__(self):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(RANKS), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.read().splitlines())}
        self.encode = tiktoken.Encoding(
            RANKS, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = array("H", self.encode(" " + word.decode("utf-8", "replace"))).tobytes()
        return value


_BYTE_UNITS: list[ByteUnits] = []


def byte_units() -> ByteUnits:
    if not _BYTE_UNITS:
        _BYTE_UNITS.append(ByteUnits())
    return _BYTE_UNITS[0]


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def repeated_words(hashes: np.ndarray, size: int = 8) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    if len(hashes) < size + 1:
        return 0
    w = windows(hashes, size)
    if len(np.unique(w)) == len(w):
        return 0
    _, where, counts = np.unique(w, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(counts[where] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """Script of most letters; nearly all texts are decided by their first test."""
    if text.isascii() or not _BEYOND_LATIN.search(text):
        return "latin"
    counts = [(len(expr.findall(text)), name) for name, expr in _SCRIPTS]
    other = sum(map(str.isalpha, text)) - sum(n for n, _ in counts)
    most, name = max(counts, key=lambda x: x[0])
    return name if most and most >= other else "other"


def entropy_bits(ids: np.ndarray) -> float:
    if not len(ids):
        return 0.0
    counts = np.unique(ids, return_counts=True)[1]
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum()) + 0.0


def measure(texts: list[bytes], vocabulary: Pieces) -> Iterator[tuple]:
    split = [words(t) for t in texts]
    vocabulary.learn(split)
    for text, ws in zip(texts, split):
        yield _measure(text, ws, vocabulary)


def _measure(text: bytes, ws: list[bytes], vocabulary: Pieces) -> tuple:
    n = len(ws)
    joined = b"".join(ws)
    decoded = joined.decode("utf-8", "replace")
    chars = len(decoded)
    symbols = len(joined) - len(joined.translate(None, _SYMBOLS))
    repeats = repeated_words(np.fromiter(map(hash, ws), np.int64, n).view(np.uint64))
    failed = n < 20 or 100 * repeats > 30 * n
    ids = np.frombuffer(b"".join(map(vocabulary.__getitem__, ws)), np.uint16)
    tokens = len(ids)
    per_token = chars / tokens if tokens else 0.0
    low = vocabulary.first_byte
    bytes_share = float(((ids >= low) & (ids < low + 256)).mean()) if tokens else 0.0
    bits = entropy_bits(ids)
    units = np.frombuffer(b"".join(map(byte_units().__getitem__, ws)), np.uint16)
    per_unit = chars / len(units) if len(units) else 0.0
    script = script_of(decoded)
    kept = not failed and within(BANDS[script], tokens, per_token, bytes_share, bits)
    return (n, chars, symbols, repeated_lines(text), repeats, failed, script, tokens, per_token, bytes_share, bits,
            len(units), per_unit, entropy_bits(units), kept)


def within(band: Band, tokens: int, per_token: float, byte_share: float, bits: float) -> bool:
    low, high = band.chars_per_token
    if not low <= per_token <= high or byte_share > band.byte_share:
        return False
    return tokens < MIN_TOKENS or bits >= band.entropy_share * float(np.log2(min(tokens, LEVEL)))


def _share(bits: str, tokens: str) -> Column:
    return F.col(bits) / F.log2(F.greatest(F.lit(2), F.least(F.col(tokens), F.lit(LEVEL))).cast("double"))


def _judged() -> dict[str, Column]:
    """What has lower fences, by name."""
    return {
        "per_piece": F.col("chars_per_token"), "piece_entropy": _share("entropy", "n_tokens"),
        "per_unit": F.col("byte_chars_per_token"), "unit_entropy": _share("byte_entropy", "n_byte_tokens"),
    }


def fences(measured: DataFrame) -> dict[str, dict[str, float]]:
    """Lowest values that stay, by script and measure; from all documents that pass the base rule and have tokens enough."""
    usable = measured.where(~F.col("base_failed") & (F.least("n_tokens", "n_byte_tokens") >= MIN_TOKENS))
    quartiles = [F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(name) for name, x in _judged().items()]
    found = usable.groupBy("script").agg(F.count("*").alias("n"), *quartiles).collect()  # a row a script
    out = {script: dict(zip(_judged(), floors)) for script, floors in FLOORS.items()}
    for r in found:
        for name, floor in out[r["script"]].items():
            first, median, third = r[name]
            own = min(first - REACH * (third - first), (1 - LEAST_MARGIN) * median)
            out[r["script"]][name] = (r["n"] * own + WEIGHT * floor) / (r["n"] + WEIGHT)
    return out


def passes(lowest: dict[str, dict[str, float]]) -> Column:
    """The verdict: the base rule and outer bands, and the fences of the script."""
    verdict = F.col("kept")
    for script, least in lowest.items():
        short = F.least("n_tokens", "n_byte_tokens") < MIN_TOKENS
        above = F.lit(True)
        for name, x in _judged().items():
            above &= x >= F.lit(least[name])
        verdict &= (F.col("script") != script) | short | above
    return verdict


def quality_rules(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base rule, fertility measures, verdict. Measures are written, texts are not."""
    path = model_path(model)

    def rows(texts: list[bytes]) -> Iterator[tuple]:
        return measure(texts, pieces(path))

    measured = materialize(map_texts(docs, FIELDS, rows, id_col, text_col), new_run_dir(docs.sparkSession))
    return measured.withColumn("kept", passes(fences(measured)))


def model_path(model: str | None) -> str:
    if model:
        return model
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def kept_documents(docs: DataFrame, model: str | None = None, text_col: str = "text") -> DataFrame:
    """The rows that pass, with all their columns as they are; nothing is shuffled.

    Rows that pass the outer bands are written with their measures, so texts are measured once.
    """
    path = model_path(model)
    at = docs.columns.index(text_col)
    measures = T.StructType.fromDDL(FIELDS)
    schema = T.StructType([T.StructField("row", docs.schema), *measures.fields])
    kinds = [arrow_type(f.dataType) for f in measures.fields]

    def run(batches):
        vocabulary = pieces(path)
        for batch in batches:
            found = list(measure([t or b"" for t in utf8(batch.column(0).field(at))], vocabulary))
            columns = list(zip(*found)) if found else [()] * len(kinds)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=schema.names)
            yield out.filter(pa.array(columns[-1], pa.bool_()))
        vocabulary.clear(), byte_units().clear()  # workers go on with other stages

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    measured = materialize(rows.mapInArrow(run, schema), new_run_dir(docs.sparkSession))
    return measured.where(passes(fences(measured))).select("row.*")
