"""SentencePiece encoding by an Aho-Corasick automaton and one Viterbi pass, and decoding.

The automaton holds all pieces of a model. A text runs through it once; at every position its output links list the
pieces that end there, and each relaxes the best score of that position from the best score at the piece's start. A
character that no piece covers is written as its byte pieces (byte fallback) or, in a model without those, as the unknown
piece; both cost ``UNKNOWN`` below the lowest score of the model. Of equal scores the longer last piece wins.

The score of a segmentation is the sum of its pieces' scores in the model, whatever kind the model is: for a unigram
model that is the library's rule, for a BPE model it is the segmentation of best total rank.

Pieces hold the escaped space only in front, or nothing else, so a text falls apart, exactly, before every escaped
space that follows another character; parts repeat, and their segmentation is remembered up to a bound.

The model's flags are followed: dummy prefix and escaping of spaces. Models that normalise or drop white space are
refused. Decoding joins pieces, puts runs of bytes together and drops the dummy prefix, so encoding and decoding give
every text back that holds no escaped space of its own. A null or empty text has no ids.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame

from evenweave.llm.common import map_texts

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN = 10.0
_LOWEST = float("-inf")
NORMAL, UNKNOWN_TYPE, USER, BYTE = 1, 2, 4, 6


def model_path(model: str | None) -> str:
    if model:
        return model
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """A model's pieces as an automaton, encoder and decoder."""

    BOUND = 300_000
    LONGEST = 64

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        flags = proto.normalizer_spec
        if flags.precompiled_charsmap or flags.remove_extra_whitespaces or not flags.escape_whitespaces:
            raise ValueError("models that change the text before encoding it are not supported")
        self.prefix = flags.add_dummy_prefix
        self.texts = [p.piece for p in proto.pieces]
        self.bytes: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        self.unknown, lowest = 0, 0.0
        for i, p in enumerate(proto.pieces):
            if p.type in (NORMAL, USER):
                if p.piece.lstrip(SPACE).find(SPACE) >= 0:
                    raise ValueError(f"piece {i} holds a space inside")
                self.automaton.add_word(p.piece, (len(p.piece), p.score, i))
                lowest = min(lowest, p.score)
            elif p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
            elif p.type == UNKNOWN_TYPE:
                self.unknown = i
        self.automaton.make_automaton()
        # Characters that are pieces; any other character is in no piece, or the model is refused.
        self.chars = frozenset(t for t in self.automaton.keys() if len(t) == 1)
        if not self.chars.issuperset("".join(self.automaton.keys())):
            raise ValueError("a piece holds a character that is no piece")
        listed = re.escape("".join(sorted(self.chars)))
        self.covered = re.compile(f"([{listed}]*)([^{listed}]*)")
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.penalty = lowest - UNKNOWN
        self.parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.known: dict[str, tuple[tuple[int, ...], float]] = {}

    def escaped(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def viterbi(self, part: str) -> tuple[tuple[int, ...], float]:
        """Best segmentation of one part. Pieces that end at a position come longest first, so the first of equals stays."""
        n = len(part)
        if not self.chars.issuperset(part):
            return self._with_fallback(part)
        best, start, piece = [0.0] + [_LOWEST] * n, [0] * (n + 1), [0] * (n + 1)
        for end, (size, score, i) in self.automaton.iter(part):
            end += 1
            total = best[end - size] + score
            if total > best[end]:
                best[end], start[end], piece[end] = total, end - size, i
        ids: list[int] = []
        e = n
        while e:
            ids.append(piece[e])
            e = start[e]
        ids.reverse()
        return tuple(ids), best[n]

    def _with_fallback(self, part: str) -> tuple[tuple[int, ...], float]:
        """The same for a part with characters that are no piece; these split it, as no piece holds them."""
        ids: list[int] = []
        total = 0.0
        for stretch, others in self.covered.findall(part):
            if stretch:
                found, score = self.viterbi(stretch)
                ids.extend(found)
                total += score
            for c in others:
                ids.extend([self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown])
                total += self.penalty
        return tuple(ids), total

    def encode(self, text: str) -> tuple[list[int], float]:
        """Ids of a text and the score of its segmentation."""
        ids: list[int] = []
        total = 0.0
        known = self.known
        for part in self.parts.findall(self.escaped(text)):
            found = known.get(part)
            if found is None:
                found = self.viterbi(part)
                if len(part) <= self.LONGEST:
                    if len(known) >= self.BOUND:
                        known.clear()
                    known[part] = found
            ids.extend(found[0])
            total += found[1]
        return ids, total

    def decode(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.texts[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out)
        if self.prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


_LOADED: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids, score."""
    path = model_path(model)

    def rows(texts: list[bytes]):
        vocabulary = pieces_of(path)
        return (vocabulary.encode(t.decode("utf-8", "replace")) for t in texts)

    return map_texts(docs, "ids array<int>, score double", rows, id_col, text_col)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and text of rows with ids."""
    import pyarrow as pa

    path = model_path(model)
    schema = "doc_id {}, text string".format(encoded.schema["doc_id"].dataType.simpleString())

    def run(batches):
        vocabulary = pieces_of(path)
        for batch in batches:
            texts = [vocabulary.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, n_bytes (byte pieces), ids_crc32, score, exact (decodes to its text)."""
    path = model_path(model)

    def rows(texts: list[bytes]):
        vocabulary = pieces_of(path)
        first = min(vocabulary.byte_of, default=0)
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            ids, score = vocabulary.encode(text)
            array = np.array(ids, "<u4")
            n_bytes = int(((array >= first) & (array < first + 256)).sum()) if vocabulary.bytes else 0
            yield len(ids), n_bytes, zlib.crc32(array.tobytes()), score, vocabulary.decode(ids) == text

    fields = "n_pieces long, n_bytes long, ids_crc32 long, score double, exact boolean"
    return map_texts(docs, fields, rows, id_col, text_col)
