"""Byte-level BPE by units: parts of a text that the vocabulary's own pattern never joins.

The pattern of the public byte-level vocabularies splits at white space: a run without white space, with the single
space before it, is tokenised alone, and so is what is left of a run of white space. It also splits between a letter
and an ASCII mark other than the apostrophe.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import regex

MODEL = "byte_bpe_50k.json"
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
_MARKS = "!-&(-/:-@[-`{-~"
UNITS = re.compile(f" ?[{_LETTERS}]++(?=[{_MARKS}])| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def model_path(model: str | None) -> str:
    if model:
        return model
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def units(text: str) -> list[str]:
    return UNITS.findall(text)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


# What the pattern of the vocabulary splits a unit into.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
PRE_TOKENS = regex.compile(_SPLIT)
_LONG = re.compile(f"[^{_WS}]{{2048}}|[{_WS}]{{2048}}")


class Ids:
    """The ids that ``tokenizers`` gives for its file.

    The vocabulary of the file is also loaded as ranks, which ``tiktoken`` encodes several times faster with the same
    result. Texts with special strings and texts with very long runs are left to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = [t.content for t in added.values()]
        ranks = {to_bytes(t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if i not in added}
        self.fast = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: bytes) -> bytes:
        decoded = text.decode("utf-8", "replace")
        if any(s in decoded for s in self.specials) or len(decoded) >= 2048 and _LONG.search(decoded):
            return packed(self.tokenizer.encode(decoded, add_special_tokens=False).ids)
        return packed(self.fast.encode_ordinary(decoded))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


_BYTES = _byte_letters()


def to_bytes(token: str) -> bytes:
    return bytes(_BYTES[c] for c in token)


_LOADED: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _LOADED:
        _LOADED[path] = Ids(path)
    return _LOADED[path]
