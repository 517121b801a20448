"""Text predicates and cleaning as pure Columns (no Python in the data path)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes; Spark's trim() without this list only removes spaces.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)
_WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WS = f"[{_WS_CLASS}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str, chars: str = WHITESPACE) -> Column:
    """Remove leading and trailing characters; by default every Unicode whitespace."""
    return F.trim(_col(c), F.lit(chars))


def stripped_length(c: Column | str) -> Column:
    """Length after strip; null counts as empty."""
    return F.length(strip(F.coalesce(_col(c).cast("string"), F.lit(""))))


def is_filled(c: Column | str, min_length: int = 1) -> Column:
    """Not null and at least ``min_length`` characters after strip. Never null itself."""
    return stripped_length(c) >= F.lit(min_length)


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words; null counts as no words."""
    words = F.split(F.coalesce(_col(c), F.lit("")), _WS)
    return F.size(F.array_remove(words, ""))


def collapse_whitespace(c: Column) -> Column:
    """Every run of whitespace as one space: cheaper character by character than by one match per word."""
    return F.regexp_replace(F.translate(c, WHITESPACE, " " * len(WHITESPACE)), " {2,}", " ")


def clean_text(c: Column | str) -> Column:
    """Strip, drop surrounding quotes, unescape quotes, turn literal \\n and \\t into spaces."""
    t = strip(strip(strip(_col(c)), '"'), "'")
    t = F.replace(F.replace(t, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))
    t = F.replace(F.replace(t, F.lit("\\n"), F.lit(" ")), F.lit("\\t"), F.lit(" "))
    return strip(collapse_whitespace(t))


def any_of(tests: list[Column]) -> Column:
    """Disjunction as a balanced tree, so that long lists stay shallow."""
    if not tests:
        return F.lit(False)
    half = len(tests) // 2
    return tests[0] if len(tests) == 1 else any_of(tests[:half]) | any_of(tests[half:])


def contains_any(c: Column | str, terms: list[str]) -> Column:
    """Lower-cased text contains any of the terms as a substring; null text contains none.

    One byte search per term is several times faster than one regular expression over all of them.
    """
    text = F.lower(_col(c))
    return F.coalesce(any_of([text.contains(t.lower()) for t in terms]), F.lit(False))


def digest(c: Column | str) -> Column:
    """32-byte key of a text, so that grouping whole texts shuffles 32 bytes per row, not the text."""
    return F.unhex(F.sha2(F.coalesce(_col(c).cast("string"), F.lit("")), 256))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Concatenate the literal parts of ``template`` with the Columns named in its {placeholders}.

    Only placeholders present in ``values`` count, so JSON braces in a template stay as they are.
    """
    names = "|".join(re.escape(n) for n in values)
    parts = re.split(r"\{(%s)\}" % names, template) if names else [template]
    out = [
        F.coalesce(values[p].cast("string"), F.lit("")) if i % 2 else F.lit(p)
        for i, p in enumerate(parts)
        if i % 2 or p
    ]
    return F.concat(*out) if out else F.lit("")
