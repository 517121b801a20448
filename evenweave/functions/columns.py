"""Building blocks for larger Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body mentions it.

    Without the binding every mention is another copy of the whole expression, in the plan and at run
    time.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strict_json(text: Column) -> Column:
    """JSON value of a whole text as variant, null if malformed.

    Parsing ``[text]`` and taking its only element rejects anything that follows the value.
    """
    outer = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return let(outer.try_cast("array<variant>"), lambda els: F.when(F.size(els) == 1, F.element_at(els, 1)))
