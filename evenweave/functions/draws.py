"""Deterministic draws keyed by (seed, column, row id). They survive retries and re-planning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenweave.functions.columns import let


def draw_key(seed: int, name: str, row_id: Column) -> Column:
    """Hex md5 of ``seed:name:row_id``; doubles as a uniform sort key."""
    return F.md5(F.concat(F.lit(f"{seed}:{name}:"), row_id.cast("string")).cast("binary"))


def draw_int(seed: int, name: str, row_id: Column, n: int) -> Column:
    """Uniform integer in [0, n) from the first 32 bits of the key."""
    head = F.conv(F.substring(draw_key(seed, name, row_id), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(n).cast("long"))


def uniform_choice(seed: int, name: str, row_id: Column, options: list[str]) -> Column:
    """One option per row, repeated options count as often as they are listed."""
    position = draw_int(seed, name, row_id, len(options)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), position)


def weighted_choice(seed: int, name: str, row_id: Column, options: list[tuple[str, int]]) -> Column:
    """One option per row, with probability proportional to its integer weight."""
    total = sum(w for _, w in options)
    u = draw_int(seed, name, row_id, total)
    def choose(drawn: Column) -> Column:
        upper, choice = 0, None
        for value, weight in options:
            upper += weight
            test = drawn < F.lit(upper)
            choice = F.when(test, F.lit(value)) if choice is None else choice.when(test, F.lit(value))
        return choice

    return let(u, choose)


def conditional_choice(
    seed: int,
    name: str,
    row_id: Column,
    condition: Column,
    cases: dict[str, list[tuple[str, int]]],
    default: list[tuple[str, int]],
) -> Column:
    """The weights depend on the value of another column."""
    out = None
    for value, options in cases.items():
        drawn = weighted_choice(seed, name, row_id, options)
        out = F.when(condition == value, drawn) if out is None else out.when(condition == value, drawn)
    rest = weighted_choice(seed, name, row_id, default)
    return rest if out is None else out.otherwise(rest)
