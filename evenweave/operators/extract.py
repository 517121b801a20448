"""Records out of messy model responses: a ``responses`` table in, items per response out.

Five strategies of rising tolerance; a response goes to the next one only if the previous found
nothing. Every strategy is a Column expression over the raw text, so the cascade is one map-only pass
inside the JVM: no Python workers, no shuffle, one scan however many strategies a response needs.

An item is a ``map<string,string>`` holding ``id`` and the task's keys. Absent keys and JSON nulls are
left out of the map. Values that are not text appear as JSON writes them (``true``, ``5``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenweave.functions.columns import let, strict_json
from evenweave.functions.text import strip

STRATEGIES = ["direct", "clean", "fix", "line", "regex"]
ITEMS_TYPE = "array<map<string,string>>"

# Code points Unicode reserves for internal use; they mark the borders of a matched value.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"
_STRING_BODY = r'[^"\\]*+(?:\\.[^"\\]*+)*+'


# ---------------------------------------------------------------- JSON values


def _path(key: str) -> str:
    return "$[" + json.dumps(key) + "]"


def _field(value: Column, key: str) -> Column:
    return F.try_variant_get(value, _path(key), "string")


def _has_key(value: Column, key: str) -> Column:
    return F.try_variant_get(value, _path(key), "variant").isNotNull()


def _as_map(values: dict[str, Column]) -> Column:
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def _item(value: Column, keys: list[str]) -> Column:
    return _as_map({k: _field(value, k) for k in ["id", *[k for k in keys if k != "id"]]})


def _array_items(text: Column, primary: str, keys: list[str]) -> Column:
    """Objects of a JSON array that have the primary key; empty if the text is no JSON array."""
    elements = strict_json(text).try_cast("array<variant>")
    objects = F.filter(
        elements, lambda e: F.schema_of_variant(e).startswith("OBJECT") & _has_key(e, primary)
    )
    return F.coalesce(F.transform(objects, lambda e: _item(e, keys)), _no_items())


def _no_items() -> Column:
    return F.array().cast(ITEMS_TYPE)


# ---------------------------------------------------------------- text repairs


def _between(text: Column, first: str, last: str) -> Column:
    """From the first ``first`` to the last ``last``; blank where either is missing or out of order."""
    return F.regexp_extract(text, f"(?s){re.escape(first)}.*{re.escape(last)}", 0)


def drop_trailing_commas(text: Column, closers: str = "}]") -> Column:
    for c in closers:
        text = F.regexp_replace(text, r",\s*" + re.escape(c), c)
    return text


def replace_in_values(text: Column, key: str, change: Callable[[Column], Column]) -> Column:
    """Apply ``change`` to the value of every ``"key": "..."`` that is followed by a comma or brace.

    The value ends at the first quote that a comma or closing brace follows, so it may hold quotes.
    """
    pattern = r'(?s)("%s"\s*:\s*")(.*?)("\s*[,}])' % re.escape(key)
    unmarked = F.replace(F.replace(text, F.lit(_OPEN), F.lit("")), F.lit(_CLOSE), F.lit(""))
    marked = F.regexp_replace(unmarked, pattern, f"$1{_OPEN}$2{_CLOSE}$3")
    pieces = F.split(marked, f"[{_OPEN}{_CLOSE}]")
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, change(p)).otherwise(p)), "")


def _quotes_to_apostrophes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit("'"))


def fix_colons(text: Column) -> Column:
    """``:`` inside string values becomes `` -``.

    A string counts as a value only if it directly follows the colon. The text is cut into strings
    (with a leading colon, if any) and the rest; only strings with a leading colon change.
    """
    token = rf'(?s):?"{_STRING_BODY}"?|\\.|[^":\\]++|:|\\'
    plain_colon = r"(?s)\G([^:\\]*+(?:\\.[^:\\]*+)*+):"
    tokens = F.regexp_extract_all(text, F.lit(token), F.lit(0))
    fixed = F.transform(
        tokens,
        lambda t: F.when(
            t.startswith(':"'),
            F.concat(F.lit(":"), F.regexp_replace(F.substr(t, F.lit(2)), plain_colon, "$1 -")),
        ).otherwise(t),
    )
    return F.array_join(fixed, "")


def _control_to_space(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x1f\x7f]", " ")


# ---------------------------------------------------------------- strategies


def items_direct(raw: Column, primary: str, keys: list[str]) -> Column:
    """The whole response is a JSON array."""
    text = strip(raw)
    return F.when(text.startswith("["), _array_items(text, primary, keys)).otherwise(_no_items())


def _unfence(text: Column) -> Column:
    """Inside of a json-tagged fence, else the first fenced part that starts with a bracket."""
    tagged = F.substring_index(
        F.substr(text, F.instr(text, "```json") + 7), "```", 1
    )
    starts = F.filter(
        F.transform(F.split(text, "```"), lambda p: strip(p)), lambda p: p.startswith("[")
    )
    first = F.coalesce(F.try_element_at(starts, F.lit(1)), text)
    return (
        F.when(text.contains("```json"), tagged).when(text.contains("```"), first).otherwise(text)
    )


def items_clean(raw: Column, primary: str, keys: list[str]) -> Column:
    """A JSON array somewhere in the response, possibly fenced."""
    return _array_items(_between(let(strip(raw), _unfence), "[", "]"), primary, keys)


def repair_array(raw: Column, keys: list[str]) -> Column:
    """Text of the array with commas, inner quotes, colons and control characters repaired."""
    text = drop_trailing_commas(_between(strip(raw), "[", "]"))
    for key in keys:
        text = replace_in_values(text, key, _quotes_to_apostrophes)
    return _control_to_space(fix_colons(text))


def items_fix(raw: Column, primary: str, keys: list[str]) -> Column:
    """A JSON array after repair."""
    return _array_items(repair_array(raw, keys), primary, keys)


def items_line(raw: Column, primary: str, keys: list[str]) -> Column:
    """Every flat object that names the primary key, repaired one by one where needed."""
    pattern = r'(?s)\{[^{}]*?"%s"[^{}]*?\}' % re.escape(primary)
    objects = F.regexp_extract_all(raw, F.lit(pattern), F.lit(0))

    def usable(value: Column) -> Column:
        return let(value, lambda v: F.when(F.length(_field(v, primary)) > 3, _item(v, keys)))

    def repaired(text: Column) -> Column:
        text = drop_trailing_commas(text, "}")
        for key in keys:
            text = replace_in_values(
                text, key, lambda v: F.replace(_quotes_to_apostrophes(v), F.lit(":"), F.lit(" -"))
            )
        return text

    found = F.transform(objects, lambda o: F.coalesce(usable(strict_json(o)), usable(strict_json(repaired(o)))))
    return F.filter(found, lambda m: m.isNotNull())


def _quoted_value(text: Column, key: str) -> Column:
    """Stripped value of the first ``"key": "..."``, null where there is none."""
    pattern = rf'(?s)"{re.escape(key)}"\s*:\s*"({_STRING_BODY})"'
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def items_regex(raw: Column, primary: str, keys: list[str]) -> Column:
    """Key-value pairs found in the pieces before each opening brace."""
    others = [k for k in keys if k != primary and k != "id"]
    pieces = F.filter(
        F.transform(
            F.split(raw, r"(?=\{)"),
            lambda c: F.struct(
                c.alias("text"), F.coalesce(_quoted_value(c, primary), F.lit("")).alias("primary")
            ),
        ),
        lambda p: F.length(p["primary"]) >= 3,
    )

    def item(p: Column, i: Column) -> Column:
        number = F.regexp_extract(p["text"], r'"id"\s*:\s*(\d+)', 1)
        return _as_map(
            {
                "id": F.when(number != "", number).otherwise((i + 1).cast("string")),
                primary: p["primary"],
                **{k: _quoted_value(p["text"], k) for k in others},
            }
        )

    return F.transform(pieces, item)


class Cascade:
    """X6 for one set of keys; build it once to parse several tables."""

    def __init__(self, primary: str, keys: list[str], raw: str = "raw"):
        builders = [items_direct, items_clean, items_fix, items_line, items_regex]
        self.raw = raw
        self.columns = [(n, b(F.col(raw), primary, keys)) for n, b in zip(STRATEGIES, builders)]

    def apply(self, responses: DataFrame) -> DataFrame:
        """Add ``strategy`` (null if nothing was found) and ``items``.

        Each strategy is a projection of its own that looks at the earlier results, so later, dearer
        strategies are evaluated only for the rows that still need them.
        """
        out, open_yet = responses, F.col(self.raw).isNotNull()
        for name, found in self.columns:
            out = out.withColumn(f"_{name}", F.when(open_yet, found))
            open_yet = open_yet & (F.coalesce(F.size(f"_{name}"), F.lit(0)) == 0)
        strategy, items = F.lit(None).cast("string"), _no_items()
        for name in reversed(STRATEGIES):
            hit = F.coalesce(F.size(f"_{name}"), F.lit(0)) > 0
            strategy = F.when(hit, F.lit(name)).otherwise(strategy)
            items = F.when(hit, F.col(f"_{name}")).otherwise(items)
        return out.select(*responses.columns, strategy.alias("strategy"), items.alias("items"))


def extract_items(responses: DataFrame, primary: str, keys: list[str], raw: str = "raw") -> DataFrame:
    """Add ``strategy`` and ``items`` to a table of responses."""
    return Cascade(primary, keys, raw).apply(responses)


def explode_items(extracted: DataFrame, *keep: str) -> DataFrame:
    """One row per item: ``keep`` columns, ``strategy``, ``pos`` (0-based) and ``values``.

    The outer form with a filter behind it: from the inner form Spark infers a filter on the size of
    ``items``, pushes it to the scan and so parses every response twice.
    """
    rows = extracted.select(*keep, "strategy", F.posexplode_outer("items").alias("pos", "values"))
    return rows.where(F.col("pos").isNotNull())


def strategy_report(extracted: DataFrame) -> DataFrame:
    """X6 quality metric: responses and items per strategy; failed responses count as ``none``."""
    return extracted.groupBy(F.coalesce("strategy", F.lit("none")).alias("strategy")).agg(
        F.count(F.lit(1)).alias("responses"), F.sum(F.size("items")).alias("items")
    )


def extract_single(raw: Column, keys: list[str], min_length: int = 3) -> Column:
    """One object per response as ``map<string,string>`` with every key; absent values are "".

    ``keys[0]`` is the primary key. Values of a parsed object are kept if the primary one is long
    enough, otherwise quoted values found in the text take precedence over them.
    """
    primary = keys[0]

    def unfenced(text: Column) -> Column:
        parts = F.filter(
            F.transform(F.split(text, "```"), lambda p: strip(p)),
            lambda p: p.startswith("{") | p.contains(f'"{primary}"'),
        )
        first = F.coalesce(F.try_element_at(parts, F.lit(1)), text)
        return F.when(text.contains("```"), first).otherwise(text)

    def parsed(text: Column) -> Column:
        value = strict_json(fix_colons(drop_trailing_commas(_between(text, "{", "}"), "}")))
        return let(
            value, lambda v: F.struct(*[F.coalesce(strip(_field(v, k)), F.lit("")).alias(k) for k in keys])
        )

    def choose(text: Column, found: Column) -> Column:
        def quoted(k: str) -> Column:
            return F.coalesce(_quoted_value(text, k), found[k])

        good = F.length(found[primary]) >= min_length
        return F.create_map(
            *[x for k in keys for x in (F.lit(k), F.when(good, found[k]).otherwise(quoted(k)))]
        )

    return let(
        let(strip(raw), unfenced), lambda text: let(parsed(text), lambda found: choose(text, found))
    )
