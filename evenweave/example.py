"""The example data set: ad copy over nine themes. Values come from ``fixed_values``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenweave import fixed_values as V
from evenweave.functions.text import fill_template
from evenweave.operators.skeleton import lookup
from evenweave.spec import BalanceSpec, TaskRegistry, TaskSpec, value_or_blank


def _codes(values: list[str]) -> dict[str, int]:
    return {v: i for i, v in enumerate(values)}


def ad_spec(cycles: int = V.CYCLES) -> BalanceSpec:
    actions = [(a, 1) for a in V.CTA_ACTIONS]
    negative = [(V.CTA_NONE, V.CTA_NEGATIVE_NONE_WEIGHT)]
    negative += [(a, V.CTA_NEGATIVE_ACTION_WEIGHT) for a in V.CTA_ACTIONS]
    return BalanceSpec(
        hierarchy=V.THEME_OBJECTS,
        template=V.OBJECT_TEMPLATE,
        label_order=V.EMOTION_ORDER,
        tone_order=V.SENTIMENT_ORDER,
        implied=V.SENTIMENT_TO_TRUST,
        forbidden=V.FORBIDDEN_PAIRS,
        cycles=cycles,
        quota_values={
            "dominant_colour": V.COLOURS,
            "attention_score": V.LEVELS,
            "predicted_ctr": V.LEVELS,
            "likelihood_shares": V.LEVELS,
            "target_audience": V.AUDIENCES,
        },
        equal_columns=["attention_score", "predicted_ctr", "likelihood_shares", "target_audience"],
        codes={
            "theme": _codes(list(V.THEME_OBJECTS)),
            "sentiment": _codes(V.SENTIMENT_ORDER),
            "emotion": _codes(V.EMOTION_ORDER),
            "dominant_colour": _codes(V.COLOURS),
            "attention_score": _codes(V.LEVELS),
            "trust_safety": _codes(V.TRUST_VALUES),
            "target_audience": _codes(V.AUDIENCES),
            "predicted_ctr": _codes(V.LEVELS),
            "likelihood_shares": _codes(V.LEVELS),
        },
        tone_draws={
            "call_to_action": (
                {"Positive": actions, "Negative": negative},
                [(V.CTA_NONE, 1), *actions],
            )
        },
        uniform_draws={"monetary_mention": V.MONETARY_OPTIONS},
        blank_columns=["text", "keywords"],
        id_column="image_path",
        id_pattern=V.ID_PATTERN,
        group_col="theme",
        item_col="object_detected",
        label_col="emotion",
        tone_col="sentiment",
        implied_col="trust_safety",
        column_order=V.TABLE_COLUMNS,
    )


def _fields(*names: str) -> dict[str, Column]:
    return {n: value_or_blank(n) for n in names}


def _with_context(line: Column, label: str) -> Column:
    """The row's text behind the line, only where there is one."""
    text = value_or_blank("text")
    return F.concat(line, F.when(text != "", F.concat(F.lit(label), text)).otherwise(F.lit("")))


def _batch(template: str, **fixed: str):
    for name, value in fixed.items():
        template = template.replace("{" + name + "}", value)
    return lambda n, rows: fill_template(template, {"n": n, "rows": rows})


def _single(template: str, fields: tuple[str, ...], angles: list[str] | None = None):
    def build(variation: int = 0) -> Column:
        text = template if angles is None else template.replace("{angle}", angles[variation % len(angles)])
        return fill_template(text, _fields(*fields))

    return build


def text_fallback() -> dict[str, Column]:
    """Template by (emotion, sentiment), default otherwise; keywords from the row."""
    row = _fields("object_detected", "theme", "emotion", "sentiment")
    text = None
    for (emotion, sentiment), template in V.TEXT_FALLBACKS.items():
        test = (row["emotion"] == emotion) & (row["sentiment"] == sentiment)
        value = fill_template(template, row)
        text = F.when(test, value) if text is None else text.when(test, value)
    text = text.otherwise(fill_template(V.TEXT_FALLBACK_DEFAULT, row))
    keywords = F.concat_ws(" ", row["object_detected"], row["theme"], F.lower(row["emotion"]))
    return {"text": text, "keywords": keywords}


def img_desc_fallback() -> dict[str, Column]:
    """Quoted object, colour unless left out, theme, mood and a fixed suffix."""
    row = _fields("object_detected", "dominant_colour", "theme", "emotion")
    colour = F.lower(row["dominant_colour"])
    parts = [
        F.concat(F.lit('"'), F.lower(row["object_detected"]), F.lit('"')),
        F.when((colour != "") & ~colour.isin(V.IMG_COLOURS_LEFT_OUT), colour),
        F.when(row["theme"] != "", F.lower(row["theme"])),
        lookup(row["emotion"], V.IMG_MOODS),
        F.lit(V.IMG_SUFFIX),
    ]
    return {"img_desc": F.concat_ws(" ", *parts)}


def audience_fallback() -> dict[str, Column]:
    """Audience by lower-cased theme."""
    known = lookup(F.lower(value_or_blank("theme")), V.AUDIENCE_BY_THEME)
    return {"target_audience": F.coalesce(known, F.lit(V.AUDIENCE_DEFAULT))}


def ad_tasks() -> TaskRegistry:
    reg = TaskRegistry()
    reg.register(
        TaskSpec(
            name="text",
            output_columns=["text", "keywords"],
            min_length=8,
            system_prompt=V.TEXT_SYSTEM,
            system_prompt_single=V.TEXT_SYSTEM_SINGLE,
            line=lambda: fill_template(
                V.TEXT_LINE, _fields("theme", "object_detected", "emotion", "sentiment")
            ),
            batch_prompt=_batch(V.TEXT_BATCH),
            single_prompt=_single(
                V.TEXT_SINGLE, ("theme", "object_detected", "emotion", "sentiment"), V.TEXT_ANGLES
            ),
            fallback=text_fallback,
            inputs=["theme", "object_detected", "emotion", "sentiment"],
            deduplicate=False,
        )
    )
    reg.register(
        TaskSpec(
            name="img_desc",
            output_columns=["img_desc"],
            min_length=10,
            system_prompt=V.IMG_SYSTEM,
            system_prompt_single=V.IMG_SYSTEM_SINGLE,
            line=lambda: _with_context(
                fill_template(V.IMG_LINE, _fields("object_detected", "theme", "emotion")), V.IMG_CONTEXT
            ),
            batch_prompt=_batch(V.IMG_BATCH),
            single_prompt=_single(
                V.IMG_SINGLE, ("object_detected", "theme", "emotion", "text"), V.IMG_ANGLES
            ),
            fallback=img_desc_fallback,
            inputs=["theme", "object_detected", "emotion", "dominant_colour", "text"],
            deduplicate=False,
        )
    )
    reg.register(
        TaskSpec(
            name="cta",
            output_columns=["monetary_mention", "call_to_action"],
            min_length=3,
            system_prompt=V.CTA_SYSTEM,
            system_prompt_single=V.CTA_SYSTEM_SINGLE,
            line=lambda: _with_context(
                fill_template(V.CTA_LINE, _fields("object_detected", "theme", "emotion")), V.CTA_CONTEXT
            ),
            batch_prompt=_batch(V.CTA_BATCH),
            single_prompt=_single(V.CTA_SINGLE, ("object_detected", "theme", "emotion"), V.CTA_ANGLES),
            fallback=lambda: None,
            inputs=["theme", "object_detected", "emotion", "text"],
            deduplicate=False,
        )
    )
    categories = V.AUDIENCE_CATEGORIES
    reg.register(
        TaskSpec(
            name="audience",
            output_columns=["target_audience"],
            min_length=3,
            system_prompt=V.AUDIENCE_SYSTEM,
            system_prompt_single=V.AUDIENCE_SYSTEM_SINGLE,
            line=lambda: _with_context(
                fill_template(V.AUDIENCE_LINE, _fields("object_detected", "theme")), V.AUDIENCE_CONTEXT
            ),
            batch_prompt=_batch(V.AUDIENCE_BATCH, categories=categories),
            single_prompt=_single(
                V.AUDIENCE_SINGLE.replace("{categories}", categories), ("object_detected", "theme", "text")
            ),
            fallback=audience_fallback,
            inputs=["theme", "object_detected", "text"],
            deduplicate=False,
        )
    )
    # A task without prompts or fallback: shows that any column names work; its rows stay gaps.
    reg.register(
        TaskSpec(
            name="headline",
            output_columns=["headline", "subheadline"],
            min_length=5,
            system_prompt=V.HEADLINE_SYSTEM,
            fallback=lambda: None,
            deduplicate=False,
        )
    )
    return reg
