"""Declarative inputs: what a balanced table must look like, and what a fill task does."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Quota = list[tuple[str, int]]


def even_quota(values: list[str], total: int, times: int = 1) -> Quota:
    """K8: ``total // k`` each, the first ``total % k`` values one more, all multiplied by ``times``."""
    base, extra = divmod(total, len(values))
    return [(v, (base + (i < extra)) * times) for i, v in enumerate(values)]


@dataclass(frozen=True)
class BalanceSpec:
    """A grid ``group -> item -> (label, tone) template -> cycle`` plus quota and code columns."""

    hierarchy: dict[str, list[str]]
    template: list[tuple[str, str, int]]
    label_order: list[str]
    tone_order: list[str]
    implied: dict[str, str]
    forbidden: list[tuple[str, str]]
    cycles: int
    quota_values: dict[str, list[str]] = field(default_factory=dict)
    # quota columns whose values must have exactly equal counts
    equal_columns: list[str] = field(default_factory=list)
    codes: dict[str, dict[str, int]] = field(default_factory=dict)
    # output column -> (options per tone, options for any other tone)
    tone_draws: dict[str, tuple[dict[str, Quota], Quota]] = field(default_factory=dict)
    uniform_draws: dict[str, list[str]] = field(default_factory=dict)
    blank_columns: list[str] = field(default_factory=list)
    id_column: str = "id"
    id_pattern: str = "%d"
    group_col: str = "group"
    item_col: str = "item"
    label_col: str = "label"
    tone_col: str = "tone"
    implied_col: str = "implied"
    column_order: list[str] = field(default_factory=list)

    @property
    def groups(self) -> list[str]:
        return list(self.hierarchy)

    @property
    def items_per_group(self) -> int:
        return len(next(iter(self.hierarchy.values())))

    @property
    def rows_per_item(self) -> int:
        """Template rows of one item in one cycle."""
        return sum(w for _, _, w in self.template)

    @property
    def base_unit(self) -> int:
        return sum(len(v) for v in self.hierarchy.values()) * self.rows_per_item

    @property
    def total_rows(self) -> int:
        return self.base_unit * self.cycles

    def sorted_template(self) -> list[tuple[str, str, int]]:
        """K2: template in label order, then tone order; values not listed sort last."""
        def rank(order: list[str], v: str) -> int:
            return order.index(v) if v in order else len(order)

        return sorted(
            self.template, key=lambda t: (rank(self.label_order, t[0]), rank(self.tone_order, t[1]))
        )

    def quotas(self) -> dict[str, Quota]:
        """K8 for every quota column: remainder rule on one base unit, times the cycles."""
        return {c: even_quota(v, self.base_unit, self.cycles) for c, v in self.quota_values.items()}

    def template_weight(self, label: str | None = None, tone: str | None = None) -> int:
        return sum(
            w for lab, ton, w in self.template
            if (label is None or lab == label) and (tone is None or ton == tone)
        )

    def expected_marginals(self) -> list[tuple[str, str, int]]:
        """(column, value, expected count), derived from the spec alone."""
        n_items = sum(len(v) for v in self.hierarchy.values())
        per_item = self.rows_per_item * self.cycles
        rows = [(self.group_col, g, len(items) * per_item) for g, items in self.hierarchy.items()]
        rows += [
            (self.tone_col, t, self.template_weight(tone=t) * n_items * self.cycles)
            for t in self.tone_order
        ]
        rows += [
            (self.label_col, e, self.template_weight(label=e) * n_items * self.cycles)
            for e in self.label_order
        ]
        implied: dict[str, int] = {}
        for tone, value in self.implied.items():
            implied[value] = implied.get(value, 0) + self.template_weight(tone=tone) * n_items * self.cycles
        rows += [(self.implied_col, v, n) for v, n in implied.items()]
        for column, quota in self.quotas().items():
            rows += [(column, v, n) for v, n in quota]
        items: dict[str, int] = {}
        for names in self.hierarchy.values():
            for name in names:
                items[name] = items.get(name, 0) + per_item
        return rows + [(self.item_col, v, n) for v, n in items.items()]


def expected_table(spark: SparkSession, spec: BalanceSpec) -> DataFrame:
    """K16 as a table ``(column, value, expected)``; its size is the size of the spec."""
    return spark.createDataFrame(spec.expected_marginals(), "column string, value string, expected long")


def spec_problems(spark: SparkSession, spec: BalanceSpec, total_rows: int | None = None) -> DataFrame:
    """Broken consistency rules of a spec as rows ``(rule, detail)``; empty means usable."""
    total = spec.total_rows if total_rows is None else total_rows
    rows: list[tuple[str, str]] = []
    if spec.base_unit == 0 or total % spec.base_unit:
        rows.append(("total_divisible_by_base_unit", f"{total} % {spec.base_unit}"))
    for group, items in spec.hierarchy.items():
        if len(items) != spec.items_per_group:
            rows.append(("equal_items_per_group", f"{group}: {len(items)}"))
    for column, values in spec.quota_values.items():
        if column in spec.equal_columns and spec.base_unit % len(values):
            rows.append(("base_unit_divisible", f"{column}: {spec.base_unit} % {len(values)}"))
        if sum(n for _, n in spec.quotas()[column]) != spec.total_rows:
            rows.append(("pool_size", column))
    for label, tone, weight in spec.template:
        if (label, tone) in spec.forbidden and weight:
            rows.append(("template_uses_forbidden_pair", f"{label}/{tone}"))
        if label not in spec.label_order or tone not in spec.tone_order:
            rows.append(("template_value_unknown", f"{label}/{tone}"))
        if weight < 0:
            rows.append(("template_weight_negative", f"{label}/{tone}"))
    return spark.createDataFrame(rows, "rule string, detail string")


ColumnMap = dict[str, Column]


@dataclass
class TaskSpec:
    """One fill task. Builders return Columns over the row, so they run inside the JVM.

    line          row -> the row's text in a batch prompt (numbering is added)
    batch_prompt  (number of rows, joined lines) -> prompt
    single_prompt variation number -> prompt of one row
    fallback      () -> output column -> Column, used when no generated value is valid
    inputs        columns the builders read; a table without one of them gets it as blank
    """

    name: str
    output_columns: list[str]
    primary_column: str = ""
    min_length: int = 10
    system_prompt: str = ""
    system_prompt_single: str = ""
    line: Callable[[], Column] | None = None
    batch_prompt: Callable[[Column, Column], Column] | None = None
    single_prompt: Callable[[int], Column] | None = None
    fallback: Callable[[], ColumnMap | None] | None = None
    deduplicate: bool = True
    temperature: float | None = None
    max_retries: int | None = None
    inputs: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.output_columns:
            raise ValueError(f"task {self.name!r} needs at least one output column")
        self.primary_column = self.primary_column or self.output_columns[0]
        if self.primary_column not in self.output_columns:
            raise ValueError(f"task {self.name!r}: {self.primary_column!r} is not an output column")

    @property
    def single_system(self) -> str:
        return self.system_prompt_single or self.system_prompt


class TaskRegistry:
    """Tasks by name; registering a name again replaces the task."""

    def __init__(self) -> None:
        self._tasks: dict[str, TaskSpec] = {}

    def register(self, task: TaskSpec) -> TaskSpec:
        self._tasks[task.name] = task
        return task

    def get(self, name: str) -> TaskSpec | None:
        return self._tasks.get(name)

    def names(self) -> list[str]:
        return list(self._tasks)

    def all(self) -> dict[str, TaskSpec]:
        return dict(self._tasks)


def value_or_blank(name: str) -> Column:
    """Column by name as text, blank when null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
