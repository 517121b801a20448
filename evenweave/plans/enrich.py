"""The gap-filling ladder and the tasks built on it.

A batch of rows travels as one nested row (at most ``batch_rows`` small structs), grouped once. From
there all phases are map-only: prompts, generator calls, parsing and assignment look at one batch each,
and a phase narrows the unit of work (batch -> chunk of gaps -> single row) without another shuffle.
Each round of calls is written to the shared folder before anything uses it, so a lost executor costs
at most the calls of its own unfinished tasks.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenweave.functions.text import clean_text, digest, is_filled
from evenweave.operators.assign import (
    add_batches,
    apply_fills,
    ensure_columns,
    existing_values,
    fill_counts,
    fill_status,
    first_of_each_value,
    item_ids,
    item_values,
    number_lines,
    pick_items,
)
from evenweave.operators.bits import bit_table, maybe_in
from evenweave.operators.extract import Cascade, extract_single
from evenweave.session import materialize, materialize_counting, new_run_dir
from evenweave.sources.ledger import append_responses
from evenweave.spec import TaskRegistry, TaskSpec

MOST_TASKS = 10_000
ROUND_TASKS = 256
TASKS_PER_CORE = 16
Generate = Callable[[str, str, float], "str | None"]


@dataclass(frozen=True)
class LadderOptions:
    """How to fill.

    ``factory`` makes a generator, once per partition of requests: ``generate(prompt, system, temperature)``
    returns the response text or None. ``secondary`` makes one that is asked when the first has no answer.
    Calls are slow and prompts small, so every round deals its requests out, by default
    ``requests_per_task`` to a task; small tasks also limit what has to be asked again when an executor is lost. Many requests
    get larger tasks instead of more: a round has at most ``TASKS_PER_CORE`` tasks for every core (or ``ROUND_TASKS``, if that
    is more), and never more than ``MOST_TASKS``. Tasks beyond that keep no further core busy, but each costs a Python
    worker, a file and a block of every task before it. ``concurrency`` sets the number of tasks, hence the most calls at a time.
    ``align`` says how the items of an answer find their rows: by ``position``, or by the ``id`` that prompts ask for.
    ``in_flight`` is the number of calls a task makes at a time, each by a generator of its own; answers keep their order.
    ``answers`` names a folder for answers, kept across runs: equal prompts of a round are asked once, and what was answered
    there, in a run that broke off say, is not asked again. A retry is another round, so it does ask again.
    """

    factory: Callable[[], Generate]
    secondary: Callable[[], Generate] | None = None
    batch_rows: int = 30
    micro_rows: int = 5
    max_retries: int = 3
    variations: int = 6
    temperature: float = 0.7
    temperature_step: float = 0.15
    max_temperature: float = 1.0
    concurrency: int | None = None
    requests_per_task: int = 64
    align: str = "position"
    in_flight: int = 1
    answers: str | None = None

    def tasks(self, requests: int, cores: int = 1) -> int:
        """Number of tasks for so many requests on so many cores."""
        most = min(MOST_TASKS, max(ROUND_TASKS, TASKS_PER_CORE * cores))
        return self.concurrency or max(1, min(most, -(-requests // self.requests_per_task)))


@dataclass
class LadderRun:
    """``table`` is the filled table, ``fills`` the values it got with the phase they came from, and
    ``responses`` every answer with its label."""

    table: DataFrame
    fills: DataFrame
    responses: DataFrame | None


def ask_generator(opts: LadderOptions, system: str, temperature: float):
    """The only place where Python runs: prompts in, raw responses out, errors become null."""
    factory, secondary, in_flight = opts.factory, opts.secondary, opts.in_flight

    def attempt(generate, prompt):
        try:
            return generate(prompt, system, temperature)
        except Exception:
            return None

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mine = threading.local()  # a generator need not be safe for several threads

        def answer(prompt):
            if not hasattr(mine, "first"):
                mine.first, mine.second = factory(), secondary() if secondary else None
            found = attempt(mine.first, prompt)
            return attempt(mine.second, prompt) if found is None and mine.second is not None else found

        if in_flight == 1:
            for prompts in batches:
                yield pd.Series([answer(p) for p in prompts], dtype="object")
            return
        with ThreadPoolExecutor(in_flight) as pool:
            for prompts in batches:
                yield pd.Series(list(pool.map(answer, prompts)), dtype="object")

    ask.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(ask, "string").asNondeterministic()


def cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def ask_all(
    requests: DataFrame, n: int, opts: LadderOptions, system: str, temperature: float,
    keys: tuple[str, ...] = ("batch_id", "chunk", "pos"), turn: str = "",
) -> DataFrame:
    """Ask for every request, about ``n`` of them. A given partition count is not coalesced by size.

    ``turn`` tells rounds apart, for the store of answers.
    """
    if opts.answers:
        return _ask_once(requests, n, opts, system, temperature, turn)
    requests = requests.repartition(opts.tasks(n, cores(requests)), *keys)
    return requests.withColumn("raw", ask_generator(opts, system, temperature)(F.col("prompt")))


def _ask_once(requests: DataFrame, n: int, opts: LadderOptions, system: str, temperature: float, turn: str) -> DataFrame:
    """Answers from the store; prompts that are not there are asked once each, and their answers stored.

    Prompts are matched by digest, so no prompt is shuffled but those to be asked. Of the store only digests that the
    requests may hold are.
    """
    spark, path = requests.sparkSession, opts.answers.rstrip("/")
    words = (F.lit(system), F.lit(str(round(temperature, 6))), F.lit(turn), F.col("prompt"))
    keyed = requests.withColumn("_digest", digest(F.concat_ws("\x1f", *words)))
    schema = "d binary, raw string"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)  # a new store is empty
    stored = spark.read.schema(schema).parquet(path)
    bits = bit_table(keyed, F.xxhash64("_digest"))
    known = maybe_in(stored, F.xxhash64("d"), bits)
    new = keyed.groupBy(F.col("_digest").alias("d")).agg(F.first("prompt").alias("prompt")).join(known, "d", "left_anti")
    asked = new.repartition(opts.tasks(n, cores(new)), "d").withColumn("raw", ask_generator(opts, system, temperature)(F.col("prompt")))
    asked.where("raw IS NOT NULL").select("d", "raw").write.mode("append").parquet(path)
    answers = maybe_in(spark.read.schema(schema).parquet(path), F.xxhash64("d"), bits)
    answers = answers.groupBy(F.col("d").alias("_digest")).agg(F.min("raw").alias("raw"))  # as runs may overlap
    return keyed.join(answers, "_digest", "left").drop("_digest")


def call_label(phase: int, attempt: Column) -> Column:
    """Readable label of a call, such as ``b001_p3m0_a1`` or ``b001_p4s7_v2``."""
    kind = {1: F.lit("p1_a"), 2: F.lit("p2_a")}.get(phase)
    if phase == 3:
        kind = F.concat(F.lit("p3m"), F.col("chunk").cast("string"), F.lit("_a"))
    if phase == 4:
        kind = F.concat(F.lit("p4s"), F.col("pos").cast("string"), F.lit("_v"))
    return F.concat(F.format_string("b%03d_", F.col("batch_id") + 1), kind, attempt.cast("string"))


def _log(df: DataFrame) -> DataFrame:
    return df.select("batch_id", "phase", "chunk", "pos", "attempt", "label", "raw", "n_items")


class _Ladder:
    def __init__(self, df: DataFrame, task: TaskSpec, opts: LadderOptions, run_dir: str):
        self.task, self.opts, self.dir = task, opts, run_dir
        self.base = ensure_columns(df, [*task.output_columns, *task.inputs])
        self.fills: list[DataFrame] = []
        self.logs: list[DataFrame] = []
        self.retries = task.max_retries or opts.max_retries
        # What prompts for single rows and fallbacks read; it travels with the row, so the table is not joined again.
        self.context = [c for c in dict.fromkeys(task.inputs) if c not in ("batch_id", "chunk", "pos", "row_id")]
        # Expressions over the fixed column names of a call table, built once for all rounds.
        self.cascade = Cascade(task.primary_column, task.output_columns)
        self.assignment = self._assignment()
        self.single = self._single_values()
        self.temperature = task.temperature if task.temperature is not None else opts.temperature
        # Digests in use, the table's own and those of each phase, each written once.
        self.used: list[DataFrame] = []
        if task.deduplicate:
            own = existing_values(self.base, task.primary_column, task.min_length)
            self.used.append(materialize(own, f"{run_dir}/used/own"))

    def units(self) -> DataFrame:
        """Unfinished batches as nested rows. The one shuffle of the ladder; finished batches stay out."""
        task = self.task
        row = F.struct(
            "pos",
            "row_id",
            is_filled(task.primary_column, task.min_length).alias("filled"),
            (task.line() if task.line else F.lit("")).alias("line"),
            *([F.struct(*self.context).alias("inputs")] if self.context else []),
        )
        batches = add_batches(self.base, "row_id", self.opts.batch_rows)
        unfilled = ~is_filled(task.primary_column, task.min_length)
        batches = batches.join(batches.where(unfilled).select("batch_id").distinct(), "batch_id", "left_semi")
        grouped = batches.groupBy("batch_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
        return grouped.withColumns({"chunk": F.lit(0), "pos": F.lit(0)})

    def batch_phase(self, units: DataFrame, n: int, phase: int) -> DataFrame:
        """Prompts over the ``n`` units' rows, bounded retries, assignment. Returns units left."""
        task = self.task
        prompt = task.batch_prompt(
            F.size("rows").cast("string"), number_lines(F.transform("rows", lambda r: r["line"]))
        )
        pending = units.withColumn("prompt", prompt)
        answered, self.open_units = [], 0
        for attempt in range(1, self.retries + 1):
            called = ask_all(
                pending, n, self.opts, task.system_prompt, self.temperature, turn=f"p{phase}_a{attempt}"
            ).withColumns({"phase": F.lit(phase), "attempt": F.lit(attempt), "label": call_label(phase, F.lit(attempt))})
            # Ask, parse and assign in one job; what follows only reads the written result.
            done, seen = materialize_counting(
                self._assigned(self.cascade.apply(called)),
                f"{self.dir}/calls/p{phase}_a{attempt}",
                unanswered=F.col("n_items") == 0,
                with_gaps=(F.col("n_items") > 0) & (F.size("gaps") > 0),
            )
            self.logs.append(_log(done))
            last = attempt == self.retries
            answered.append(done if last else done.where("n_items > 0"))
            self.open_units += seen["with_gaps"] + (seen["unanswered"] if last else 0)
            pending, n = done.where("n_items = 0").select(*units.columns, "prompt"), seen["unanswered"]
            if not n:
                break
        keep = [*units.columns, "taken", "gaps"]
        assigned = reduce(DataFrame.unionByName, [a.select(*keep) for a in answered])
        lost = self._add_fills(assigned, phase)
        gaps = F.col("gaps")
        if lost is not None:
            assigned = assigned.join(lost, "batch_id", "left")
            gaps = F.filter(
                "rows",
                lambda r: F.exists("gaps", lambda g: g["row_id"] == r["row_id"])
                | F.coalesce(F.array_contains("lost", r["row_id"]), F.lit(False)),
            )
        return assigned.where(F.size(gaps) > 0).withColumn("rows", gaps).select(*units.columns)

    def _assignment(self) -> list[dict[str, Column]]:
        """E15-E17 on every unit: ``taken`` (row and values) and ``gaps`` (rows that got nothing)."""
        primary = self.task.primary_column
        picks = pick_items(
            F.transform("rows", lambda r: r["filled"]),
            F.transform("values", lambda v: v[primary]),
            self.task.min_length,
            self.task.deduplicate,
            F.col("ids") if self.opts.align == "id" else None,
        )

        def taken(r, i):
            hit = F.col("picks")[i] >= 0
            value = F.when(hit, F.col("values")[F.col("picks")[i]])
            return F.struct(r["row_id"].alias("row_id"), value.alias("v"))

        return [
            {"values": item_values(F.col("items"), self.task.output_columns), "n_items": F.size("items"),
             "ids": item_ids(F.col("items"))},
            {"picks": picks},
            {
                "taken": F.filter(F.transform("rows", taken), lambda t: t["v"].isNotNull()),
                "gaps": F.filter("rows", lambda r, i: ~r["filled"] & (F.col("picks")[i] < 0)),
            },
        ]

    def _assigned(self, parsed: DataFrame) -> DataFrame:
        for columns in self.assignment:
            parsed = parsed.withColumns(columns)
        return parsed.drop("items", "values", "picks", "ids")

    def _add_fills(self, assigned: DataFrame, phase: int) -> DataFrame | None:
        """Note the values of this phase. Returns, per batch, rows that lost theirs as repeats."""
        task = self.task
        candidates = assigned.select("batch_id", F.explode("taken").alias("t")).select(
            "batch_id", "t.row_id", *[F.col(f"t.v.{c}").alias(c) for c in task.output_columns]
        )
        fills, lost = candidates, None
        if task.deduplicate:
            used = reduce(DataFrame.union, self.used)
            kept = materialize(
                first_of_each_value(candidates, task.primary_column, "row_id", used),
                f"{self.dir}/kept/p{phase}",
            )
            fills = candidates.join(kept, "row_id", "left_semi")
            self.used.append(materialize(
                existing_values(fills, task.primary_column, task.min_length), f"{self.dir}/used/p{phase}"))
            losers = candidates.join(kept, "row_id", "left_anti")
            lost = losers.groupBy("batch_id").agg(F.collect_set("row_id").alias("lost"))
        self.fills.append(fills.select("row_id", F.lit(phase).alias("phase"), *task.output_columns))
        return lost

    def chunked(self, units: DataFrame) -> DataFrame:
        """Gaps of a batch in chunks of ``micro_rows``."""
        size = self.opts.micro_rows
        chunks = F.transform(
            F.sequence(F.lit(0), F.call_function("div", F.size("rows") - 1, F.lit(size)).cast("int")),
            lambda k: F.slice(F.col("rows"), k * size + 1, size),
        )
        return units.select("batch_id", "pos", F.posexplode(chunks).alias("chunk", "rows"))

    def _single_values(self) -> list[dict[str, Column]]:
        """X7, X9, E17 on the answer to a single prompt."""
        task = self.task
        found = extract_single(F.col("raw"), task.output_columns, task.min_length)
        valid = F.coalesce(F.length(f"_v_{task.primary_column}") >= task.min_length, F.lit(False))
        return [
            {"found": F.when(F.col("raw").isNotNull(), found)},
            {f"_v_{c}": clean_text(F.element_at("found", c)) for c in task.output_columns},
            {"n_items": valid.cast("int")},
        ]

    def single_phase(self, units: DataFrame) -> DataFrame:
        """One row at a time, variation after variation; the first valid answer wins."""
        task, opts = self.task, self.opts
        pending = units.select("batch_id", "chunk", F.explode("rows").alias("r")).select(
            "batch_id", "chunk", F.col("r.pos").alias("pos"), F.col("r.row_id").alias("row_id"),
            *([F.col("r.inputs.*")] if self.context else []))
        if task.single_prompt is None:
            return pending
        n = pending.count()  # reads what the phases before have written
        for v in range(opts.variations):
            temperature = min(self.temperature + v * opts.temperature_step, opts.max_temperature)
            called = ask_all(
                pending.withColumn("prompt", task.single_prompt(v)), n, opts, task.single_system, temperature,
                turn=f"p4_v{v}",
            )
            for columns in self.single:
                called = called.withColumns(columns)
            called = called.drop("found").withColumns(
                {"phase": F.lit(4), "attempt": F.lit(v), "label": call_label(4, F.lit(v))}
            )
            done, seen = materialize_counting(
                called, f"{self.dir}/calls/p4_v{v}", unanswered=F.col("n_items") == 0
            )
            self.logs.append(_log(done))
            self.fills.append(
                done.where("n_items = 1").select(
                    "row_id", "phase", *[F.col(f"_v_{c}").alias(c) for c in task.output_columns]
                )
            )
            pending, n = done.where("n_items = 0").select(*pending.columns), seen["unanswered"]
            if not n:
                break
        return pending

    def fallback_phase(self, rows: DataFrame) -> None:
        """Rule-based values; a task without them leaves the gaps open."""
        values = self.task.fallback() if self.task.fallback else None
        if values:
            self.fills.append(
                rows.select(
                    "row_id",
                    F.lit(5).alias("phase"),
                    *[
                        # a column the fallback does not name keeps its value
                        (F.coalesce(values[c], F.lit("")) if c in values else F.lit(None).cast("string")).alias(c)
                        for c in self.task.output_columns
                    ],
                )
            )

    def run(self) -> None:
        """Phase after phase until no gap is left."""
        opts = self.opts
        left, seen = materialize_counting(self.units(), f"{self.dir}/units", units=F.lit(True))
        n = seen["units"]
        if self.task.batch_prompt is None:
            left = left.withColumn("rows", F.filter("rows", lambda r: ~r["filled"]))
        else:
            for phase in (1, 2, 3):
                if phase == 3:  # at most so many chunks
                    left, n = self.chunked(left), n * -(-opts.batch_rows // opts.micro_rows)
                left = self.batch_phase(left, n, phase)
                # Repeats that lost their value are gaps too, but known only after deduplication.
                n = left.count() if self.task.deduplicate else self.open_units
                if not n:
                    return
        self.fallback_phase(self.single_phase(left))


def run_ladder(
    df: DataFrame, task: TaskSpec, options: LadderOptions, run_dir: str | None = None
) -> LadderRun:
    """Fill the task's columns of a table that has a dense ``row_id``."""
    spark = df.sparkSession
    run_dir = run_dir or new_run_dir(spark)
    ladder = _Ladder(df, task, options, run_dir)
    ladder.run()
    if ladder.fills:
        fills = materialize(reduce(DataFrame.unionByName, ladder.fills), f"{run_dir}/fills")
    else:
        schema = ", ".join(["row_id long", "phase int", *[f"{c} string" for c in task.output_columns]])
        fills = spark.createDataFrame([], schema)
    responses = reduce(DataFrame.unionByName, ladder.logs) if ladder.logs else None
    return LadderRun(apply_fills(df, fills, task.output_columns), fills, responses)


def phase_report(run: LadderRun) -> DataFrame:
    """Rows filled per phase."""
    return run.fills.groupBy("phase").agg(F.count(F.lit(1)).alias("rows"))


def is_task_complete(df: DataFrame, task: TaskSpec) -> bool:
    """E3."""
    return fill_status(df, task.primary_column, task.min_length).first()["complete"]


def run_task(
    df: DataFrame,
    name: str,
    registry: TaskRegistry,
    options: LadderOptions,
    store=None,
    batches_per_wave: int | None = None,
    resume: bool = True,
    revisit_gaps: bool = True,
) -> DataFrame | None:
    """Run one task on a table; None for an unknown task, the input if it is complete.

    With a ``ProgressStore`` the batches run in waves; each finished wave is saved with a ledger entry.
    A later run resumes there: saved values are applied first, so finished batches are skipped, and
    batches with gaps left are tried again unless ``revisit_gaps`` is off.
    """
    task = registry.get(name)
    if task is None:
        return None
    before = _survey(df, task, store)
    return df if before["complete"] else _fill(
        df, task, before, options, store, batches_per_wave, resume, revisit_gaps)


def _survey(df: DataFrame, task: TaskSpec, store) -> dict:
    """Filled, total and complete; with a store also the data set's fingerprint, in the same scan."""
    if store is None:
        return fill_status(df, task.primary_column, task.min_length).first().asDict()
    columns = ["row_id", *task.inputs, task.primary_column]
    found = df.agg(*store.fingerprint_parts(df, columns), *fill_counts(df, task.primary_column, task.min_length)).first().asDict()
    return found | {
        "complete": task.primary_column in df.columns and found["filled"] == found["total"],
        "fingerprint": store.fingerprint_of(found)}


def _fill(
    df: DataFrame, task: TaskSpec, before, options: LadderOptions, store, batches_per_wave: int | None = None,
    resume: bool = True, revisit_gaps: bool = True,
) -> DataFrame:
    """The work of ``run_task`` for a table whose fill status is known."""
    name = task.name
    if store is None:
        return run_ladder(df, task, options).table

    spark, size = df.sparkSession, options.batch_rows
    n_batches = -(-before["total"] // size)
    wave = batches_per_wave or n_batches
    fingerprint = before["fingerprint"]
    work, first_batch, completed, finished = df, 0, before["filled"], set()
    if not resume or not store.has_snapshot(spark, name, fingerprint):
        store.reset(spark, task, fingerprint)
    else:  # saved values are never asked for again, whatever the ledger says; finished ranges are not even read
        finished = store.finished_parts(spark, name, fingerprint)
        here = store.part_of(F.col("row_id"), size)
        rows = df.where(~here.isin(*sorted(finished))) if finished else df
        saved = store.snapshot(spark, task, fingerprint, store.parts(spark, name, fingerprint, "open"))
        work = apply_fills(rows, saved, task.output_columns)
        progress = store.load(name, fingerprint, spark)
        if progress is not None:
            first_batch, completed = progress["completed_batches"], progress["completed_rows"]
        else:
            each = size * store.range_batches
            completed = fill_status(work, task.primary_column, task.min_length).first()["filled"] + sum(
                min((k + 1) * each, before["total"]) - k * each for k in finished)
    waves = [(s, min(s + wave, n_batches)) for s in range(first_batch, n_batches, wave)]
    before_it = set(range(-(-first_batch // store.range_batches)))
    if revisit_gaps and not before_it <= finished:
        waves.insert(0, (0, first_batch))
    if completed == before["total"]:
        waves = []
    for (start, end), part in zip(waves, _parts(work, waves, size)):
        run = run_ladder(part, task, options)
        if run.responses is not None:
            append_responses(run.responses, store.response_path(name))
        fills = run.fills
        gained = fills.agg(F.count_if(is_filled(task.primary_column, task.min_length)).alias("n"))
        completed += gained.first()["n"]
        store.save(
            fills, task, fingerprint, max(end, first_batch), n_batches, completed, before["total"], size
        )
        _compact_finished(df, task, store, fingerprint, start, end, n_batches, size)
    return apply_fills(df, store.snapshot(spark, task, fingerprint), task.output_columns)


def _compact_finished(
    df: DataFrame, task: TaskSpec, store, fingerprint: str, start: int, end: int, n_batches: int, size: int
) -> None:
    """Compacts the ranges that end with a wave's batches, if all their rows are filled."""
    each, spark = store.range_batches, df.sparkSession
    last = n_batches // each if end < n_batches else -(-n_batches // each)
    ended = [k for k in range(start // each, last) if min((k + 1) * each, n_batches) <= end]
    if not ended:
        return
    here = store.part_of(F.col("row_id"), size)
    rows = df.where(here.isin(*ended))
    filled = apply_fills(rows, store.snapshot(spark, task, fingerprint, set(ended)), task.output_columns)
    whole = F.bool_and(is_filled(task.primary_column, task.min_length)).alias("whole")
    for r in filled.groupBy(here.alias("part")).agg(whole).where("whole").collect():  # a row per range
        store.compact(spark, task, fingerprint, r["part"])


def _parts(work: DataFrame, waves: list[tuple[int, int]], size: int) -> Iterator[DataFrame]:
    """The rows of each wave. Several waves are written once, a folder each, so that no wave joins the saved values again."""
    if len(waves) < 2:
        return (work.where((F.col("row_id") >= a * size) & (F.col("row_id") < b * size)) for a, b in waves)
    ends = sorted(b for _, b in waves)  # waves cover stretches that follow each other
    number = F.array_size(F.filter(F.array(*map(F.lit, ends)), lambda e: F.col("row_id") >= e * size)) if len(ends) <= 64 else \
        F.when(F.col("row_id") < ends[0] * size, 0).otherwise(
            1 + F.floor((F.col("row_id") - ends[0] * size) / ((ends[1] - ends[0]) * size)))
    named = work.withColumn("_wave", number.cast("int")).where(F.col("row_id") >= min(a for a, _ in waves) * size)
    path = f"{new_run_dir(work.sparkSession)}/waves"
    named.write.partitionBy("_wave").parquet(path)
    written = work.sparkSession.read.schema(named.schema).parquet(path)
    place = {b: i for i, b in enumerate(ends)}
    return (written.where(F.col("_wave") == place[b]).drop("_wave") for _, b in waves)


def run_tasks(
    df: DataFrame,
    names: list[str],
    registry: TaskRegistry,
    options: LadderOptions,
    store=None,
    validate: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame | None, list[str], list[str], DataFrame | None]:
    """Tasks one after the other, tables handed on as they are.

    Unknown names are passed over, complete tasks skipped; a task without result ends the run. Returns
    the table, the tasks run, the tasks skipped and, if ``validate`` is given, its violations.
    """
    done, skipped = [], []
    for name in names:
        task = registry.get(name)
        if task is None:
            continue
        before = _survey(df, task, store)
        if before["complete"]:
            skipped.append(name)
            continue
        # Later tasks read this table several times: keep it, not the plan behind it.
        df = materialize(_fill(df, task, before, options, store), f"{new_run_dir(df.sparkSession)}/after-{name}")
        if df.isEmpty():
            return None, done, skipped, None
        done.append(name)
    return df, done, skipped, validate(df) if validate else None
