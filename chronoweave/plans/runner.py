"""Running configured imports: select, check, compute, replace, log.

All imports of a procedure and sort order run as one plan. When such a plan fails, it is halved
until the faulty imports stand alone, so one bad import does not stop the others.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.calendar import continuous_week
from chronoweave.functions.session import register_functions
from chronoweave.functions.text import error_json, field_list, flag_set, sql_text, to_int
from chronoweave.model import OPEN_FROM, SERIES, Run, local_table
from chronoweave.operators import alert, correlation, imports, parallel, regression, split, ytd
from chronoweave.operators.copies import copy_imports, copy_series
from chronoweave.operators.replace import Scope, scope_of, write_back
from chronoweave.plans.changes import Change, change_of, derived_scope, narrowed
from chronoweave.plans.config import (
    current_year_window,
    due,
    in_run_order,
    resolve_config,
    select_imports,
    to_run,
    with_parameters,
    with_run_columns,
)
from chronoweave.plans.levels import levels
from chronoweave.plans.runlog import DEBUG, FAILED, SUCCEEDED, WARNING, RunLog, Timer
from chronoweave.plans.store import FactStore
from chronoweave.sources.generators import interval_dimension
from chronoweave.sources.staged import Staged, StagedFile, stage_files
from chronoweave.sources.views import fact_day_view, fact_intraday_view

CATEGORY = "SERIES RUN"


@dataclass
class Tables:
    """Configuration and input tables. `sources` names what imports may read; other names are
    looked up in the catalog. `dates` holds attributes that users keep per date, for filters
    and alert periods."""

    imports: DataFrame
    procedures: DataFrame
    activity: DataFrame
    forecast: DataFrame
    staged: DataFrame | None = None
    sources: dict[str, DataFrame] = field(default_factory=dict)
    dates: DataFrame | None = None


@dataclass
class Outcome:
    """What happened to one import."""

    run: Run
    errors: int = 0
    warnings: int = 0
    deleted: int = 0
    inserted: int = 0
    updated: int = 0
    blocked: bool = False
    marked: bool = False  # its source rows hold its id; a retry does not mark them again

    def summary(self, number: int) -> dict:
        # The keys of an import's summary in the run log.
        return {
            "N": number,
            "Errors": self.errors,
            "Warnings": self.warnings,
            "Deleted": self.deleted,
            "Inserted": self.inserted,
            "Updated": self.updated,
            "DateImportFrom": self.run.date_from,
            "DateImportUntil": self.run.date_until,
        }


def totals(outcomes: Sequence[Outcome]) -> dict:
    """The summary of a run over its imports."""
    # The keys of a run's summary in the run log.
    return {
        "Imports": len(outcomes),
        "Errors": sum(o.errors for o in outcomes),
        "Warnings": sum(o.warnings for o in outcomes),
        "Deleted": sum(o.deleted for o in outcomes),
        "Inserted": sum(o.inserted for o in outcomes),
        "Updated": sum(o.updated for o in outcomes),
    }


class Runner:
    """Runs configured imports against the fact stores.

    `codes` maps a configured procedure code to an operator name; a code that is an operator
    name needs no entry. `default_current_year` turns open windows into the current year.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Tables,
        day: FactStore,
        intraday: FactStore | None = None,
        log_path: str | None = None,
        when: dt.datetime | None = None,
        codes: dict[str, str] | None = None,
        default_current_year: bool = False,
        on_source_update: Callable[[str, DataFrame], None] | None = None,
        calendar: tuple[dt.date, dt.date] | None = None,
    ):
        self.spark, self.tables, self.day, self.intraday = spark, tables, day, intraday
        self.when = when or dt.datetime.now(dt.timezone.utc)
        self.codes = codes or {}
        self.default_current_year = default_current_year
        self.on_source_update = on_source_update
        # First and last day that open windows of splits and alerts reach to.
        self.calendar = calendar
        self.has_views = False
        register_functions(spark, self.when)
        self.log = RunLog(spark, uuid.uuid4().hex, log_path)
        self.plans: dict[tuple[str, ...], DataFrame] = {}
        # Days of series that this session has replaced; others may be added before a run of changes.
        self.changes: list[Change] = []

    # --- entry points ---------------------------------------------------------------

    def run(
        self,
        procedure_code: str,
        *,
        activity_id: int = 0,
        forecast_id: int = 0,
        import_id: int = 0,
        site_id: int = 0,
        procedure_name: str = "",
        category: str = "",
        commands: str = "",
        p: str = "{}",
        changed_only: bool = False,
    ) -> list[Outcome]:
        """Runs the selected active imports of a procedure code; returns one outcome each.

        With `changed_only` derived imports run for the days that `changes` can reach, or not at all. Their
        series then are those of a full run, if they were before the changes.
        """
        operator = self.codes.get(procedure_code, procedure_code)
        if operator not in OPERATORS:
            raise ValueError(f"no operator for procedure code {procedure_code!r}")
        timer = Timer()
        self.log.add(CATEGORY, "START", site=site_id, object=operator, data=commands)
        outcomes, extras = self._prepare(
            operator, procedure_code, import_id, site_id, activity_id, forecast_id, procedure_name, category, commands, p
        )
        for batch in _batches(outcomes, operator):
            if changed_only and operator != "import":
                self._narrow(operator, batch)
            self._run_batch(operator, batch, extras)
        self._summaries(operator, outcomes, commands, site_id, timer)
        self.log.flush()
        if self.has_views:
            self.create_views()  # those before show the facts as they were
        return outcomes

    def run_all(
        self, app: str = "SP", status: str = "TEST", commands: str = "", changed_only: bool = False
    ) -> dict[str, dict]:
        """Runs every active procedure of an app and status in its sort order. A failing
        procedure does not stop the next. With `changed_only` derived series follow what the
        imports before them have replaced."""
        timer = Timer()
        self.log.add("SESSION", "START", data=commands)
        results: dict[str, dict] = {}
        for row in self._procedures(app, status):
            name = row["procedure_name"] or ""
            try:
                done = self.run(row["procedure_code"], procedure_name=name, commands=commands, changed_only=changed_only)
                results[name] = totals(done)
            except Exception as e:  # noqa: BLE001 - the batch goes on, the log keeps the error
                results[name] = {"Errors": 1, "Message": str(e)}
                self.log.add(
                    "SESSION", "PROCEDURE", FAILED, object=row["procedure_code"], object_sub=name,
                    data=error_json(e, row["procedure_code"]),
                )
        self.log.add("SESSION", "FINISH", duration=timer.seconds())
        self.log.flush()
        return results

    def load_files(self, files: Sequence[StagedFile], folder: str) -> Staged:
        """Stages user files under `folder` for the imports that read them, and logs bad lines and files
        left out. Staged rows of earlier files stay unless a file of the same id is read again."""
        timer = Timer()
        found = stage_files(self.spark, files, folder, self.log.session)
        for file in files:
            n = found.errors.get(file.file_id, 0)
            if n:
                left_out = file.file_id in found.rejected
                self.log.add(
                    "FILE", "LOAD", FAILED if left_out else WARNING, site=file.site_id, object=file.path, object_id=file.file_id,
                    data="file left out" if left_out else "lines set aside", value=n,
                )
        self.log.add("FILE", "END", FAILED if found.rejected else SUCCEEDED, duration=timer.seconds(), value=sum(found.errors.values()))
        rows = found.rows
        if self.tables.staged is not None:
            again = local_table(self.spark, [{"file_id": f.file_id} for f in files], "file_id int")
            rows = self.tables.staged.join(again, "file_id", "left_anti").select(*rows.columns).unionByName(rows)
        self.tables.staged = rows
        self.log.flush()
        return found

    def create_views(self) -> None:
        """Temporary views for reports in SQL: `fact_day`, `fact_day_view` and `import_run`, and
        with an intraday store `fact_intraday` and `fact_intraday_view`."""
        self.has_views = True
        t = self.tables
        views = {
            "fact_day": self.day.read(),
            "fact_day_view": fact_day_view(self.day.read(), t.activity, t.forecast),
            "import_run": resolve_config(
                t.imports, t.procedures, t.activity, t.forecast, self.when.date()
            ),
        }
        if self.intraday is not None:
            facts = self.intraday.read()
            intervals = interval_dimension(self.spark)
            views["fact_intraday"] = facts
            views["fact_intraday_view"] = fact_intraday_view(facts, t.activity, t.forecast, intervals)
        for name, rows in views.items():
            rows.createOrReplaceTempView(name)

    def copy_imports(
        self, ids: str, forecast_to: int, first_id: int, commands: str = ""
    ) -> DataFrame:
        """Copies imports to another forecast; with `-DATADAY` also their day facts, replacing
        what an earlier copy wrote. Returns the new imports with `old_import_id`."""
        copies = copy_imports(self.tables.imports, ids, forecast_to, first_id, self.when)
        if "DATADAY" in flag_set(commands):
            new = copy_series(self.day.read(), copies, forecast_to)
            # One row per copied series: configuration size.
            spans = (
                new.groupBy("import_id", "site_id", "activity_id")
                .agg(F.min("date").alias("first"), F.max("date").alias("last"))
                .collect()
            )
            if spans:
                scopes = [
                    Scope(r["import_id"], r["site_id"], forecast_to, r["first"], r["last"], r["activity_id"])
                    for r in spans
                ]
                _, added = self.day.replace(new, scopes)
                self.log.add("APP", "COPY SERIES", object="copy_imports", value=sum(added.values()))
        self.log.flush()
        return copies

    def run_levels(self, app: str = "SP", status: str = "TEST", commands: str = "") -> dict[str, dict]:
        """Runs every active procedure of an app and status as `run_all` does, but import by import in the order
        of what they read and write: what does not depend on each other runs together, whatever procedure
        it belongs to. Imports that depend on each other in a ring fail."""
        timer = Timer()
        self.log.add("SESSION", "START", data=commands)
        results, nodes, extras = {}, [], {}
        outcomes: dict[str, tuple[str, list[Outcome]]] = {}
        for row in self._procedures(app, status):
            code, name = row["procedure_code"], row["procedure_name"] or ""
            operator = self.codes.get(code, code)
            try:
                if operator not in OPERATORS:
                    raise ValueError(f"no operator for procedure code {code!r}")
                chosen, more = self._prepare(operator, code, procedure_name=name, commands=commands)
            except Exception as e:  # noqa: BLE001 - the others go on, the log keeps the error
                results[name] = {"Errors": 1, "Message": str(e)}
                self.log.add("SESSION", "PROCEDURE", FAILED, object=code, object_sub=name, data=error_json(e, code))
                continue
            outcomes[name] = (operator, chosen)
            extras |= more
            nodes += [(operator, o) for o in chosen if not o.blocked]
        order, rings = levels([(operator, o.run) for operator, o in nodes])
        for ring in rings:
            ids = [nodes[i][1].run.import_id for i in ring]
            for i in ring:
                self._fail(*nodes[i], "DEPENDENCIES TEST", ValueError(f"imports that read what each other writes: {ids}"))
        for number, level in enumerate(order):
            by_operator: dict[str, list[Outcome]] = {}
            for i in level:
                by_operator.setdefault(nodes[i][0], []).append(nodes[i][1])
            self.log.add("SESSION", "LEVEL", value=number, data={o: [x.run.import_id for x in found] for o, found in by_operator.items()})
            for operator, found in by_operator.items():
                for batch in _batches(found, operator, by_procedure=False):
                    self._run_batch(operator, batch, extras)
        for name, (operator, found) in outcomes.items():
            self._summaries(operator, found, commands, 0, timer)
            results[name] = totals(found)
        self.log.add("SESSION", "FINISH", duration=timer.seconds())
        self.log.flush()
        if self.has_views:
            self.create_views()
        return results

    def _procedures(self, app: str, status: str) -> list:
        """The active procedures in their order: configuration."""
        active = (F.col("app") == app) & (F.col("status") == status) & F.col("active")
        chosen = self.tables.procedures.where(active).orderBy("sort_order", "procedure_id")
        return chosen.select("procedure_code", "procedure_name").collect()

    def _prepare(
        self, operator: str, procedure_code: str, import_id: int = 0, site_id: int = 0, activity_id: int = 0, forecast_id: int = 0,
        procedure_name: str = "", category: str = "", commands: str = "", p: str = "{}",
    ) -> tuple[list[Outcome], dict]:
        """The selected imports, those that may not run blocked, and the settings that only imports use."""
        rows = select_imports(
            resolve_config(
                self.tables.imports, self.tables.procedures, self.tables.activity,
                self.tables.forecast, self.when.date(),
            ),
            procedure_code, import_id, site_id, activity_id, forecast_id, procedure_name, category,
        )
        # Configuration only, never data: the texts are needed here to build the plans.
        chosen = in_run_order(with_parameters(rows, p)).collect()
        extras = {
            r["import_id"]: (r["source_import_id_field"], r["intraday_duration"]) for r in chosen
        }
        outcomes = [Outcome(to_run(r, commands)) for r in chosen]
        if self.default_current_year:
            for o in outcomes:
                o.run = current_year_window(o.run, self.when.date())
        if operator in ("split", "alert") and self.calendar:
            for o in outcomes:
                o.run = o.run.closed(self.calendar)
        self._check_schedules(operator, outcomes)
        self._check_parameters(operator, outcomes)
        return outcomes, extras

    # --- checks ---------------------------------------------------------------------

    def _fail(self, operator: str, o: Outcome, step: str, error: BaseException) -> None:
        o.errors += 1
        o.blocked = True
        self.log.add(
            CATEGORY, step, FAILED, site=o.run.site_id, object=operator,
            object_sub=o.run.procedure_name, object_id=o.run.import_id,
            data=error_json(error, operator),
        )

    def _warn(self, operator: str, o: Outcome, step: str, text: str) -> None:
        o.warnings += 1
        if o.run.has("LOG_WARNING"):
            self.log.add(
                CATEGORY, step, WARNING, site=o.run.site_id, object=operator,
                object_sub=o.run.procedure_name, object_id=o.run.import_id, data=text,
            )

    def _check_schedules(self, operator: str, outcomes: Sequence[Outcome]) -> None:
        """A schedule is a test over the run's date, time stamp and calendar attributes."""
        planned = [o for o in outcomes if o.run.schedule.strip() and not o.run.has("NOSCHEDULE")]
        if not planned:
            return
        today = with_run_columns(
            self.spark.range(1).select(
                F.lit(self.when.date()).alias("date"), F.lit(self.when).alias("run_ts")
            )
        )
        tests: dict[str, object] = {}
        for o in planned:
            text = sql_text(o.run.schedule)
            if text in tests:
                continue
            try:
                tests[text] = today.select(due(text).alias("ok")).first()["ok"]
            except Exception as e:  # noqa: BLE001 - any error in user text fails that import
                tests[text] = e
        for o in planned:
            result = tests[sql_text(o.run.schedule)]
            if isinstance(result, Exception):
                self._fail(operator, o, "SCHEDULE TEST", result)
            elif not result:
                o.blocked = True
                self._warn(operator, o, "SCHEDULE TEST", "not executed due to the schedule")

    def _check_parameters(self, operator: str, outcomes: Sequence[Outcome]) -> None:
        check = _CHECKS.get(operator, lambda run: None)
        for o in outcomes:
            if o.blocked:
                continue
            try:
                check(o.run)
                if operator.startswith("regression") and self.tables.staged is None:
                    raise ValueError("a regression needs the staged parameter rows")
            except Exception as e:  # noqa: BLE001
                self._fail(operator, o, "PARAMETERS TEST", e)
                continue
            if o.run.date_until < o.run.date_from:
                o.blocked = True
                self._warn(operator, o, "PARAMETERS TEST", "the window ends before it starts")

    # --- batches --------------------------------------------------------------------

    def _narrow(self, operator: str, batch: list[Outcome]) -> None:
        """Leaves each import the days that changes reach; one that they do not reach does not run."""
        for o in batch:
            if o.blocked:
                continue
            run = narrowed(operator, o.run, self.changes)
            if run is None:
                o.blocked = True
                self._warn(operator, o, "CHANGES TEST", "nothing that it reads has changed")
            else:
                o.run = run

    def _run_batch(self, operator: str, batch: list[Outcome], extras: dict) -> None:
        live = [o for o in batch if not o.blocked]
        if not live:
            return
        try:
            if operator == "import":
                self._import(live, extras)
            else:
                self._derive(operator, live)
        except Exception as e:  # noqa: BLE001 - narrowed down to the import it belongs to
            if len(live) == 1:
                self._fail(operator, live[0], "INSERT DAY", e)
                return
            for o in live:  # what was already written is replaced by the next attempt
                o.deleted = o.inserted = 0
            middle = len(live) // 2
            self._run_batch(operator, live[:middle], extras)
            self._run_batch(operator, live[middle:], extras)

    def _import(self, outcomes: list[Outcome], extras: dict) -> None:
        by_source: dict[str, list[Outcome]] = {}
        for o in outcomes:
            by_source.setdefault(_bare(o.run.source), []).append(o)
        if len(by_source) > 1:
            for group in by_source.values():
                self._run_batch("import", group, extras)
            return
        name = _bare(outcomes[0].run.source)
        source = self._source(name)

        measured = [o for o in outcomes if not o.run.has("NODELTA") or o.run.has("FORCEDELTA")]
        if measured:
            windows = {
                r["import_id"]: r
                for r in imports.delta_windows(source, [o.run for o in measured]).collect()
            }
            for o in measured:
                w = windows[o.run.import_id]
                if not w["has_rows"]:
                    o.blocked = True
                    self._warn("import", o, "DELTA DETECTION", "no source rows in the window")
                o.run = o.run.with_window(w["date_from"], w["date_until"])
        outcomes = [o for o in outcomes if not o.blocked]
        if not outcomes:
            return

        marked = {
            o.run.import_id: extras[o.run.import_id][0] or "import_id"
            for o in outcomes
            if extras[o.run.import_id][0] or o.run.has("SOURCE_FILTER_IMPORT")
        }
        fields = set(marked.values())
        if len(fields) > 1:
            raise ValueError(f"imports of one source mark different id fields: {sorted(fields)}")
        import_field = fields.pop() if fields else ""
        if import_field:
            marking = [o for o in outcomes if o.run.import_id in marked and not o.marked]
            if marking:
                source = self._write_back(name, source, marking, import_field)

        day = [o for o in outcomes if not o.run.has("NODAY")]
        if day:
            new = imports.import_day(source, [o.run for o in day], self.when, import_field)
            self._store("import", "DAY", self.day, new, day, [scope_of(o.run) for o in day])
        quarter = [o for o in outcomes if o.run.has("INTRADAY") and not o.run.has("NOINTRADAY")]
        if quarter:
            if self.intraday is None:
                raise ValueError("an intraday import needs an intraday store")
            durations = {o.run.import_id: extras[o.run.import_id][1] for o in quarter}
            rows = source if name else self.intraday.read()
            new = imports.import_intraday(rows, [o.run for o in quarter], self.when, durations)
            self._store(
                "import", "INTRADAY", self.intraday, new, quarter, [scope_of(o.run) for o in quarter]
            )

    def _write_back(self, name: str, source: DataFrame, outcomes: list[Outcome], import_field: str) -> DataFrame:
        """Marks the rows that imports read, where the source is kept: in the day store, in
        `Tables.sources`, or in the catalog's table."""
        runs = [o.run for o in outcomes]
        marked = write_back(source, runs, import_field)
        if any(r.has("PRINT") for r in runs):
            return marked.drop("updated_by")
        counts = {
            r["updated_by"]: r["n"]
            for r in marked.where(F.col("updated_by").isNotNull())
            .groupBy("updated_by")
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        }
        source = marked.drop("updated_by")
        if not name:
            first, last = min(r.date_from for r in runs), max(r.date_until for r in runs)
            # A store's rows are dated by their own column, whatever the imports date them by.
            own = all((sql_text(r.group_by) or "date") == "date" for r in runs)
            self.day.update(
                lambda rows: write_back(rows, runs, import_field).drop("updated_by"),
                first if own else dt.date.min, last if own else dt.date.max,
            )
            source = self.day.read()
        elif _bare(name) in self.tables.sources:
            if self.spark.sparkContext.getCheckpointDir():
                source = source.checkpoint()  # so that batch after batch does not stack up plans
            self.tables.sources[_bare(name)] = source
        else:
            # A table cannot be overwritten while it is read, hence the copy beside it.
            copy = f"{_bare(name)}_marked_{uuid.uuid4().hex}"
            source.write.saveAsTable(copy)
            self.spark.table(copy).write.insertInto(_bare(name), overwrite=True)
            self.spark.sql(f"DROP TABLE {copy}")
            source = self.spark.table(_bare(name))
        for o in outcomes:
            o.updated, o.marked = counts.get(o.run.import_id, 0), True
        if self.on_source_update is not None:
            self.on_source_update(name, source)
        return source

    def _derive(self, operator: str, outcomes: list[Outcome]) -> None:
        t = self.tables
        if operator == "regression":
            repeated = regression.lag_parameters(t.staged, [o.run for o in outcomes]).where("repeated")
            bad = {r["import_id"] for r in repeated.select("import_id").collect()}
            for o in outcomes:
                if o.run.import_id in bad:
                    error = ValueError(f"import {o.run.import_id}: repeated parameter category")
                    self._fail(operator, o, "PARAMETERS TEST", error)
            outcomes = [o for o in outcomes if not o.blocked]
            if not outcomes:
                return
        runs = [o.run for o in outcomes]
        facts = self._facts_for(operator, runs)
        if operator == "ytd":
            new = ytd.year_to_date(facts, runs, t.activity, self.when, t.dates)
        elif operator == "parallel":
            new = parallel.parallel_period(facts, runs, t.activity, self.when, t.dates)
        elif operator == "split":
            new = split.split_totals(facts, runs, self.when, dates=t.dates)
        elif operator == "correlation":
            new = correlation.correlation_forecast(facts, runs, self.when)
        elif operator == "regression":
            new = regression.regression_lag_categories(facts, t.staged, runs, self.when)
        elif operator == "regression_simple":
            new = regression.regression_simple(facts, t.staged, runs, self.when)
        else:
            new = alert.alert_series(facts, runs, t.activity, self.when, dates=t.dates)
        self._store(operator, "DAY", self.day, new, outcomes, [derived_scope(operator, r) for r in runs])

    def _facts_for(self, operator: str, runs: Sequence[Run]) -> DataFrame:
        """The day facts an operator can need: only the months its windows reach."""
        first, last = min(r.date_from for r in runs), max(r.date_until for r in runs)
        if operator in ("ytd", "alert"):
            return self.day.where_days(first, last)
        if operator in ("regression", "regression_simple"):
            return self.day.where_days(max(first, OPEN_FROM) - dt.timedelta(regression.HISTORY_DAYS), last)
        if operator == "parallel":
            spans = [parallel.source_span(r) for r in runs]
            return self.day.where_days(min(s[0] for s in spans), max(s[1] for s in spans))
        if operator == "split":
            return self.day.read_by_month()  # profiles are often those of a year
        return self._correlation_facts(runs) if operator == "correlation" else self.day.read()

    def _correlation_facts(self, runs: Sequence[Run]) -> DataFrame:
        """The months of a correlation: those of its weeks, and as many beside them as hold the weeks with
        data, of each series it reads, that smoothing and lags may look at."""
        first, last, weeks = correlation.reach(runs)
        stored = self.day.days()
        if stored is None:
            return self.day.read()
        read = {(r.site_id, a, f) for r in runs for a, f, _ in correlation.reads(r)}
        series = local_table(self.spark, [dict(zip(SERIES, s)) for s in sorted(read)], "site_id int, activity_id int, forecast_id int")

        def enough(lo: dt.date, hi: dt.date, least: int) -> bool:
            week = continuous_week(F.col("date"))
            found = self.day.where_days(lo, hi).join(series, SERIES).groupBy(*SERIES).agg(F.count_distinct(week).alias("weeks"))
            return found.where(F.col("weeks") >= least).count() == len(read)

        step = dt.timedelta(7 * weeks + 31)
        start, end = first, last
        while start > stored[0]:
            start = max(first - step, stored[0]) if first - dt.date.min > step else stored[0]
            if enough(start, first - dt.timedelta(1), weeks):
                break
            step *= 2
        step = dt.timedelta(38)
        while end < stored[1]:
            end = min(last + step, stored[1])
            if enough(last + dt.timedelta(1), end, 1):
                break
            step *= 2
        return self.day.where_days(start, end)

    def _store(self, operator, step, store, new, outcomes: list[Outcome], scopes: list[Scope]) -> None:
        logged = [o.run for o in outcomes if o.run.has("LOG_QUERY")]
        if logged:
            # All imports of the batch share this plan, so it is logged once.
            self.log.add(
                CATEGORY, f"INSERT {step}", DEBUG, site=logged[0].site_id, object=operator,
                object_sub=logged[0].procedure_name, object_id=logged[0].import_id,
                data=new._jdf.queryExecution().optimizedPlan().toString(), value=len(logged),
            )
        printed = [o.run.has("PRINT") for o in outcomes]
        if any(printed):
            if not all(printed):
                raise ValueError("imports with and without -PRINT run separately")
            self.plans[(operator, step, *(str(o.run.import_id) for o in outcomes))] = new
            return
        timer = Timer()
        deleted, added = store.replace(new, scopes, self.tables.activity, self.tables.dates)
        if store is self.day:
            self.changes.extend(change_of(s) for s in scopes)
        for o in outcomes:
            o.deleted += deleted.get(o.run.import_id, 0)
            o.inserted += added.get(o.run.import_id, 0)
            if o.run.has("LOG_ROWCOUNT"):
                for name, counts in (("DELETE", deleted), ("INSERT", added)):
                    self.log.add(
                        CATEGORY, f"{name} {step}", SUCCEEDED, site=o.run.site_id, object=operator,
                        object_sub=o.run.procedure_name, object_id=o.run.import_id,
                        duration=timer.seconds(), value=counts.get(o.run.import_id, 0),
                    )

    def _source(self, name: str) -> DataFrame:
        if not name:
            return self.day.read()
        bare = _bare(name)
        return self.tables.sources[bare] if bare in self.tables.sources else self.spark.table(bare)

    def _summaries(self, operator, outcomes, commands, site_id, timer: Timer) -> None:
        for number, o in enumerate(outcomes, 1):
            if o.errors or o.run.has("LOG_IMPORTS"):
                self.log.add(
                    CATEGORY, "IMPORT SUMMARY", FAILED if o.errors else SUCCEEDED,
                    site=o.run.site_id, object=operator, object_sub=o.run.procedure_name,
                    object_id=o.run.import_id, data=o.summary(number),
                    value=o.errors or o.warnings,
                )
        if not outcomes and "LOG_WARNING" in flag_set(commands):
            self.log.add(CATEGORY, "END", WARNING, object=operator, data="no active imports found")
        done = totals(outcomes)
        self.log.add(
            CATEGORY, "END", FAILED if done["Errors"] else SUCCEEDED, site=site_id, object=operator,
            data=done, duration=timer.seconds(), value=done["Errors"] or done["Warnings"],
        )


def _bare(name: str) -> str:
    """A source's name without the brackets it may be written in."""
    return name.replace("[", "").replace("]", "").strip()


OPERATORS = (
    "import", "ytd", "parallel", "split", "correlation", "regression", "regression_simple", "alert",
)


def _check_import(run: Run) -> None:
    imports.shape_of(run)


def _check_source_forecast(run: Run) -> None:
    if not to_int(run.p1):
        raise ValueError(f"import {run.import_id}: p1 must name the forecast to read")


def _check_split(run: Run) -> None:
    if not run.filter.strip() or not run.source.strip():
        raise ValueError(f"import {run.import_id}: a split needs a filter and totals in source")
    run.closed()


def _check_alert(run: Run) -> None:
    run.closed()
    alert.wants([run])
    if len(field_list(run.fields_source)) > 1:
        raise ValueError(f"import {run.import_id}: an alert tests a single field")


_CHECKS = {
    "import": _check_import,
    "ytd": _check_source_forecast,
    "parallel": _check_source_forecast,
    "split": _check_split,
    "correlation": correlation.check,
    "regression": regression.check,
    "regression_simple": regression.check,
    "alert": _check_alert,
}


def _batches(outcomes: Sequence[Outcome], operator: str, by_procedure: bool = True) -> list[list[Outcome]]:
    """Imports that may run as one plan, in order; of one procedure and sort order, unless said otherwise.

    Later sort orders and procedures see what earlier ones wrote. Two imports that write the
    same series do not share a plan, so the later one replaces the earlier as it should; nor do
    dry runs and real ones.
    """
    out: list[list[Outcome]] = []
    groups: dict[tuple, list[Outcome]] = {}
    for o in outcomes:
        own = (o.run.sort_order, o.run.procedure_name) if by_procedure else ()
        groups.setdefault((*own, o.run.has("PRINT")), []).append(o)
    for group in groups.values():
        waves: list[tuple[set, list[Outcome]]] = []
        last: dict[object, int] = {}
        for o in group:
            scope = derived_scope(operator, o.run)
            target = (scope.site_id, scope.forecast_id)
            series = (*target, scope.activity_id)
            if scope.activity_id is None:
                wave = 1 + max([n for k, n in last.items() if k[:2] == target], default=-1)
            else:
                wave = 1 + max(last.get(series, -1), last.get((*target, None), -1))
            last[series] = wave
            while len(waves) <= wave:
                waves.append((set(), []))
            waves[wave][1].append(o)
        out.extend(w for _, w in waves)
    return out
