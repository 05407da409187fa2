"""The tables and how they follow from one another, stored in one shared folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Container, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.config import Settings
from faremill.operators.freshness import source_freshness
from faremill.operators.history import as_new_versions
from faremill.plans import core, intermediate, marts, reports, staging
from faremill.plans.declared_checks import all_checks, failing, run_check
from faremill.sources.catalog import register_table
from faremill.sources.history_table import append_run
from faremill.sources.tables import Audit, newest_day, overwrite_days, read_table, rebalanced, replace_table
from faremill.sources.versions import Store
from faremill.operators.incremental import reload_from, since


@dataclass(frozen=True)
class Model:
    """A plan and its inputs: a view unless ``stored``."""

    plan: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    #: Schema that SQL finds the table in.
    layer: str
    stored: bool = False
    #: A view whose rows are written once per run, for the plans that read it.
    kept: bool = False
    #: Columns the stored rows are sorted by.
    cluster: tuple[str, ...] = ()
    #: Partition column of a table kept by day. With a ``window`` (the column of each input that
    #: limits what a load reads) it is loaded day by day, without one it is rewritten whole.
    day: str | None = None
    window: Mapping[str, str] = field(default_factory=dict)
    #: One row for each row of the only input, which is kept by the same days.
    row_by_row: bool = False
    #: The plan deals its rows by day itself, before they are at their widest.
    deals: bool = False
    #: Column of the first input that a report's range of days applies to.
    dated: str | None = None
    #: Key and change time of a table that keeps every version of its rows.
    history: tuple[str, str] | None = None
    uses_settings: bool = False

    @property
    def written(self) -> bool:
        return self.stored or self.kept


# Names of the schemas.
STAGING, INTERMEDIATE, CORE, FINANCE = "staging", "intermediate", "marts_core", "marts_finance"
OPERATIONS, FRAUD, SNAPSHOTS, REPORTS = "marts_operations", "marts_fraud", "snapshots", "reports"

MODELS: dict[str, Model] = {
    "stg_trips": Model(staging.stg_trips, ("trips_raw",), STAGING),
    # Kept, so that joins to them read plain tables: their true size decides on a broadcast, and
    # beyond it the exchange sits right below the join, where adaptive execution can split the
    # partition of a hot driver or rider. Under a window it could not.
    "stg_drivers": Model(staging.stg_drivers, ("drivers_raw",), STAGING, kept=True),
    "stg_riders": Model(staging.stg_riders, ("riders_raw",), STAGING, kept=True),
    # Kept, because two tables read it: its copies are removed once.
    "stg_payments": Model(staging.stg_payments, ("payments_raw",), STAGING, kept=True),
    "stg_cities": Model(staging.stg_cities, ("cities_raw",), STAGING),
    "stg_driver_status_events": Model(
        staging.stg_driver_status_events,
        ("driver_status_events_raw",),
        STAGING,
        stored=True,
        day="event_date",
        cluster=("driver_id",),
        window={"driver_status_events_raw": "event_timestamp"},
    ),
    "int_trips_enriched": Model(
        intermediate.int_trips_enriched,
        ("stg_trips", "stg_payments", "stg_cities", "stg_drivers", "stg_riders"),
        INTERMEDIATE,
        stored=True,
        # Rewritten whole, since a late payment can change any trip, but kept by day: a load of the
        # fact tables opens the files of its days alone.
        day="trip_date",
        deals=True,
        uses_settings=True,
    ),
    "int_driver_lifetime_stats": Model(
        intermediate.int_driver_lifetime_stats,
        ("int_trips_enriched", "stg_driver_status_events"),
        INTERMEDIATE,
        uses_settings=True,
    ),
    "int_rider_lifetime_value": Model(
        intermediate.int_rider_lifetime_value, ("int_trips_enriched",), INTERMEDIATE, uses_settings=True
    ),
    "fct_trips": Model(
        core.fct_trips,
        ("int_trips_enriched",),
        CORE,
        stored=True,
        day="trip_date",
        cluster=("city_id", "driver_id", "trip_status"),
        window={"int_trips_enriched": "trip_date"},
        row_by_row=True,
    ),
    "dim_cities": Model(
        core.dim_cities, ("stg_cities", "int_trips_enriched"), CORE, stored=True, uses_settings=True
    ),
    "dim_drivers": Model(
        core.dim_drivers,
        ("stg_drivers", "stg_cities", "int_driver_lifetime_stats"),
        CORE,
        stored=True,
        uses_settings=True,
    ),
    "dim_riders": Model(core.dim_riders, ("stg_riders", "int_rider_lifetime_value"), CORE, stored=True),
    "fct_daily_revenue": Model(
        marts.fct_daily_revenue,
        ("fct_trips", "dim_cities"),
        FINANCE,
        stored=True,
        day="trip_date",
        cluster=("city_id",),
        window={"fct_trips": "trip_date"},
    ),
    "fct_payment_reliability": Model(
        marts.fct_payment_reliability, ("stg_payments", "fct_trips"), FINANCE, stored=True
    ),
    "fct_driver_activity": Model(
        marts.fct_driver_activity,
        ("fct_trips", "stg_driver_status_events"),
        OPERATIONS,
        stored=True,
        day="activity_date",
        cluster=("driver_id", "city_id"),
        window={"fct_trips": "trip_date", "stg_driver_status_events": "event_date"},
    ),
    "fct_fraud_monitoring": Model(
        marts.fct_fraud_monitoring, ("fct_trips", "dim_drivers", "dim_riders"), FRAUD, stored=True
    ),
    "drivers_snapshot": Model(
        core.driver_versions, ("stg_drivers",), SNAPSHOTS, stored=True, history=("driver_id", "updated_at")
    ),
    "q01_daily_revenue_by_city": Model(
        reports.daily_revenue_by_city, ("fct_daily_revenue",), REPORTS, dated="trip_date"
    ),
    "q02_gross_vs_net": Model(reports.gross_vs_net, ("fct_trips",), REPORTS),
    "q03_top_drivers": Model(
        reports.top_drivers, ("fct_driver_activity", "dim_drivers"), REPORTS, dated="activity_date"
    ),
    "q04_rider_ltv_by_segment": Model(reports.rider_ltv_by_segment, ("dim_riders",), REPORTS),
    "q05_payment_failure_rate": Model(
        reports.payment_failure_rate, ("fct_payment_reliability",), REPORTS, dated="payment_date"
    ),
    "q06_surge_impact": Model(reports.surge_impact, ("fct_trips", "dim_cities"), REPORTS),
    "q07_driver_churn": Model(reports.driver_churn, ("dim_drivers",), REPORTS),
    "q08_fraud_summary": Model(reports.fraud_summary, ("fct_fraud_monitoring",), REPORTS),
    "q09_city_profitability": Model(reports.city_profitability, ("fct_daily_revenue", "dim_cities"), REPORTS),
    "q10_driver_history": Model(reports.driver_history, ("drivers_snapshot",), REPORTS),
}


def waves(raw: Iterable[str] = ()) -> list[list[str]]:
    """The tables a build writes, in groups that need only earlier groups.

    With the names of raw tables these come first, and views stand in groups too; reports are left out.
    """
    raw = list(raw)
    level = dict.fromkeys(raw, 1)
    for name, model in MODELS.items():
        above = max((level.get(i, 0) for i in model.inputs), default=0)
        level[name] = above + 1 if model.written or raw else above
    groups: dict[int, list[str]] = {}
    for name, at in level.items():
        if name in raw or MODELS[name].written or raw and MODELS[name].layer != REPORTS:
            groups.setdefault(at, []).append(name)
    return [groups[at] for at in sorted(groups)]


class ChecksFailed(Exception):
    """New rows of a table fail checks; ``failures`` holds (check, column, number)."""

    def __init__(self, name: str, failures: list[tuple[str, str, int]]):
        super().__init__(f"{name}: " + ", ".join(f"{check} on {column} ({n})" for check, column, n in failures))
        self.failures = failures


class Lake:
    """Raw tables, a folder for the stored tables, and the plans in between.

    One object stands for one run over the raw data it was given; ``build`` starts a new run. Only
    ``refresh``, ``ensure`` and ``build`` write. Several objects may write to one folder at a time.
    """

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, settings: Settings | None = None
    ):
        self.spark = spark
        self.raw = raw
        self.folder = folder
        self.settings = settings or Settings()
        self._kept: set[str] = set()

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _readable(self, name: str) -> bool:
        """Whether a table's rows are stored; those of a kept view count for one run."""
        model = MODELS[name]
        return name in self._kept if model.kept else model.stored and Store(self.spark, self._path(name)).last() is not None

    def table(self, name: str) -> DataFrame:
        """A raw table, a stored table, or the plan of a view or of a table that was never written."""
        if name in self.raw:
            return self.raw[name]
        if self._readable(name):
            return read_table(self.spark, self._path(name))
        plan = self.plan(name)
        return as_new_versions(plan, *MODELS[name].history).drop("state") if MODELS[name].history else plan

    def plan(
        self,
        name: str,
        first_day: dt.date | None = None,
        days: tuple[dt.date | None, dt.date | None] | None = None,
        by_day: bool = False,
    ) -> DataFrame:
        """The unwritten plan of a model over its input tables.

        ``first_day`` limits what a load reads. ``days`` (first and last, either may be None) is the
        range of a report that has dates. ``by_day`` has a plan that ``deals`` do so, for a writer.
        """
        model = MODELS[name]
        if days and not model.dated:
            raise ValueError(f"{name} has no range of days")
        inputs = []
        for i, source in enumerate(model.inputs):
            df = self.table(source)
            if source in model.window:
                df = since(df, model.window[source], first_day)
            if days and i == 0:
                first, last = days
                df = since(df, model.dated, first)
                df = df if last is None else df.where(F.col(model.dated) <= F.lit(last))
            inputs.append(df)
        deal = {"deal": partial(rebalanced, day=model.day)} if by_day and model.deals else {}
        return model.plan(*inputs, *([self.settings] if model.uses_settings else []), **deal)

    def ensure(self, names: Iterable[str]) -> None:
        """Store what is to be stored of these models and has no rows yet, inputs first."""
        for name in names:
            if name not in self.raw and not self._readable(name):
                self.ensure(MODELS[name].inputs)
                if MODELS[name].written:
                    self.refresh(name)

    def refresh(self, name: str, full_refresh: bool = False, audit: Audit | None = None) -> None:
        """Bring one stored table, or the rows of a kept view, up to date with its inputs.

        ``audit`` sees the table as it is about to be; if it raises, the old version stays.
        """
        model, path = MODELS[name], self._path(name)
        if model.history:
            append_run(self.plan(name), path, *model.history, audit=audit)
        elif model.day is None:
            replace_table(self.plan(name), path, model.cluster, audit)
        else:
            known = model.window and not full_refresh
            first_day = reload_from(newest_day(self.spark, path)) if known else None
            rows = self.plan(name, first_day, by_day=True)
            dealt = model.deals or model.row_by_row and self._readable(model.inputs[0])
            overwrite_days(rows, path, model.day, model.cluster, all_days=first_day is None, audit=audit, dealt=dealt)
        if model.kept:
            self._kept.add(name)

    def build(
        self, full_refresh: bool = False, check: bool = False, warn: Container[tuple[str, str, str]] = ()
    ) -> dict[str, str]:
        """Refresh every kept view and stored table, inputs first; what became of each.

        Tables that do not depend on each other are written at the same time, so that the last
        tasks of one job do not leave the cluster idle. With ``check``, the declared checks of raw
        tables and views run before what reads them, and those of a stored table on its new rows before
        anyone sees them: where one fails, the old rows stay and what depends on them is skipped. The
        checks in ``warn`` (check, table, column) may fail. A table is "built", "checked" (raw table or
        view), "skipped", or has its failures.
        """
        self._kept.clear()
        done: dict[str, str] = {}

        def run(name: str) -> str:
            if name not in self.raw and any(done.get(i) not in (None, "built", "checked") for i in MODELS[name].inputs):
                return "skipped"
            written = name not in self.raw and MODELS[name].written
            audit = partial(self._audit, name, warn) if check else None
            try:
                if written:
                    self.refresh(name, full_refresh, audit)
                elif check:
                    self._audit(name, warn, self.table(name))
            except ChecksFailed as e:
                return str(e)
            return "built" if written else "checked"

        for wave in waves(list(self.raw) if check else []):
            with ThreadPoolExecutor(len(wave)) as pool:
                done.update(zip(wave, list(pool.map(run, wave)), strict=True))
        return done

    def _audit(self, name: str, warn: Container[tuple[str, str, str]], rows: DataFrame) -> None:
        checks = all_checks(lambda t: rows if t == name else self.table(t), name)
        if checks is None:
            return
        found = [r for r in checks.where("failures > 0").collect() if (r["check"], name, r["column_name"]) not in warn]
        if found:
            raise ChecksFailed(name, sorted((r["check"], r["column_name"], r["failures"]) for r in found))

    def check(self, name: str) -> DataFrame:
        """One group of data-quality checks: model, column_name, failures."""
        return run_check(name, self.table)

    def check_all(self) -> DataFrame:
        """Every check: check, model, column_name, failures."""
        return all_checks(self.table)

    def failing(self, check: str, model: str, column: str) -> DataFrame:
        """What fails a check: rows, or values and how often they occur."""
        return failing(check, self.table, model, column)

    def freshness(self, now: dt.datetime | None = None) -> DataFrame:
        return source_freshness(self.raw, now)

    def register(self, prefix: str = "") -> None:
        """Make everything known to SQL by name, as of now.

        Stored tables are found in the schema of their layer (``marts_core.fct_trips``, with ``prefix``
        before the schema's name); every model and raw table, views included, also by its bare name in
        this session. Call again to follow newer versions.
        """
        for name in [*self.raw, *MODELS]:
            self.table(name).createOrReplaceTempView(name)
            if name in MODELS and MODELS[name].stored and self._readable(name):
                store = Store(self.spark, self._path(name))
                register_table(store, store.last(), f"{prefix}{MODELS[name].layer}", name, MODELS[name].day)

    def sql(self, query: str) -> DataFrame:
        """A query over the names that ``register`` made known."""
        return self.spark.sql(query)
