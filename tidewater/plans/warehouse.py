"""Named tables and the jobs that produce them.

A job is a function ``(warehouse, dt) -> DataFrame``. It reads its inputs through the warehouse, which serves a
stored table where one is given and otherwise the plan of the job with that name. A deployment stores every
layer and passes :func:`path_tables`; a test passes DataFrames and lets the layers compose into one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce
from graphlib import TopologicalSorter
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dims import OPEN_END, closed_on
from tidewater.sinks.writers import overwrite_intervals, overwrite_partition

Job = Callable[["Warehouse", "str | None"], DataFrame]
Table = "DataFrame | Callable[[], DataFrame]"

@dataclass(frozen=True)
class Window:
    """The days of an input that a run over the days ``first`` to ``last`` reads.

    ``back`` days before the first are read too, None means every day up to the last. With ``since_open`` the window starts
    no later than the day on which the oldest open row of the job's state was opened. ``day`` is the input's day column; an
    input without it is read whole.
    """

    back: int | None = 0
    since_open: bool = False
    day: str = "dt"


DAY, WHOLE, OPEN_DAYS = Window(), Window(None), Window(since_open=True)


@dataclass(frozen=True)
class Intervals:
    """A table whose rows stay open until something closes them; it is partitioned by the day that closed them, open rows
    under OPEN_END. What the days before the first run closed is stored under the first day of that run.

    ``reopen`` takes the rows that are open or were closed by a given day or a later one, and that day, and gives them as
    they stood on its eve. So a day can be run again, and only the open rows and the days of the run are written.
    ``opened`` is the day on which a row was opened.
    """

    reopen: Callable[[DataFrame, str], DataFrame]
    opened: str


@dataclass(frozen=True)
class Spec:
    inputs: tuple[str, ...] = ()
    milestones: tuple[str, ...] = ()
    reads: Mapping[str, Window] = field(default_factory=dict)
    state: str | None = None
    intervals: Intervals | None = None


JOBS: dict[tuple[str, str], Job] = {}
SPECS: dict[tuple[str, str], Spec] = {}


def job(domain: str, *inputs: str, milestones: tuple[str, ...] = (), reads: Mapping[str, Window] | None = None,
        state: str | None = None, intervals: Intervals | None = None) -> Callable[[Job], Job]:
    """Register a job under (domain, function name) with the tables it reads.

    ``milestones`` are day columns that are filled after the day of the row; a run rewrites the days they touch. ``reads``
    states which days of an input a run needs; other inputs are read whole. ``state`` names the interval table that the
    job reads as it stood before the run.
    """

    def register(fn: Job) -> Job:
        JOBS[domain, fn.__name__] = fn
        SPECS[domain, fn.__name__] = Spec(inputs, milestones, reads or {}, state, intervals)
        return fn

    return register


class Warehouse:
    def __init__(self, domain: str, tables: Mapping[str, Table], as_of: str | None = None, start: str | None = None,
                 since: str | None = None):
        """``as_of`` is the day at which dated snapshots are read by jobs that run over many days, ``start`` the day of the
        first load of histories, ``since`` the first day of a run that builds on stored state."""
        self.domain = domain
        self.as_of, self.start, self.since = as_of, start, since
        self._given = set(tables)
        self._tables = dict(tables)

    def derive(self, tables: Mapping[str, Table], as_of: str | None = None, since: str | None = None) -> Warehouse:
        """The same warehouse with some tables given or replaced."""
        return Warehouse(self.domain, {**{n: self._tables[n] for n in self._given}, **tables}, as_of or self.as_of, self.start, since)

    def window(self, name: str, first: str | None, last: str) -> Warehouse:
        """The inputs of a job cut to the days that it reads in a run over ``first`` (None: the beginning) to ``last``. The
        cuts are plain filters on day columns, so stored tables are pruned by partition."""
        spec = SPECS[self.domain, name]

        def cut(table: str, read: Window) -> DataFrame:
            df = self.table(table)
            if read.day not in df.columns:
                return df
            day = F.col(read.day)
            rows = df.where(day <= F.lit(last).cast("date"))
            if first is None or read.back is None:
                return rows
            lower = str(date.fromisoformat(first) - timedelta(days=read.back))
            return rows.where(day >= F.lit(min(lower, self._oldest_open(spec.state) or lower) if read.since_open else lower).cast("date"))

        return self.derive({t: (lambda t=t, r=r: cut(t, r)) for t, r in spec.reads.items()}, since=self.since)

    def _oldest_open(self, state: str) -> str | None:
        """The day on which the oldest open row of a state was opened."""
        opened = SPECS[self.domain, state].intervals.opened
        before = self.before(state)
        if before is None:
            return None
        return before.where(F.col("dt") == F.lit(OPEN_END).cast("date")).agg(F.min(opened).cast("date").cast("string")).first()[0]

    def stored(self, name: str) -> bool:
        """The table was given, so no job has to compute it."""
        return name in self._given

    def table(self, name: str) -> DataFrame:
        """All days of a table."""
        found = self._tables.get(name)
        if found is None:
            if (self.domain, name) not in JOBS:
                raise KeyError(f"no table or job {name!r} in {self.domain}")
            found = JOBS[self.domain, name](self, None)
        elif callable(found):
            found = found()
        self._tables[name] = found
        return found

    def scan(self, name: str, dt: str | None = None) -> DataFrame:
        """A table restricted to one day. On a stored table the filter prunes partitions. A table without ``dt``
        is a current snapshot and is read as it is."""
        df = self.table(name)
        if dt is None and name.endswith("_full") and self.stored(name) and "dt" in df.columns:
            raise ValueError(f"{name} holds a copy per day: give a day")
        if dt is not None and "dt" in df.columns:
            df = df.where(F.col("dt") == F.lit(dt).cast("date"))
        return df

    def snapshot(self, name: str, dt: str | None = None) -> DataFrame:
        """A dimension or dictionary at one day: the day given, else ``as_of``. A stored one with days needs either,
        as each of its days holds every row."""
        day = dt or self.as_of
        if day is None and self.stored(name) and "dt" in self.table(name).columns:
            raise ValueError(f"{name} holds a copy per day: give a day or a warehouse with as_of")
        return self.scan(name, day)

    def before(self, name: str) -> DataFrame | None:
        """A to-date table as of the day before the run, where it is stored."""
        return self.table(f"{name}@before") if self.stored(f"{name}@before") else None

    def run(self, name: str, dt: str | None = None) -> DataFrame:
        """The plan of a job, whether or not its table is stored."""
        return JOBS[self.domain, name](self, dt)

    def at(self, name: str, dt: str) -> DataFrame:
        """One day of a table: read where it is stored, else computed by its job for that day."""
        return self.scan(name, dt) if self.stored(name) else self.run(name, dt)

    def build_order(self, names: Iterable[str]) -> list[str]:
        """The jobs needed for ``names``, inputs first; tables that are given need no job."""
        graph: dict[str, set[str]] = {}
        todo = list(names)
        while todo:
            name = todo.pop()
            if name in graph or self.stored(name):
                continue
            spec = SPECS.get((self.domain, name))
            if spec is None:
                continue
            graph[name] = {i for i in (*spec.inputs, *([spec.state] if spec.state else [])) if (self.domain, i) in JOBS}
            todo += graph[name]
        return [n for n in TopologicalSorter(graph).static_order() if n in graph]


def materialize(
    spark: SparkSession, warehouse: Warehouse, root: str, names: Iterable[str], dt: str, days: int = 1
) -> Warehouse:
    """Run the jobs behind ``names`` for one day, inputs first, and store each result under ``root/<name>``.

    A daily run stores one day of every table, and the open and earlier days that a milestone of that day touches. The
    first run of a warehouse takes ``days`` = 30, so that n-day jobs find their history in the facts and one-day tables.
    Inputs are cut to the days that a job declares. Dimensions are read at the run's day. A to-date table adds the day to
    the table of the day before; without that, or where its job keeps no state, it comes from the whole history of the
    sources and the to-date tables that the run has stored. An interval table is built from the whole history by the first run, from its open rows and the run's days
    afterwards; a run of an earlier day takes it back to that day, so the days after it must be run again. Repeating a run
    changes nothing. Returns a warehouse that reads the stored tables.
    """
    sources = warehouse.derive({}, dt)
    stored: dict[str, Table] = {}
    for name in sources.build_order(names):
        path = f"{root.rstrip('/')}/{name}"
        result = _result(spark, sources, stored, root, name, dt, days)
        if SPECS[sources.domain, name].intervals:
            overwrite_intervals(spark, result, path, _first_day(dt, days), OPEN_END)
        else:
            overwrite_partition(result, path, None if _is_history(name) else dt)
        stored |= path_tables(spark, root, [name])
    return sources.derive(stored)


def daily_plan(spark: SparkSession, warehouse: Warehouse, root: str, name: str, dt: str, days: int = 1) -> DataFrame:
    """What :func:`materialize` would store for one job, given the other tables stored under ``root``."""
    sources = warehouse.derive({}, dt)
    needed = [n for n in sources.build_order([name]) if n != name]
    return _result(spark, sources, path_tables(spark, root, needed), root, name, dt, days)


def _result(spark: SparkSession, sources: Warehouse, stored: Mapping[str, Table], root: str, name: str, dt: str, days: int) -> DataFrame:
    spec, first = SPECS[sources.domain, name], _first_day(dt, days)
    path, layers = f"{root.rstrip('/')}/{name}", sources.derive(stored)
    if spec.intervals:
        before = _reopened(spark, path, spec.intervals, first)
        if before is not None:
            layers = layers.derive({f"{name}@before": before}, since=first)
        rows = layers.window(name, None if before is None else first, dt).run(name)
        closed = F.col("dt") if "dt" in rows.columns else closed_on(F.col("end_date"))
        return rows.withColumn("dt", F.greatest(closed, F.lit(first).cast("date")))
    if _is_history(name):
        if spec.state:
            state = SPECS[sources.domain, spec.state].intervals
            before = _reopened(spark, f"{root.rstrip('/')}/{spec.state}", state, first)
            layers = layers.derive({f"{spec.state}@before": before}, since=first)
        return _touched(layers.window(name, first, dt).run(name), spec.milestones, dt, days)
    if name.endswith("_td"):
        before = _stored_day(spark, path, _day_before(dt))
        if before is not None:
            return layers.derive({f"{name}@before": before}).run(name, dt)
        return sources.derive({n: t for n, t in stored.items() if n.endswith("_td")}).run(name, dt)
    return layers.run(name, dt)


def _is_history(name: str) -> bool:
    return name.startswith("dwd_") or name.endswith("_1d")


def _first_day(dt: str, days: int) -> str:
    return str(date.fromisoformat(dt) - timedelta(days=days - 1))


def _day_before(dt: str) -> str:
    return str(date.fromisoformat(dt) - timedelta(days=1))


def _reopened(spark: SparkSession, path: str, intervals: Intervals, first: str) -> DataFrame | None:
    """An interval table as it stood before ``first``, or None where it is not stored yet."""
    rows = _stored(spark, path)
    return None if rows is None else intervals.reopen(rows.where(F.col("dt") >= F.lit(first).cast("date")), first)


def _touched(rows: DataFrame, milestones: Sequence[str], dt: str, days: int) -> DataFrame:
    """The rows of the run's days, open rows, and all rows of days in which a row reached a milestone."""
    last = F.lit(dt).cast("date")

    def of_run(column: str) -> Column:
        return (F.col(column) > F.date_sub(last, days)) & (F.col(column) <= last)

    current = of_run("dt") | (F.col("dt") == F.lit(OPEN_END).cast("date"))
    if not milestones:
        return rows.where(current)
    changed = reduce(or_, [F.coalesce(of_run(m), F.lit(False)) for m in milestones], current)
    return rows.join(rows.where(changed).select("dt").distinct(), "dt", "left_semi").select(*rows.columns)


def _stored_day(spark: SparkSession, path: str, dt: str) -> DataFrame | None:
    return _stored(spark, f"{path}/dt={dt}")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def path_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, Callable[[], DataFrame]]:
    """Stored Parquet tables ``root/<name>``, partitioned by ``dt`` where the table has days."""
    return {n: (lambda n=n: spark.read.parquet(f"{root.rstrip('/')}/{n}")) for n in names}
