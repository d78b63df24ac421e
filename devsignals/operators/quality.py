"""Declarative data checks. Each check becomes one row of a result frame:
table, kind, column, severity, failing rows, passed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from devsignals import params
from devsignals.functions import times

ERROR, WARN = "error", "warn"
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    table: str
    kind: str  # not_null, unique, accepted_values, relationships
    columns: tuple[str, ...]
    severity: str = ERROR
    values: tuple[str, ...] = ()
    parent: str = ""

    @property
    def label(self) -> str:
        return ", ".join(self.columns)


class QualityError(Exception):
    """A check of severity `error` found rows."""


@dataclass(frozen=True)
class Source:
    """A frame with the rows of one or several tables: per table a struct column of its name, and `is_<name>`, whether
    the row is one of it. Every row is one of the first table, and the others share the columns of its keys."""
    tables: tuple[str, ...]
    frame: DataFrame


def _alone(name: str, table: DataFrame) -> Source:
    return Source((name,), table.select(F.struct("*").alias(name), F.lit(True).alias(f"is_{name}")))


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


Numbered = Sequence[tuple[int, Check]]


def _broken(check: Check) -> Column:
    column = F.col(f"{check.table}.{check.columns[0]}")
    broken = ~column.isin(*check.values) if check.kind == "accepted_values" else column.isNull()
    return F.col(f"is_{check.table}") & broken


def row_faults(source: Source, checks: Sequence[Check], rules: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """The source's first table with `faults`, the names of the checks and rules that each row breaks by itself."""
    named = [(f"{c.table}.{c.label}: {c.kind}", _broken(c)) for c in checks] + list(rules)
    faults = F.filter(F.array(*[F.when(broken, F.lit(name)) for name, broken in named]), lambda x: x.isNotNull())
    return source.frame.select(F.col(f"{source.tables[0]}.*"), faults.alias("faults"))


def column_faults(source: Source, checks: Numbered) -> DataFrame:
    """check, n: faults of single columns, not_null and accepted_values, in one pass over the source. Accepted
    values count the distinct values outside the list; NULL is not a value."""
    def fault(number: int, check: Check) -> Column:
        value = F.col(f"{check.table}.{check.columns[0]}") if check.kind == "accepted_values" else F.lit(None)
        return F.when(_broken(check), F.struct(F.lit(number).alias("check"), value.cast("string").alias("value")))

    faults = F.filter(F.array(*[fault(*c) for c in checks]), lambda x: x.isNotNull())
    counted = source.frame.select(F.inline(faults)).groupBy("check", "value").agg(F.count(F.lit(1)).alias("copies"))
    return counted.select("check", F.when(F.col("value").isNull(), F.col("copies")).otherwise(1).alias("n"))


def repeated_keys(source: Source, checks: Numbered) -> DataFrame:
    """check, n: keys (of one or several columns) that occur more than once; NULL keys do not count. One grouping
    per key, for all tables of the source that have it."""
    frames = []
    for columns in dict.fromkeys(c.columns for _, c in checks):
        own = [(number, c) for number, c in checks if c.columns == columns]
        keys = [F.col(f"{source.tables[0]}.{c}").alias(c) for c in columns]
        rows = source.frame.select(*keys, *[F.col(f"is_{c.table}").alias(f"in_{number}") for number, c in own])
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        counts = rows.filter(complete).groupBy(*columns).agg(*[F.count_if(f"in_{number}").alias(f"copies_{number}") for number, _ in own])
        repeated = F.array(*[F.struct(F.lit(number).alias("check"), (F.col(f"copies_{number}") > 1).cast("bigint").alias("n"))
                             for number, _ in own])
        frames.append(counts.select(F.inline(repeated)).filter("n > 0"))
    return _stack(frames)


def orphans(tables: Tables, checks: Numbered) -> DataFrame:
    """check, n: rows whose key the parent table lacks. Counted per key before the join, so a key
    that fills much of the table takes one row."""
    frames = []
    for number, check in checks:
        child, parent_key = check.columns[0], check.values[0]
        keys = tables[check.table].filter(F.col(child).isNotNull()).groupBy(child).agg(F.count(F.lit(1)).alias("n"))
        parents = tables[check.parent].select(F.col(parent_key).alias(child))
        frames.append(keys.join(parents, child, "left_anti").select(F.lit(number).alias("check"), "n"))
    return _stack(frames)


def run(tables: Tables, checks: Sequence[Check], shared: Sequence[Source] = ()) -> DataFrame:
    """All checks as one frame. Tables of one source in `shared` are read together; all faults are added up in
    one aggregation."""
    source_of = {name: s for s in shared for name in s.tables}
    numbered: dict[tuple[str, ...], list] = {}
    links = []
    for number, check in enumerate(checks):
        if check.kind == "relationships":
            links.append((number, check))
            continue
        if check.table not in source_of:
            source_of[check.table] = _alone(check.table, tables[check.table])
        numbered.setdefault(source_of[check.table].tables, []).append((number, check))
    frames = [orphans(tables, links)] if links else []
    for own in numbered.values():
        source = source_of[own[0][1].table]
        for function, kinds in ((column_faults, ("not_null", "accepted_values")), (repeated_keys, ("unique",))):
            fitting = [(number, c) for number, c in own if c.kind in kinds]
            if fitting:
                frames.append(function(source, fitting))
    faults = _stack(frames).groupBy("check").agg(F.sum("n").alias("failing"))
    listed = F.array(*[
        F.struct(F.lit(number).alias("check"), F.lit(c.table).alias("table_name"), F.lit(c.kind).alias("check_type"),
                 F.lit(c.label).alias("column_name"), F.lit(c.severity).alias("severity"))
        for number, c in enumerate(checks)
    ])
    failing = F.coalesce("failing", F.lit(0)).cast("bigint")
    return faults.sparkSession.range(1).select(F.inline(listed)).join(faults, "check", "left").select(
        "table_name", "check_type", "column_name", "severity", failing.alias("failing_rows"), (failing == 0).alias("passed"))


def enforce(report: DataFrame) -> None:
    """Raise when a check of severity `error` failed. Reads one row per failed check."""
    broken = report.filter((F.col("severity") == ERROR) & ~F.col("passed")).collect()
    if broken:
        raise QualityError("; ".join(
            f"{r.table_name}.{r.column_name}: {r.check_type} fails for {r.failing_rows}" for r in broken))


# --- business rules: the failing rows themselves ------------------------------

def no_future_timestamps(pushes: DataFrame, requests: DataFrame, as_of: dt.datetime) -> DataFrame:
    now = times.moment(as_of)
    both = _stack([
        df.select(F.lit(name).alias("model_name"), "event_id", "repo_name", "fetched_at")
        for name, df in (("int_push_events", pushes), ("int_pull_requests", requests))
    ])
    return both.filter(F.col("fetched_at") > now).select(
        "*", now.alias("current_time"), times.micros_between(now, F.col("fetched_at")).alias("time_difference_us")
    )


def no_negative_commit_count(pushes: DataFrame) -> DataFrame:
    return pushes.filter(F.col("commit_count") < 0).select("event_id", "repo_name", "commit_count", "fetched_at")


def push_model_integrity(pushes: DataFrame, events: DataFrame) -> DataFrame:
    """Events listed as pushes that the bronze table knows under another type: each listed
    row once per such type. Bronze is reduced to distinct pairs of id and type first, so
    copies of an event are not paired with each other."""
    other = events.filter(F.col("event_type") != params.PUSH).select("event_id", "event_type").distinct()
    return pushes.select("event_id", "repo_name").join(other, "event_id")


def source_freshness(sources: Tables, as_of: dt.datetime, warn_hours: int = params.SOURCE_WARN_HOURS,
                     error_hours: int = params.SOURCE_ERROR_HOURS) -> DataFrame:
    """Age of the newest row per source and whether it is within the limits."""
    age = times.hours_between(F.col("loaded_at"), times.moment(as_of))
    return _stack([
        df.agg(F.max("fetched_at").alias("loaded_at")).select(
            F.lit(name).alias("source_name"), "loaded_at", age.alias("age_hours"))
        for name, df in sources.items()
    ]).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), ERROR)
        .when(F.col("age_hours") > warn_hours, WARN)
        .otherwise("pass"),
    )


def enforce_rules(pushes: DataFrame, requests: DataFrame, events: DataFrame, as_of: dt.datetime) -> None:
    """Raise when a business rule finds rows. Reads one count per rule."""
    rules = {"no_future_timestamps": no_future_timestamps(pushes, requests, as_of),
             "no_negative_commit_count": no_negative_commit_count(pushes),
             "push_model_integrity": push_model_integrity(pushes, events)}
    broken = {name: n for name, rows in rules.items() if (n := rows.count())}
    if broken:
        raise QualityError("; ".join(f"{name} finds {n}" for name, n in broken.items()))
