"""Observation dates and the entity-by-date grid."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ENTITY, EVENT_DATE, OBSERVED
from tidemark.sources.tables import inline_dates


def by_entity(df: DataFrame) -> DataFrame:
    """Shuffle rows by account into a fixed number of partitions.

    The number is ``spark.sql.shuffle.partitions`` (or ``spark.tidemark.grid.partitions``). It is
    fixed on purpose: adaptive execution would merge partitions by the size of the shuffled rows,
    not knowing that an account row is about to become one row per date, or that a sort and a
    window over many unioned tables follow.
    """
    conf = df.sparkSession.conf
    n = conf.get("spark.tidemark.grid.partitions", None) or conf.get("spark.sql.shuffle.partitions")
    return df.repartition(int(n), ENTITY)


def date_spine(log: DataFrame, column: str = EVENT_DATE) -> DataFrame:
    """The distinct dates of a log. Partial aggregation leaves one row per task and date."""
    return log.select(F.col(column).alias(OBSERVED)).distinct()


def latest(df: DataFrame, column: str) -> Column:
    """Largest value of a column as a scalar subquery, for use inside a filter.

    Spark runs the subquery first and hands its value to the scan of the filtered table, so a
    table laid out by that column reads only the partitions that can match.
    """
    return df.agg(F.max(column)).scalar()


def observable(spine: DataFrame, horizon_days: int) -> DataFrame:
    """Dates whose next ``horizon_days`` dates lie inside the spine's range.

    The newest date comes from a one-row cross join. As a filter it would be pushed below the
    spine's DISTINCT, and the log would be scanned once for each side; this way the two sides
    share one shuffle.
    """
    newest = spine.agg(F.max(OBSERVED).alias("_newest"))
    seen = F.col(OBSERVED) <= F.date_sub("_newest", horizon_days)
    return spine.join(F.broadcast(newest), seen).select(OBSERVED)


def observation_grid(
    accounts: DataFrame,
    spine: DataFrame,
    *,
    keep: Sequence[str] = (),
    until: str | None = None,
    date: str = OBSERVED,
    colocate: bool = False,
) -> DataFrame:
    """Every account on every spine date from its creation on (and before ``until``, if set).

    The spine is broadcast. Its size is bounded by the DATE type itself: one row per calendar
    day, 3.65 million for the years 1 to 9999 and a few thousand for real logs. Nothing else is
    ever broadcast here, so the account table may have any size.

    With ``colocate`` the narrow account rows are shuffled by account *before* they are
    expanded. The expansion keeps that partitioning, so windows by account need no shuffle of
    the (much larger) grid.
    """
    alive = F.col(date) >= F.col("created_at")
    if until is not None:
        alive &= F.col(until).isNull() | (F.col(date) < F.col(until))
    wanted = list(dict.fromkeys([ENTITY, "created_at", *([until] if until else []), *keep]))
    rows = accounts.select(*wanted)
    if colocate:
        rows = by_entity(rows)
    return rows.join(F.broadcast(spine), alive).select(ENTITY, date, *keep)


def grid_for_dates(accounts: DataFrame, dates: Iterable[dt.date], column: str = EVENT_DATE) -> DataFrame:
    """The grid over an explicit list of dates."""
    return observation_grid(accounts, inline_dates(accounts.sparkSession, dates, column), date=column)


def interval_to_daily(intervals: DataFrame, spine: DataFrame, start: str, end: str, flag: str) -> DataFrame:
    """One row per interval row and spine date telling whether ``start <= date < end``.

    A NULL start means never, a NULL end means still open.
    """
    day = F.col(OBSERVED)
    inside = (
        F.col(start).isNotNull() & (day >= F.col(start)) & (F.col(end).isNull() | (day < F.col(end)))
    )
    return intervals.crossJoin(F.broadcast(spine)).select(
        ENTITY, OBSERVED, F.coalesce(inside, F.lit(False)).alias(flag)
    )


@dataclass(frozen=True)
class Axis:
    """Observation dates to compute, with what is known about their bounds.

    ``days`` is the explicit list (a slice). ``first``/``last`` are columns, usually scalar
    subqueries. With neither, the axis is the whole spine and logs are read in full.
    """

    spine: DataFrame
    days: tuple[dt.date, ...] | None = None
    first: Column | None = None
    last: Column | None = None

    @classmethod
    def of_days(cls, spark, days: Iterable[dt.date]) -> Axis:
        days = tuple(sorted(set(days)))
        bounds = {"first": F.lit(days[0]), "last": F.lit(days[-1])} if days else {}
        return cls(inline_dates(spark, days, OBSERVED), days, **bounds)

    @classmethod
    def latest_of(cls, log: DataFrame, column: str = EVENT_DATE) -> Axis:
        """The single newest date of a log."""
        newest = latest(log, column)
        spine = log.agg(F.max(column).alias(OBSERVED)).where(F.col(OBSERVED).isNotNull())
        return cls(spine, None, newest, newest)

    @property
    def bounded(self) -> bool:
        return self.first is not None or self.days is not None

    def events(self, log: DataFrame, column: str, reach: tuple[int | None, int]) -> DataFrame:
        """Rows of ``log`` that an observation date can see through offsets ``reach``."""
        if not self.bounded:
            return log
        if self.days is not None and not self.days:
            return log.where(F.lit(False))
        back, ahead = reach
        day = F.col(column)
        if back is None:
            return log.where(day <= F.date_add(self.last, ahead))
        if self.days is None:
            return log.where(
                (day >= F.date_add(self.first, back)) & (day <= F.date_add(self.last, ahead))
            )
        hit = None
        for lo, hi in _merge(self.days, back, ahead):
            piece = day.between(F.lit(lo), F.lit(hi))
            hit = piece if hit is None else hit | piece
        return log.where(hit)


def _merge(days: Sequence[dt.date], back: int, ahead: int) -> list[tuple[dt.date, dt.date]]:
    """Merge the windows of sorted days into disjoint ranges, so filters stay short."""
    merged: list[tuple[dt.date, dt.date]] = []
    for day in days:
        lo, hi = day + dt.timedelta(days=back), day + dt.timedelta(days=ahead)
        if merged and lo <= merged[-1][1] + dt.timedelta(days=1):
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged
