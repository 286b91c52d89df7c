"""Joins of the grid with raw log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ENTITY, EVENT_DATE, KEYS, OBSERVED
from tidemark.operators.dyadic import dates_after
from tidemark.operators.windows import Span


def range_join(grid: DataFrame, spine: DataFrame, log: DataFrame, span: Span) -> DataFrame:
    """Left join every grid row with the log rows its window sees, not aggregated.

    Written as an account equi join with a date range, Spark would bring all events and all
    observations of an account together and test every pair. Here each event is first given
    the observation dates that see it and joined by account *and* date. In a bounded window these
    are the window's days, taken from the event's own date; in an open window, where the output itself has a row per
    event and later date, they are found by equi join on blocks of dates. Events meet the grid in an
    inner join, of which adaptive execution may split either side, and grid rows without events are
    added. ``grid`` must use the dates of ``spine``.

    Spark estimates an exploded side by the size of the rows before the explosion. Both joins are merge joins by
    hint, so that a log just small enough to be sent is not sent once per day of its window.
    """
    day = F.col(EVENT_DATE)
    if span.first is None:
        seen = dates_after(log, F.date_sub(day, span.last), spine, OBSERVED)
    else:
        days = F.sequence(F.date_sub(day, span.last), F.date_sub(day, span.first))
        seen = log.withColumn(OBSERVED, F.explode(days))
    columns = [c for c in log.columns if c != ENTITY]
    inside = grid.join(seen.hint("merge"), KEYS).select(*grid.columns, *columns)
    empty = grid.join(seen.select(*KEYS).distinct().hint("merge"), KEYS, "left_anti")
    nothing = [F.lit(None).cast(log.schema[c].dataType).alias(c) for c in columns]
    return inside.unionByName(empty.select(*grid.columns, *nothing))


def snapshot_join(grid: DataFrame, snapshot: DataFrame, date: str = "date") -> DataFrame:
    """Left join the snapshot row of exactly the observation date."""
    return grid.join(snapshot.withColumnRenamed(date, OBSERVED), KEYS, "left")
