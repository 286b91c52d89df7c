"""Open date ranges as equi joins, by dyadic blocks of dates.

Day numbers are cut into blocks of 1, 2, 4, ... days. A day lies in one block of every size; the range of all days from (or
up to) a given one is a disjoint union of at most one block of every size. So "an event on or before a date" becomes
the equality of one block of each, and an open range costs ``LEVELS`` rows per day instead of a comparison with every
other day. Blocks of ``2 ** LEVELS`` days hold the whole DATE type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** 23 days are more than the years -9999 to 9999.
LEVELS = 23
_ORIGIN = 1 << (LEVELS - 1)  # makes day numbers positive


def day_number(date: Column) -> Column:
    return F.unix_date(date) + F.lit(_ORIGIN)


def _id(level: Column, block: Column) -> Column:
    """One number for a block: its size in the lowest bits."""
    return block.cast("long") * 32 + level


def blocks_of(date: Column) -> Column:
    """The blocks that hold a date, one of every size."""
    day = day_number(date)
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: _id(k, F.floor(day / F.pow(F.lit(2.0), k))))


def blocks_through(date: Column) -> Column:
    """Disjoint blocks whose union is every day up to and including ``date``.

    The days before N are one block of each size whose bit is set in N: the one that ends where the higher bits do.
    """
    n = (day_number(date) + 1).cast("long")
    half = lambda k: F.floor(n / F.pow(F.lit(2.0), k)).cast("long")
    set_ = F.filter(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: half(k) % 2 == 1)
    return F.transform(set_, lambda k: _id(k, half(k) - 1))


def blocks_from(date: Column) -> Column:
    """Disjoint blocks whose union is every day from ``date`` on, within the largest block."""
    n = day_number(date).cast("long")
    # Walking up from the day: a block of each size that is a right neighbour of the way, and the day itself.
    half = lambda k: F.floor(n / F.pow(F.lit(2.0), k)).cast("long")
    right = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: half(k) % 2 == 0)
    return F.concat(F.array(_id(F.lit(0), n)), F.transform(right, lambda k: _id(k, half(k) + 1)))


def dates_after(rows: DataFrame, start: Column, dates: DataFrame, date: str) -> DataFrame:
    """Every row with every date of ``dates`` that is on or after the row's ``start``.

    The dates (one row per calendar day) are listed under each block that holds them, rows under the blocks that make
    up what follows ``start``; each pair meets in exactly one block. The output itself has a row per pair.
    """
    listed = dates.where(F.col(date).isNotNull()).select(date, F.explode(blocks_of(F.col(date))).alias("_block"))
    asked = rows.withColumn("_start", start).where(F.col("_start").isNotNull())
    asked = asked.withColumn("_block", F.explode(blocks_from(F.col("_start")))).drop("_start")
    return asked.join(listed, "_block").drop("_block")


def aggregated_through(
    grid: DataFrame, keys: list[str], date: str, events: DataFrame, event_date: str, lag: int, measures: dict[str, str]
) -> DataFrame:
    """``grid`` with aggregates of the events of its key up to ``lag`` days after its date; NULL where there are none.

    ``measures`` maps new columns to SQL aggregates that may be taken in parts (max, min, sum), as ``(how, column)``
    text ``how(column)``. Events are aggregated per key and block of dates that holds them, so a grid row
    reads at most one row of each size, whatever its history.
    """
    parts = events.where(F.col(event_date).isNotNull()).withColumn("_block", F.explode(blocks_of(F.col(event_date))))
    parts = parts.groupBy(*keys, "_block").agg(*[F.expr(f"{agg} AS {name}") for name, agg in measures.items()])
    asked = grid.withColumn("_block", F.explode(blocks_through(F.date_add(F.col(date), lag))))
    hows = {name: agg[: agg.index("(")] for name, agg in measures.items()}
    found = asked.join(parts, [*keys, "_block"]).groupBy(*keys, date).agg(
        *[F.expr(f"{how}({name}) AS {name}") for name, how in hows.items()]
    )
    return grid.join(found, [*keys, date], "left")
