"""Point-in-time joins: the latest feature row at or before each spine row's date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ENTITY, KEYS, OBSERVED
from tidemark.operators.grid import by_entity

# What to take from each feature table: the table and the columns wanted from it.
Wanted = Mapping[str, tuple[DataFrame, Sequence[str]]]

# Dates a spine lies on: as a table, or their first and last.
Dates = DataFrame | tuple[dt.date, dt.date]


def point_in_time(
    spine: DataFrame,
    wanted: Wanted,
    *,
    max_age_days: int | None = None,
    unique_spine: bool = False,
    dates: Dates | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """Left as-of join of several feature tables onto ``spine``.

    For every spine row and table the newest feature *row* dated at or before it is taken whole:
    a NULL in that row stays NULL, older rows never fill it. ``max_age_days`` optionally limits
    how old that row may be.

    All tables are resolved in one pass: their rows and the spine keys are unioned, each side
    shuffled once by account, and one window carries each table's last row forward as a struct.
    Feature rows that repeat a key are first reduced to the greatest of them, column by column in the order
    asked for, so an account has one row per calendar day and table, which bounds the window group. Tables named in
    ``unique`` are known not to repeat a key (their last write counted it) and go without that step.
    The spine itself may repeat keys without limit, so unless ``unique_spine`` says it does not,
    its distinct keys are resolved and joined back by both keys, where adaptive execution can
    split a hot key.

    ``dates`` may name the observation dates the spine lies on. Feature rows after the last of
    them (and, with an age limit, too long before the first) are then not read: on a table laid
    out by date the bounds prune partitions.
    """
    wanted = {n: (_near(t, dates, max_age_days), c) for n, (t, c) in wanted.items()}
    for name, (table, _) in wanted.items():
        kind = table.schema[OBSERVED].dataType
        if not isinstance(kind, T.DateType):
            raise TypeError(f"{name}.{OBSERVED} must be a DATE, not {kind.simpleString()}")
    if unique_spine:
        return _resolve(spine, wanted, max_age_days, unique)
    keys = spine.select(*KEYS).distinct()
    return spine.join(_resolve(keys, wanted, max_age_days, unique), KEYS, "left").select(
        *spine.columns, *[c for _, cols in wanted.values() for c in cols]
    )


def _near(table: DataFrame, dates: Dates | None, max_age_days: int | None) -> DataFrame:
    """Rows that some spine date can see."""
    if dates is None:
        return table
    if isinstance(dates, DataFrame):
        first, last = (dates.agg(edge(OBSERVED)).scalar() for edge in (F.min, F.max))
    else:
        first, last = (F.lit(d) for d in dates)
    near = F.col(OBSERVED) <= last
    if max_age_days is not None:
        near &= F.col(OBSERVED) >= F.date_sub(first, max_age_days)
    return table.where(near)


def _resolve(spine: DataFrame, wanted: Wanted, max_age_days: int | None, unique: Collection[str]) -> DataFrame:
    extras = [c for c in spine.columns if c not in KEYS]
    # Feature rows sort before the spine row of the same date, so an exact match is visible.
    rows = by_entity(spine).withColumn("_side", F.lit(1))
    for name, (table, columns) in wanted.items():
        known = table.where(F.col(ENTITY).isNotNull() & F.col(OBSERVED).isNotNull()).select(
            *KEYS, F.struct(F.col(OBSERVED).alias("_at"), *columns).alias(f"_{name}")
        )
        known = by_entity(known)
        if name not in unique:
            # Rows that repeat a key become the greatest of them; partitioned by account already, no shuffle more.
            known = known.groupBy(*KEYS).agg(F.max(f"_{name}").alias(f"_{name}"))
        rows = rows.unionByName(known.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    so_far = (
        Window.partitionBy(ENTITY)
        .orderBy(OBSERVED, "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = rows.select(
        *KEYS,
        "_side",
        *extras,
        *[F.last(f"_{n}", ignorenulls=True).over(so_far).alias(f"_{n}") for n in wanted],
    )
    picked = []
    for name, (_, columns) in wanted.items():
        for column in columns:
            value = F.col(f"_{name}.{column}")
            if max_age_days is not None:
                fresh = F.datediff(F.col(OBSERVED), F.col(f"_{name}._at")) <= max_age_days
                value = F.when(fresh, value)
            picked.append(value.alias(column))
    return carried.where(F.col("_side") == 1).select(*spine.columns, *picked)


def exact_join(spine: DataFrame, wanted: Wanted, dates: Dates | None = None) -> DataFrame:
    """The same result by plain equi joins, valid when every table has a row for each spine key.

    Feature tables built on the observation grid have that property. All joins share both keys,
    so the spine is shuffled once and adaptive execution may split a hot partition. With ``dates``
    only the tables' partitions from the first to the last of them are read.
    """
    joined = spine
    for table, columns in wanted.values():
        joined = joined.join(_near(table, dates, 0).select(*KEYS, *columns), KEYS, "left")
    return joined.select(*spine.columns, *[c for _, cols in wanted.values() for c in cols])
