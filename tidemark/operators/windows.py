"""Date-range aggregation of an event log at every observation date.

All forms work on *daily partials*: one row per account and event date, pre-aggregated with
map-side combine. However many events one account has, it brings at most one row per calendar
day into the windows, so a hot account never forms an unbounded group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ENTITY, EVENT_DATE, KEYS, OBSERVED
from tidemark.operators.dyadic import aggregated_through
from tidemark.operators.grid import by_entity


@dataclass(frozen=True)
class Span:
    """Inclusive day offsets from the observation date; ``first=None`` is all history."""

    first: int | None
    last: int


def last_dates(n: int) -> Span:
    """Exactly ``n`` dates ending on the observation date."""
    return Span(1 - n, 0)


def back_to(n: int) -> Span:
    """From ``n`` days ago through the observation date, that is ``n + 1`` dates."""
    return Span(-n, 0)


def next_dates(n: int) -> Span:
    """The ``n`` dates after the observation date."""
    return Span(1, n)


TO_DATE = Span(None, 0)
SAME_DATE = Span(0, 0)


@dataclass(frozen=True)
class Rolling:
    """One windowed column: ``how`` of ``measure`` over ``span``. Empty sums are 0, maxima NULL."""

    name: str
    measure: str
    span: Span
    how: str = "sum"


def reach(rollings: Sequence[Rolling]) -> tuple[int | None, int]:
    """Smallest and largest day offset that any of the windows looks at."""
    firsts = [r.span.first for r in rollings]
    return (None if None in firsts else min(firsts)), max(r.span.last for r in rollings)


def daily_partials(log: DataFrame, measures: Mapping[str, str], date: str = EVENT_DATE) -> DataFrame:
    """One row per account and date with the given aggregates, written as SQL text."""
    return (
        log.where(F.col(ENTITY).isNotNull() & F.col(date).isNotNull())
        .groupBy(ENTITY, F.col(date).alias(EVENT_DATE))
        .agg(*[F.expr(f"{agg} AS {name}") for name, agg in measures.items()])
    )


def attach(grid: DataFrame, daily: DataFrame, rollings: Sequence[Rolling], form: str = "frame") -> DataFrame:
    """Add the rolling columns to every grid row, rows without events included.

    ``frame``   union of grid and partials, one window pass per account;
    ``join``    the range join as written, then an aggregation; open windows from blocks of dates;
    ``spread``  every partial is sent to the observation dates that see it, then an equi join.

    All three return the same rows; ``spread`` cannot express an unbounded span.

    A measure that ``exact_parts`` split into whole numbers is windowed part by part and put together at the end.
    """
    split = [r for r in rollings if f"{r.measure}__0" in daily.columns]
    if not split:
        return _FORMS[form](grid, daily, list(rollings))
    parts = [
        Rolling(f"{r.name}__{k}", f"{r.measure}__{k}", r.span) for r in split for k in [*range(LIMBS + 1), "n"]
    ]
    rows = _FORMS[form](grid, daily, [r for r in rollings if r not in split] + parts)
    return rows.selectExpr(*grid.columns, *[f"{_joined(r.name)} AS {r.name}" if r in split else r.name for r in rollings])


#: Whole numbers of 32 bits each that hold the fraction of a double in an exact sum.
LIMBS = 3
_LARGEST = float(1 << 52)


def with_exact_parts(rows: DataFrame, amount: str) -> DataFrame:
    """Columns whose sums give the exact sum of a DOUBLE column: its floor, ``LIMBS`` times 32 bits of its fraction, and
    whether it is out of range (not finite, or 2**52 and more).

    Sums of whole numbers do not depend on their order and can be subtracted, so a moving window is the difference of
    two that only grow. Bits below 2**-96 are dropped, which doubles from about 1e-13 on do not have.
    """
    fit = f"coalesce(abs({amount}) < {_LARGEST:.1f}D, {amount} IS NULL)"
    rows = rows.withColumn("_rest", F.expr(f"CASE WHEN {fit} THEN {amount} END"))
    for k in range(LIMBS + 1):
        rows = rows.withColumns({
            f"{amount}__{k}": F.expr("CAST(floor(_rest) AS BIGINT)"),
            "_rest": F.expr("(_rest - floor(_rest)) * 4294967296D"),
        })
    return rows.withColumn(f"{amount}__n", F.expr(f"CASE WHEN {fit} THEN 0L ELSE 1L END")).drop("_rest")


def exact_parts(name: str, amount: str, condition: str | None = None) -> dict[str, str]:
    """Daily measures that sum the parts of ``amount`` where ``condition`` holds."""
    out = {}
    for k in [*range(LIMBS + 1), "n"]:
        value = f"{amount}__{k}"
        out[f"{name}__{k}"] = f"sum({value})" if condition is None else f"sum(CASE WHEN {condition} THEN {value} END)"
    return out


def _joined(name: str) -> str:
    """The double nearest to the sum whose parts are given; NaN where an amount was out of range."""
    # Carry what exceeds 32 bits to the next part up, so that each part is exact as a double.
    whole, text = [f"{name}__{LIMBS}"], ""
    for k in range(LIMBS - 1, -1, -1):
        whole.append(f"({name}__{k} + shiftright({whole[-1]}, 32))")
    fraction = "0D"
    for part in whole[:-1]:
        fraction = f"(({fraction} + CAST({part} & 4294967295L AS DOUBLE)) / 4294967296D)"
    text = f"CAST({whole[-1]} AS DOUBLE) + {fraction}"
    return f"CASE WHEN {name}__n > 0 THEN double('NaN') ELSE {text} END"


def _is_exact(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DecimalType))


def _zero(kind: T.DataType) -> str:
    return "0D" if isinstance(kind, (T.DoubleType, T.FloatType)) else "0L"


def _offset(days: int) -> str:
    """A day offset in the words of a window frame."""
    if days == 0:
        return "CURRENT ROW"
    return f"{abs(days)} {'FOLLOWING' if days > 0 else 'PRECEDING'}"


def _frame(grid: DataFrame, daily: DataFrame, rollings: list[Rolling]) -> DataFrame:
    # Window columns are written as SQL text: there can be dozens, and text reaches the JVM in
    # one call instead of several calls per column.
    kinds = {f.name: f.dataType for f in daily.schema.fields}
    extras = [c for c in grid.columns if c not in KEYS]
    points = grid.withColumnsRenamed({OBSERVED: "_day"}).withColumn("_grid", F.lit(True))
    marks = by_entity(daily.withColumnsRenamed({EVENT_DATE: "_day"}).withColumn("_grid", F.lit(False)))
    rows = points.unionByName(marks, allowMissingColumns=True)

    windows: dict[str, str] = {}

    def over(measure: str, how: str, first: int | None, last: int) -> str:
        frame = f"{'UNBOUNDED PRECEDING' if first is None else _offset(first)} AND {_offset(last)}"
        text = (
            f"{how}({measure}) OVER (PARTITION BY {ENTITY} ORDER BY unix_date(_day) RANGE BETWEEN {frame})"
        )
        return windows.setdefault(text, f"_w{len(windows)}")

    results: list[str] = []
    for r in rollings:
        kind, span = kinds[r.measure], r.span
        zero = _zero(kind)
        if r.how == "sum" and span.first is not None and _is_exact(kind):
            # A frame that starts at the beginning only ever grows, so Spark adds each row to it
            # once, while a frame with a moving start is recomputed for every row. In exact
            # arithmetic a bounded window is the difference of two growing ones.
            upper = over(r.measure, "sum", None, span.last)
            lower = over(r.measure, "sum", None, span.first - 1)
            value = f"coalesce({upper}, {zero}) - coalesce({lower}, {zero})"
        else:
            # Floating point sums would lose digits in a difference, and a maximum has none.
            value = over(r.measure, r.how, span.first, span.last)
            if r.how == "sum":
                value = f"coalesce({value}, {zero})"
        results.append(f"{value} AS {r.name}")

    seen = rows.selectExpr(ENTITY, "_day", "_grid", *extras, *[f"{w} AS {n}" for w, n in windows.items()])
    return seen.where("_grid").selectExpr(ENTITY, f"_day AS {OBSERVED}", *extras, *results)


def _aggregates(rollings: list[Rolling], offset: str, kinds: dict[str, T.DataType]) -> list[Column]:
    """Conditional aggregates over rows carrying the event's day ``offset`` from the observation."""
    out = []
    for r in rollings:
        inside = f"{offset} <= {r.span.last}"
        if r.span.first is not None:
            inside += f" AND {offset} >= {r.span.first}"
        value = f"{r.how}(CASE WHEN {inside} THEN {r.measure} END)"
        if r.how == "sum":
            value = f"coalesce({value}, {_zero(kinds[r.measure])})"
        out.append(F.expr(f"{value} AS {r.name}"))
    return out


def _join(grid: DataFrame, daily: DataFrame, rollings: list[Rolling]) -> DataFrame:
    """Bounded windows by range join; open ones from blocks of dates, without a pair of an event and every later date."""
    bounded = [r for r in rollings if r.span.first is not None]
    rows = _range_join(grid, daily, bounded) if bounded else grid
    for last in sorted({r.span.last for r in rollings if r.span.first is None}):
        of_span = [r for r in rollings if r.span == Span(None, last)]
        measures = {r.name: f"{r.how}({r.measure})" for r in of_span}
        rows = aggregated_through(rows, [ENTITY], OBSERVED, daily, EVENT_DATE, last, measures)
    kinds = {f.name: f.dataType for f in daily.schema.fields}
    columns = [f"coalesce({r.name}, {_zero(kinds[r.measure])}) AS {r.name}" if r.how == "sum" else r.name for r in rollings]
    return rows.selectExpr(*grid.columns, *columns)


def _range_join(grid: DataFrame, daily: DataFrame, rollings: list[Rolling]) -> DataFrame:
    kinds = {f.name: f.dataType for f in daily.schema.fields}
    back, ahead = reach(rollings)
    events = daily.withColumnsRenamed({ENTITY: "_entity"})
    near = F.col(EVENT_DATE).between(F.date_add(OBSERVED, back), F.date_add(OBSERVED, ahead))
    joined = grid.join(events, (F.col(ENTITY) == F.col("_entity")) & near, "left")
    return joined.groupBy(*grid.columns).agg(*_aggregates(rollings, f"datediff({EVENT_DATE}, {OBSERVED})", kinds))


def _spread(grid: DataFrame, daily: DataFrame, rollings: list[Rolling]) -> DataFrame:
    kinds = {f.name: f.dataType for f in daily.schema.fields}
    back, ahead = reach(rollings)
    if back is None:
        raise ValueError("the spread form needs windows with a lower bound")
    seen = (
        daily.withColumn("_lag", F.explode(F.sequence(F.lit(-ahead), F.lit(-back))))
        .withColumn(OBSERVED, F.date_add(EVENT_DATE, F.col("_lag")))
        .groupBy(*KEYS)
        .agg(*_aggregates(rollings, "-_lag", kinds))
    )
    filled = [
        f"coalesce({r.name}, {_zero(kinds[r.measure])}) AS {r.name}" if r.how == "sum" else r.name
        for r in rollings
    ]
    return grid.join(seen, KEYS, "left").selectExpr(*grid.columns, *filled)


_FORMS: dict[str, Callable[[DataFrame, DataFrame, list[Rolling]], DataFrame]] = {
    "frame": _frame,
    "join": _join,
    "spread": _spread,
}
