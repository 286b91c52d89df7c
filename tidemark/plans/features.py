"""The feature tables, each declared as daily measures, date windows and output columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import (
    CATEGORIES,
    ENTITY,
    EVENT_DATE,
    KEYS,
    OBSERVED,
    PAYLOAD_SCHEMA,
    SOCIAL_COLUMNS,
    SPEND_COLUMNS,
    SPEND_WINDOWS,
    TABLE_COLUMNS,
    conform,
    schema_of,
)
from tidemark.functions.columns import (
    ratio,
    spender_tier,
    tier_weight,
    total,
)
from tidemark.operators.grid import Axis, date_spine, observation_grid
from tidemark.operators.windows import (
    SAME_DATE,
    TO_DATE,
    Rolling,
    attach,
    back_to,
    daily_partials,
    exact_parts,
    last_dates,
    next_dates,
    reach,
    with_exact_parts,
)
from tidemark.sources.tables import Sources


@dataclass(frozen=True)
class WindowTable:
    """A table computed from one log by date windows.

    ``measures`` are daily aggregates of the log, ``rollings`` the windows over them, and
    ``columns`` the outputs in terms of the rolling columns, all as SQL text. Measures and
    columns may look at the log's schema: the type of money decides how it is summed.
    """

    name: str
    log: str
    measures: Callable[[T.StructType], Mapping[str, str]]
    rollings: Sequence[Rolling]
    columns: Callable[[T.StructType], Mapping[str, str]]
    prepare: Callable[[DataFrame], DataFrame] = lambda log: log
    date: str = EVENT_DATE
    #: Measures of all history in terms of the table's own columns, for tables that can carry their state.
    state: Mapping[str, str] = field(default_factory=dict)


def _weekly(*measures: str) -> list[Rolling]:
    """Each measure over the observation date and the seven dates before it."""
    return [Rolling(m, m, back_to(7)) for m in measures]


def _mean(total: str, count: str) -> str:
    """Average of an integer column as a double, NULL when nothing was counted."""
    return f"CASE WHEN {count} > 0 THEN CAST({total} AS DOUBLE) / {count} END"


# --- battle -----------------------------------------------------------------------------

BATTLE = WindowTable(
    "battle",
    "battle",
    lambda _: {
        "battle_n": "count(won)",
        "battle_won": "sum(won)",
        "battle_timed": "count(duration_seconds)",
        "battle_seconds": "sum(duration_seconds)",
    },
    _weekly("battle_n", "battle_won", "battle_timed", "battle_seconds"),
    lambda _: {
        "battles_7d": "battle_n",
        "win_rate_7d": _mean("battle_won", "battle_n"),
        "avg_duration_7d": _mean("battle_seconds", "battle_timed"),
    },
)


# --- purchase ---------------------------------------------------------------------------


def money_scale(kind: T.DataType) -> int | None:
    """Decimal places of an amount column that can be summed exactly in BIGINT minor units.

    None for doubles and for decimals too wide for a BIGINT, which are summed in their own type.
    """
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return kind.scale
    return 0 if isinstance(kind, T.IntegralType) else None


def is_exact(purchase: DataFrame) -> bool:
    """Whether a stored purchase table records the decimal places of its sums, so that sums of them stay exact."""
    return all(purchase.schema[c].metadata.get("money_scale") is not None for c in SPEND_COLUMNS)


def _is_double(schema: T.StructType) -> bool:
    return isinstance(schema["amount_usd"].dataType, T.DoubleType)


def priced_purchases(log: DataFrame) -> DataFrame:
    """Purchases with a time. Amounts in doubles come with the parts that sum exactly."""
    rows = log.where("purchase_ts IS NOT NULL")
    return with_exact_parts(rows, "amount_usd") if _is_double(log.schema) else rows


def _purchase_measures(schema: T.StructType) -> dict[str, str]:
    scale = money_scale(schema["amount_usd"].dataType)
    amount = f"CAST(amount_usd * {10**scale} AS BIGINT)" if scale else "amount_usd"
    known = ", ".join(f"'{c}'" for c in CATEGORIES)
    if _is_double(schema):
        conditions = {f"spent_{c}": f"category = '{c}'" for c in CATEGORIES}
        conditions |= {"spent_known": f"category IN ({known})", "spent_all": None}
        parts = [exact_parts(name, "amount_usd", c) for name, c in conditions.items()]
        return {n: text for p in parts for n, text in p.items()} | {"purchase_n": "count(1)"}
    return {
        **{f"spent_{c}": f"sum(CASE WHEN category = '{c}' THEN {amount} END)" for c in CATEGORIES},
        "spent_known": f"sum(CASE WHEN category IN ({known}) THEN {amount} END)",
        "spent_all": f"sum({amount})",
        "purchase_n": "count(1)",
    }


# The week's spend over the known categories is no column of the purchase table itself; the
# velocity takes it from here, where it is still exact.
PURCHASE_ROLLINGS = [
    *[Rolling(f"spend_{c}_{w}d", f"spent_{c}", last_dates(w)) for c in CATEGORIES for w in SPEND_WINDOWS],
    Rolling("purchases_count_7d", "purchase_n", last_dates(7)),
    Rolling("purchases_amount_sum_30d", "spent_all", last_dates(30)),
    Rolling("purchases_amount_sum_90d", "spent_all", last_dates(90)),
    Rolling("spend_7d_total", "spent_known", last_dates(7)),
]


def _purchase_columns(schema: T.StructType) -> dict[str, str]:
    scale = money_scale(schema["amount_usd"].dataType)

    def dollars(name: str) -> str:
        value = f"CAST({name} AS DOUBLE)"
        return f"{value} / {10**scale}D" if scale else value

    return {
        r.name: r.name if r.measure == "purchase_n" else dollars(r.name) for r in PURCHASE_ROLLINGS
    }


PURCHASE = WindowTable(
    "purchase",
    "purchase",
    _purchase_measures,
    PURCHASE_ROLLINGS,
    _purchase_columns,
    prepare=priced_purchases,
)


# --- progression ------------------------------------------------------------------------

PROGRESSION = WindowTable(
    "progression",
    "progression",
    lambda _: {"level_ups": "count(level_up_ts)", "level_top": "max(new_level)"},
    [
        Rolling("level_ups_7d", "level_ups", last_dates(7)),
        Rolling("level_ups_30d", "level_ups", last_dates(30)),
        Rolling("level_top", "level_top", TO_DATE, "max"),
    ],
    lambda _: {
        "level_ups_7d": "level_ups_7d",
        "level_ups_30d": "level_ups_30d",
        "current_level": "coalesce(level_top, 1)",
    },
    state={"level_top": "current_level"},
)


# --- social and membership --------------------------------------------------------------

SOCIAL = WindowTable(
    "social",
    "social",
    lambda _: {f"social_{kind}": f"count_if(event_type = '{kind}')" for kind in SOCIAL_COLUMNS},
    _weekly(*[f"social_{kind}" for kind in SOCIAL_COLUMNS]),
    lambda _: {column: f"social_{kind}" for kind, column in SOCIAL_COLUMNS.items()},
)

# The snapshot of one date as a same-date window. It equals the snapshot join as long as the
# snapshot has one row per account and date, and costs no shuffle of the grid.
MEMBERSHIP = WindowTable(
    "social_enriched",
    "membership",
    lambda _: {"member_rows": "count_if(is_clan_member)"},
    [Rolling("member_rows", "member_rows", SAME_DATE)],
    lambda _: {"is_clan_member": "member_rows > 0"},
    date="date",
)


# --- session ----------------------------------------------------------------------------


def parse_sessions(log: DataFrame) -> DataFrame:
    """Typed fields of the JSON payload. Malformed text yields NULL fields, never an error."""
    payload = F.from_json("payload_json", PAYLOAD_SCHEMA)
    return log.withColumn("payload", payload).select(
        ENTITY, EVENT_DATE, F.col("payload.duration_s"), F.col("payload.device")
    )


SESSION = WindowTable(
    "session",
    "session",
    lambda _: {
        "session_n": "count(duration_s)",
        "session_seconds": "sum(duration_s)",
        "session_ios": "count_if(device = 'ios')",
        "session_android": "count_if(device = 'android')",
    },
    _weekly("session_n", "session_seconds", "session_ios", "session_android"),
    lambda _: {
        "sessions_7d": "session_n",
        "avg_session_seconds_7d": _mean("session_seconds", "session_n"),
        "sessions_ios_7d": "session_ios",
        "sessions_android_7d": "session_android",
    },
    prepare=parse_sessions,
)


# --- label ------------------------------------------------------------------------------

LABEL_DAYS = 7
LABEL = WindowTable(
    "label_login_7d",
    "login",
    lambda _: {"login_n": "count(login_ts)"},
    [Rolling("login_ahead", "login_n", next_dates(LABEL_DAYS))],
    lambda _: {"did_login_within_7d": "login_ahead > 0"},
)

WINDOW_TABLES = {t.name: t for t in (BATTLE, PURCHASE, PROGRESSION, SOCIAL, MEMBERSHIP, SESSION, LABEL)}


# --- building ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Carry:
    """State to start from instead of all history: a table's own rows on an earlier observation date.

    ``state`` has the table's rows of ``date``, which must reflect every event up to that date.
    """

    date: dt.date
    state: DataFrame


def daily_of(table: WindowTable, sources: Sources, axis: Axis, carry: Carry | None = None) -> DataFrame:
    """Daily partials of a table's log, restricted to what the axis can see.

    When an all-history window meets a bounded axis, everything older than the bounded windows
    is folded into one earlier date, so each account contributes one row for its whole past. With
    ``carry`` that past is taken from the stored state, and only the dates since then are read.
    """
    source = sources[table.log]
    measures = table.measures(source.schema)
    back, ahead = reach(table.rollings)
    log = axis.events(source, table.date, (back, ahead))
    if back is not None or not axis.bounded or axis.days == ():
        return daily_partials(table.prepare(log), measures, table.date)
    oldest = min((r.span.first for r in table.rollings if r.span.first is not None), default=0)
    if carry is None:
        floor = F.date_add(axis.first, min(oldest, 0) - 1)
        log = log.withColumn(table.date, F.greatest(F.col(table.date), floor))
        return daily_partials(table.prepare(log), measures, table.date)
    # Everything up to the carried date is in the state; the bounded windows may reach further back.
    since = min(carry.date + dt.timedelta(days=1), axis.days[0] + dt.timedelta(days=oldest))
    recent = log.where(F.col(table.date) >= F.lit(since))
    daily = daily_partials(table.prepare(recent), measures, table.date)
    late = sources["account"].where((F.col("created_at") > F.lit(carry.date)) & (F.col("created_at") <= F.lit(axis.days[-1])))
    if not late.isEmpty():
        # Accounts that were not observed yet have no state; what they did before is read for them alone.
        older = log.where(F.col(table.date) < F.lit(since)).join(late.select(ENTITY).distinct(), ENTITY, "left_semi")
        older = older.select(*log.columns).withColumn(table.date, F.lit(since - dt.timedelta(days=1)))
        daily = daily.unionByName(daily_partials(table.prepare(older), measures, table.date))
    state = carry.state.selectExpr(
        ENTITY, f"DATE'{since - dt.timedelta(days=1)}' AS {EVENT_DATE}", *[f"{v} AS {m}" for m, v in table.state.items()]
    )
    return daily.unionByName(state, allowMissingColumns=True)


def rolled(table: WindowTable, sources: Sources, axis: Axis, form: str = "frame", carry: Carry | None = None) -> DataFrame:
    """The grid with a table's output columns, including those outside its contract."""
    grid = observation_grid(sources["account"], axis.spine, colocate=True)
    rows = attach(grid, daily_of(table, sources, axis, carry), table.rollings, form)
    columns = table.columns(sources[table.log].schema)
    return rows.selectExpr(*KEYS, *[f"{c} AS {n}" for n, c in columns.items()])


def window_table(
    table: WindowTable, sources: Sources, axis: Axis, form: str = "frame", carry: Carry | None = None
) -> DataFrame:
    """Build one window table over the axis. ``form`` is one of the window forms."""
    rows = rolled(table, sources, axis, form, carry)
    if table is not PURCHASE:
        return conform(rows, table.name)
    return conform(rows, table.name, money_scale(sources[table.log].schema["amount_usd"].dataType))


def account_columns() -> dict[str, str]:
    return {
        "account_age_days": f"datediff({OBSERVED}, created_at)",
        "country": "country",
        "install_source": "install_source",
    }


ACCOUNT_ATTRIBUTES = ("created_at", "country", "install_source")


def account_features(sources: Sources, axis: Axis) -> DataFrame:
    """Age and attributes. Nothing is shuffled: the grid expansion runs where accounts are read."""
    grid = observation_grid(sources["account"], axis.spine, keep=ACCOUNT_ATTRIBUTES)
    return conform(grid.selectExpr(*KEYS, *[f"{c} AS {n}" for n, c in account_columns().items()]), "account")


def clan_features(sources: Sources, axis: Axis) -> DataFrame:
    """Snapshot membership of exactly the observation date, FALSE where there is no row."""
    grid = observation_grid(sources["account"], axis.spine)
    snapshot = axis.events(sources["membership"], "date", (0, 0)).select(
        ENTITY, F.col("date").alias(OBSERVED), "is_clan_member"
    )
    joined = grid.join(snapshot, KEYS, "left").withColumn(
        "is_clan_member", F.coalesce("is_clan_member", F.lit(False))
    )
    return conform(joined, "social_enriched")


def tier_columns() -> dict[str, Column]:
    return {"spender_tier": spender_tier(F.col("purchases_amount_sum_30d"))}


def velocity_columns(schema: T.StructType) -> dict[str, Column]:
    """Seven-date spend over the known categories and its share of the 30-date total.

    From stored columns with a recorded money scale the five are summed as decimals: a sum of
    doubles can come out one digit above the total and turn a share of 1 into a false range
    violation.
    """
    if "spend_7d_total" in schema.names:
        return _velocity(F.col("spend_7d_total"))
    weekly = [f"spend_{c}_7d" for c in CATEGORIES]
    scales = {schema[c].metadata.get("money_scale") for c in weekly}
    if None in scales:
        week = total([F.col(c) for c in weekly])
    else:
        exact = f"decimal(28,{max(scales)})"
        week = total([F.col(c).cast(exact) for c in weekly]).cast("double")
    return _velocity(week)


def _velocity(week: Column) -> dict[str, Column]:
    return {
        "spend_7d_total": week,
        "spend_velocity_7d_over_30d": ratio(week, F.col("purchases_amount_sum_30d")),
    }


def enriched_columns(schema: T.StructType) -> dict[str, Column]:
    """Tier flag, velocity flag and score from the purchase columns of the same row."""
    tier = tier_columns()["spender_tier"]
    velocity = F.coalesce(velocity_columns(schema)["spend_velocity_7d_over_30d"], F.lit(0.0))
    return flag_columns(tier, velocity)


def flag_columns(tier: Column, velocity: Column) -> dict[str, Column]:
    return {
        "is_whale": tier == "whale",
        "is_high_velocity": velocity > 0.5,
        "enriched_spend_score": tier_weight(tier) * velocity * F.col("purchases_amount_sum_30d"),
    }


def _derive(purchase: DataFrame, table: str, columns: Mapping[str, Column]) -> DataFrame:
    return conform(purchase.select(*KEYS, *[c.alias(n) for n, c in columns.items()]), table)


def spender_tiers(purchase: DataFrame) -> DataFrame:
    return _derive(purchase, "spender_tier", tier_columns())


def purchase_velocity(purchase: DataFrame) -> DataFrame:
    return _derive(purchase, "purchase_velocity", velocity_columns(purchase.schema))


def purchase_enriched(purchase: DataFrame) -> DataFrame:
    """Tier and velocity are functions of the same purchase row, so no join is needed here."""
    return _derive(purchase, "purchase_enriched", enriched_columns(purchase.schema))


def fan_in(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Left join derived tables onto ``base`` by both keys."""
    for other in others:
        base = base.join(other, KEYS, "left")
    return base


def full_axis(sources: Sources) -> Axis:
    return Axis(date_spine(sources["login"]))


def build_table(sources: Sources, name: str, axis: Axis | None = None, carry: Carry | None = None) -> DataFrame:
    """Any feature or label table by name, over the whole spine unless an axis is given.

    ``carry`` lets a slice of a table with all-history columns start from its stored state.
    """
    if name not in TABLE_COLUMNS:
        raise KeyError(f"unknown table {name!r}; known tables: {sorted(TABLE_COLUMNS)}")
    if axis is None:
        axis = full_axis(sources)
        if name == "label_login_7d":
            from tidemark.plans.labels import label_axis

            axis = label_axis(sources)
    if name == "account":
        return account_features(sources, axis)
    if name == "social_enriched":
        return clan_features(sources, axis)
    if name in DERIVED:
        return DERIVED[name](rolled(PURCHASE, sources, axis))
    return window_table(WINDOW_TABLES[name], sources, axis, carry=carry)


def enriched_with_parts(sources: Sources, axis: Axis | None = None, purchase: DataFrame | None = None) -> DataFrame:
    """The enriched purchase table with the tier and velocity columns it is made of, for checks on all three.

    ``purchase`` is the stored purchase table, if it is current and its sums are exact (see ``is_exact``).
    """
    if purchase is None:
        purchase = rolled(PURCHASE, sources, axis or full_axis(sources))
    parts = purchase.withColumns({**tier_columns(), **velocity_columns(purchase.schema)})
    flags = flag_columns(F.col("spender_tier"), F.coalesce("spend_velocity_7d_over_30d", F.lit(0.0)))
    columns = {f.name: f.dataType for t in ("purchase_enriched", "spender_tier", "purchase_velocity") for f in schema_of(t)}
    return parts.withColumns(flags).select(*[F.col(n).cast(kind) for n, kind in columns.items()])


# Tables that are projections of the purchase table, with the windows their columns look at.
DERIVED = {
    "spender_tier": spender_tiers,
    "purchase_velocity": purchase_velocity,
    "purchase_enriched": purchase_enriched,
}
DERIVED_REACH = (1 - 30, 0)
