"""Data-quality expectations. They warn: rows are kept and violations are counted.

Tables are checked while they are written: the counts are observed in the rows on their way to the files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ENTITY, KEYS, LOG_TIMESTAMP, OBSERVED, schema_of
from tidemark.sources.tables import overwrite, replace_dates

# The expectation of each table, by name.
EXPECTATIONS: dict[str, dict[str, str]] = {
    "account": {"nonneg_account_age": "account_age_days IS NULL OR account_age_days >= 0"},
    "battle": {
        "valid_win_rate": "win_rate_7d IS NULL OR win_rate_7d BETWEEN 0.0 AND 1.0",
        "nonneg_duration": "avg_duration_7d IS NULL OR avg_duration_7d >= 0.0",
    },
    "progression": {
        "valid_level": "current_level >= 1",
        "nonneg_level_ups": "level_ups_7d >= 0 AND level_ups_30d >= 0",
        "consistent_levelup_windows": "level_ups_7d <= level_ups_30d",
    },
    "social": {"nonneg_event_counts": "messages_7d >= 0 AND invites_7d >= 0 AND gifts_7d >= 0"},
    "session": {
        "nonneg_sessions": "sessions_7d >= 0 AND sessions_ios_7d >= 0 AND sessions_android_7d >= 0",
        "nonneg_session_seconds": "avg_session_seconds_7d IS NULL OR avg_session_seconds_7d >= 0.0",
        "device_split_subset": "sessions_ios_7d + sessions_android_7d <= sessions_7d",
    },
    "spender_tier": {
        "valid_tier_value": "spender_tier IN ('whale', 'dolphin', 'minnow', 'non_spender')"
    },
    "purchase_velocity": {
        "nonneg_spend_total": "spend_7d_total IS NULL OR spend_7d_total >= 0.0",
        "velocity_in_range": "spend_velocity_7d_over_30d IS NULL"
        " OR spend_velocity_7d_over_30d BETWEEN 0.0 AND 1.0",
    },
    "purchase_enriched": {
        "nonneg_score": "enriched_spend_score IS NULL OR enriched_spend_score >= 0.0"
    },
}

KEY_CHECK = "keys_not_null"
UNIQUE_CHECK = "keys_unique"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("violations", T.LongType()),
    ]
)


def checks_of(table: str) -> dict[str, str]:
    """The table's expectations and the NOT NULL rule of its keys."""
    return {**EXPECTATIONS.get(table, {}), KEY_CHECK: " AND ".join(f"{k} IS NOT NULL" for k in KEYS)}


def _violations(predicate: str) -> F.Column:
    # A predicate that is NULL did not hold.
    return F.count_if(~F.coalesce(F.expr(predicate), F.lit(False)))


class Counted(NamedTuple):
    """Rows of a table that one check looked at, and how many of them it objects to."""

    table_name: str
    check_name: str
    row_count: int
    violations: int


def arranged(df: DataFrame, buckets: int = 1) -> tuple[DataFrame, F.Column]:
    """Rows brought together for a table laid out by observation date, and a flag for repeated keys.

    One exchange by date and bucket of accounts puts equal keys into one task, and adaptive execution may merge such
    tasks but not split them. The sort by date, bucket and account serves both the check, which
    compares neighbours, and the writer. ``buckets`` bounds a task by that share of the accounts on one date, since a
    table has a row per account and date; a hot account has no more rows than any other.
    """
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(ENTITY), F.lit(buckets))).repartition(OBSERVED, "_bucket")
    same_key = Window.partitionBy(OBSERVED, "_bucket", ENTITY).orderBy(ENTITY)
    return spread, F.row_number().over(same_key) > 1


def watch(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """Count violations while ``df`` is written or otherwise consumed, without a second pass.

    Read ``observation.get`` after the action: one count per check, and ``row_count``. See ``watch_keys`` for repeated keys.
    """
    observation = Observation(f"quality_{table}")
    metrics = [_violations(p).alias(name) for name, p in checks_of(table).items()]
    return df.observe(observation, F.count(F.lit(1)).alias("row_count"), *metrics), observation


def watch_keys(df: DataFrame, table: str, buckets: int = 1, also: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """``watch``, and rows that repeat a key.

    Rows come arranged for a table laid out by date. ``also`` names further tables whose columns the rows carry. Read
    ``counts(observation, table, also)`` after the action.
    """
    rows, repeated = arranged(df, buckets)
    observation = Observation()
    metrics = [F.count(F.lit(1)).alias("row_count"), F.count_if("_repeated").alias(f"{table}.{UNIQUE_CHECK}")]
    for name in (table, *also):
        metrics += [_violations(p).alias(f"{name}.{check}") for check, p in checks_of(name).items()]
    return rows.withColumn("_repeated", repeated).observe(observation, *metrics).drop("_bucket", "_repeated"), observation


def counts(observation: Observation, table: str, also: Sequence[str] = ()) -> list[Counted]:
    """The observed counts, a row per check. Tables that share the rows share the uniqueness of their keys."""
    got = observation.get
    got |= {f"{name}.{UNIQUE_CHECK}": got[f"{table}.{UNIQUE_CHECK}"] for name in also}
    checks = [(name, check) for name in (table, *also) for check in (*checks_of(name), UNIQUE_CHECK)]
    return [Counted(name, check, got["row_count"], got[f"{name}.{check}"]) for name, check in checks]


def write_checked(
    df: DataFrame, table: str, path: str, *, dates: Iterable[dt.date] | None = None, buckets: int = 1, also: Sequence[str] = ()
) -> list[Counted]:
    """Store ``df`` laid out by observation date and count what its checks object to, in one write.

    With ``dates`` only the rows on those dates are replaced. ``also`` names tables that are functions of the same row and
    not stored themselves: they are checked, and their further columns left out of the files.
    """
    extra = [c for c in df.columns if c not in _stored_columns(table)] if also else []
    if dates is None:
        rows, seen = watch_keys(df, table, buckets, also)
        overwrite(rows.drop(*extra), path, OBSERVED, arranged=True)
    else:
        days = sorted(set(dates))
        rows, seen = watch_keys(df.where(F.col(OBSERVED).isin(days)), table, buckets, also)
        replace_dates(rows.drop(*extra), path, OBSERVED, days, arranged=True)
    return counts(seen, table, also)


def _stored_columns(table: str) -> list[str]:
    return schema_of(table).fieldNames()


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and check. Each table is scanned once, for all its checks."""
    return reduce(DataFrame.unionAll, [_report(name, df) for name, df in tables.items()])


def _report(table: str, df: DataFrame) -> DataFrame:
    checks = checks_of(table)
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[_violations(p).alias(name) for name, p in checks.items()],
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in checks]
    )
    return counted.select(F.lit(table).alias("table_name"), "row_count", F.inline(pairs)).select(
        *REPORT_SCHEMA.fieldNames()
    )


def duplicate_keys(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def misdated_rows(logs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per log whose ``event_date`` is not the date of their timestamp.

    The windows go by ``event_date``; this is the source check that makes the two agree.
    """
    parts = []
    for name, ts in LOG_TIMESTAMP.items():
        if name in logs:
            wrong = ~F.col(ts).cast("date").eqNullSafe(F.col("event_date"))
            parts.append(
                logs[name].agg(
                    F.lit(name).alias("log"),
                    F.count(F.lit(1)).alias("row_count"),
                    F.count_if(wrong).alias("misdated"),
                )
            )
    return reduce(DataFrame.unionAll, parts)
