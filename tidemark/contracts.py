"""Column contracts of the stored tables: names, order, types and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = "account_id"
OBSERVED = "observation_date"
EVENT_DATE = "event_date"
KEYS = [ENTITY, OBSERVED]

# Product categories, spend windows, social event types, tiers and
# their weights, exactly as stored in the tables.
CATEGORIES = ["gems", "cards", "chest", "pass", "cosmetic"]
SPEND_WINDOWS = [3, 7, 14, 30, 60, 90]
SOCIAL_COLUMNS = {"message": "messages_7d", "invite": "invites_7d", "gift": "gifts_7d"}
TIER_FLOORS = {"whale": 100.0, "dolphin": 20.0}
TIER_WEIGHTS = {"whale": 3.0, "dolphin": 2.0, "minnow": 1.0}
PAYLOAD_SCHEMA = "duration_s INT, device STRING, level_reached INT"

# Columns and types of the source tables.
SOURCE_COLUMNS = {
    "account": "account_id BIGINT, created_at DATE, country STRING, install_source STRING",
    "login": "account_id BIGINT, login_ts TIMESTAMP, event_date DATE",
    "battle": "account_id BIGINT, battle_ts TIMESTAMP, won INT, duration_seconds INT, event_date DATE",
    "purchase": "account_id BIGINT, purchase_ts TIMESTAMP, category STRING, amount_usd DOUBLE, event_date DATE",
    "progression": "account_id BIGINT, level_up_ts TIMESTAMP, event_date DATE, new_level INT",
    "social": "account_id BIGINT, event_ts TIMESTAMP, event_type STRING, event_date DATE",
    "session": "account_id BIGINT, session_ts TIMESTAMP, payload_json STRING, event_date DATE",
    "membership": "account_id BIGINT, date DATE, is_clan_member BOOLEAN",
}

# The names these source tables have in a catalog schema.
CATALOG_NAMES = {
    "account": "src_dim_account",
    "login": "src_events_login",
    "battle": "src_events_battle",
    "purchase": "src_events_purchase",
    "progression": "src_events_progression",
    "social": "src_events_social",
    "session": "src_events_session",
    "membership": "src_clan_membership_daily",
}

# The timestamp column of every event log, and the date column each source is laid out by.
LOG_TIMESTAMP = {
    "login": "login_ts",
    "battle": "battle_ts",
    "purchase": "purchase_ts",
    "progression": "level_up_ts",
    "social": "event_ts",
    "session": "session_ts",
}
SOURCE_DATE = {**dict.fromkeys(LOG_TIMESTAMP, EVENT_DATE), "membership": "date"}

SPEND_COLUMNS = [f"spend_{c}_{w}d" for c in CATEGORIES for w in SPEND_WINDOWS]

# Feature columns (after the two keys) of every table, in stored order.
TABLE_COLUMNS = {
    "account": "account_age_days INT, country STRING, install_source STRING",
    "battle": "battles_7d BIGINT, win_rate_7d DOUBLE, avg_duration_7d DOUBLE",
    "purchase": ", ".join(f"{c} DOUBLE" for c in SPEND_COLUMNS)
    + ", purchases_count_7d BIGINT, purchases_amount_sum_30d DOUBLE, purchases_amount_sum_90d DOUBLE",
    "progression": "level_ups_7d BIGINT, level_ups_30d BIGINT, current_level INT",
    "social": "messages_7d BIGINT, invites_7d BIGINT, gifts_7d BIGINT",
    "social_enriched": "is_clan_member BOOLEAN",
    "session": "sessions_7d BIGINT, avg_session_seconds_7d DOUBLE, "
    "sessions_ios_7d BIGINT, sessions_android_7d BIGINT",
    "purchase_enriched": "is_whale BOOLEAN, is_high_velocity BOOLEAN, enriched_spend_score DOUBLE",
    "spender_tier": "spender_tier STRING",
    "purchase_velocity": "spend_7d_total DOUBLE, spend_velocity_7d_over_30d DOUBLE",
    "label_login_7d": "did_login_within_7d BOOLEAN",
}

TABLE_COMMENTS = {
    "account": "Account age and attributes on each observation date.",
    "battle": "Battles of the observation date and the seven dates before it.",
    "purchase": "Spend by category and window, purchase count and totals.",
    "progression": "Level-ups in the last 7 and 30 dates and the level reached.",
    "social": "Social events of the observation date and the seven dates before it.",
    "social_enriched": "Clan membership on the observation date.",
    "session": "Sessions of the observation date and the seven dates before it.",
    "purchase_enriched": "Tier, velocity and score derived from the spend columns.",
    "spender_tier": "Band of the 30-date spend.",
    "purchase_velocity": "Share of the 30-date spend made in the last 7 dates.",
    "label_login_7d": "Whether the account logs in on one of the next seven dates.",
}

# The tables whose columns are offered as features; the others are intermediates or labels.
FEATURE_TABLES = [
    "account",
    "battle",
    "purchase",
    "progression",
    "social",
    "social_enriched",
    "session",
    "purchase_enriched",
]


def column_comment(table: str, column: str) -> str:
    """What a column of a feature table is, for catalogs."""
    if column == ENTITY:
        return "Account; part of the key."
    if column == OBSERVED:
        return "Date as of which the row holds; part of the key."
    days = column.rsplit("_", 1)[-1]
    return f"{TABLE_COMMENTS[table][:-1]}: {column.replace('_', ' ')}" + (f" (window of {days[:-1]} days)" if days[:-1].isdigit() else "")


def required(df: DataFrame) -> DataFrame:
    """``df`` with its keys declared NOT NULL by raising an error on a row that lacks one."""
    told = {
        k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"{k} is missing in a row that is being stored"))).otherwise(F.col(k))
        for k in KEYS
    }
    return df.withColumns(told)


def schema_of(table: str) -> T.StructType:
    """Declared schema of a feature table: both keys NOT NULL, then its columns."""
    keys = [T.StructField(ENTITY, T.LongType(), False), T.StructField(OBSERVED, T.DateType(), False)]
    return T.StructType(keys + T.StructType.fromDDL(TABLE_COLUMNS[table]).fields)


def conform(df: DataFrame, table: str, money_scale: int | None = None) -> DataFrame:
    """Select, order and cast the columns of ``df`` to the contract of ``table``.

    Spark cannot promise NOT NULL for a computed column: a store counts missing keys, or refuses
    them (``required``). ``money_scale`` records the decimal places of exactly summed spend columns
    in their metadata, which parquet keeps, so later sums of them can stay exact.
    """
    fields = []
    for f in schema_of(table).fields:
        money = money_scale is not None and isinstance(f.dataType, T.DoubleType)
        fields.append(T.StructField(f.name, f.dataType, True, {"money_scale": money_scale} if money else None))
    return df.to(T.StructType(fields))
