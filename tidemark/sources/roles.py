"""The benchmark tables seen as the eight source tables.

Every event type of ``events`` plays one log, ``customer`` and ``nation`` play the account
dimension. Creation dates are spread over the first twenty days so that accounts enter the grid
gradually.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import CATEGORIES
from tidemark.functions.columns import json_payload
from tidemark.operators.sequence import running_level
from tidemark.sources.tables import Sources


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _key() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def _log(events: DataFrame, kind: str | None, ts: str, *columns) -> DataFrame:
    rows = events if kind is None else events.where(F.col("event_type") == kind)
    return rows.select(
        F.col("user_id").alias("account_id"),
        F.col("ts").alias(ts),
        *columns,
        F.col("ts").cast("date").alias("event_date"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    # nation is a fixed list of 25 rows; Spark broadcasts it by its own size check.
    return customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_custkey").alias("account_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 20).cast("int")).alias("created_at"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("install_source"),
    )


def login(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(_events(spark, sf_dir), "view", "login_ts")


def battle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(
        _events(spark, sf_dir),
        "click",
        "battle_ts",
        (_key() % 2).cast("int").alias("won"),
        F.floor("value").cast("int").alias("duration_seconds"),
    )


def purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.get(F.array(*[F.lit(c) for c in CATEGORIES]), _key() % len(CATEGORIES))
    return _log(
        _events(spark, sf_dir),
        "purchase",
        "purchase_ts",
        category.alias("category"),
        F.col("value").cast("decimal(18,2)").alias("amount_usd"),
    )


def level_ups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level-up log without its level, as it arrives before numbering."""
    return _log(_events(spark, sf_dir), "signup", "level_up_ts")


def progression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_level(level_ups(spark, sf_dir))


def social(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(F.lit("message"), F.lit("invite"), F.lit("gift"))
    return _log(_events(spark, sf_dir), "error", "event_ts", F.get(kinds, _key() % 3).alias("event_type"))


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = json_payload(
        duration_s=_key(),
        device=F.when(_key() % 2 == 0, F.lit("ios")).otherwise(F.lit("android")),
        level_reached=F.lit(1),
    )
    return _log(_events(spark, sf_dir), None, "session_ts", payload.alias("payload_json"))


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse on purpose: an account has a snapshot row only on its login dates."""
    days = login(spark, sf_dir).select("account_id", F.col("event_date").alias("date")).distinct()
    return days.withColumn("is_clan_member", F.col("account_id") % 3 == 0)


def role_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        {
            "account": accounts(spark, sf_dir),
            "login": login(spark, sf_dir),
            "battle": battle(spark, sf_dir),
            "purchase": purchase(spark, sf_dir),
            "progression": progression(spark, sf_dir),
            "social": social(spark, sf_dir),
            "session": session(spark, sf_dir),
            "membership": membership(spark, sf_dir),
        }
    )
