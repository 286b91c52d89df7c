"""Queries over the benchmark tables, one per operator or table."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import (
    CATEGORIES,
    ENTITY,
    EVENT_DATE,
    KEYS,
    LOG_TIMESTAMP,
    OBSERVED,
    SOURCE_DATE,
    SPEND_COLUMNS,
    TABLE_COLUMNS,
    conform,
    schema_of,
)
from tidemark.functions import columns as C
from tidemark.maintain import (
    FeatureStore,
    append_batch,
    carry_forward_snapshot,
    date_bounds,
    next_batch_date,
    restate_dates,
    restatement_dates,
    rows_by_table_and_date,
    shared_folder,
    with_appended,
    with_restated,
)
from tidemark.operators.asof import point_in_time
from tidemark.operators.grid import (
    Axis,
    date_spine,
    grid_for_dates,
    interval_to_daily,
    latest,
    observable,
    observation_grid,
)
from tidemark.operators.joins import range_join, snapshot_join
from tidemark.operators.sequence import (
    attach_state,
    continue_level,
    expand_rows,
    latest_per_key,
    max_per_key,
    running_level,
    running_number,
)
from tidemark.operators.windows import TO_DATE, back_to, daily_partials, last_dates, next_dates
from tidemark.plans.datasets import (
    feature_tables,
    prediction_set,
    prediction_set_from_logs,
    training_set,
    training_set_from_logs,
    wide_features,
)
from tidemark.plans.features import (
    BATTLE,
    LABEL,
    PROGRESSION,
    SESSION,
    SOCIAL,
    Carry,
    build_table,
    fan_in,
    full_axis,
    parse_sessions,
    purchase_velocity,
    spender_tiers,
    window_table,
)
from tidemark.plans.labels import eligibility_prediction, label_axis
from tidemark.quality import REPORT_SCHEMA, duplicate_keys, misdated_rows, quality_report, write_checked
from tidemark.sources import roles
from tidemark.sources.roles import role_sources
from tidemark.sources.tables import append, clear_dates, overwrite, read_table, save_dataset

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# --- feature tables ---------------------------------------------------------------------


@query("date_spine")
def date_spine_table(spark, sf_dir):
    return date_spine(roles.login(spark, sf_dir))


@query("date_spine_observable")
def date_spine_observable(spark, sf_dir):
    return observable(date_spine(roles.login(spark, sf_dir)), 7)


QUERIES["observable_spine"] = QUERIES["date_spine_observable"]


def _table_query(name: str) -> Query:
    return lambda spark, sf_dir: build_table(role_sources(spark, sf_dir), name)


FEATURE_QUERIES = {
    "feat_account": "account",
    "feat_battle": "battle",
    "feat_purchase": "purchase",
    "feat_progression": "progression",
    "feat_social": "social",
    "feat_social_enriched": "social_enriched",
    "feat_session": "session",
    "spender_tier": "spender_tier",
    "purchase_velocity": "purchase_velocity",
    "feat_purchase_enriched": "purchase_enriched",
    "label_login_7d": "label_login_7d",
}
QUERIES.update({key: _table_query(name) for key, name in FEATURE_QUERIES.items()})


@query("eligibility_prediction")
def eligibility_prediction_table(spark, sf_dir):
    return eligibility_prediction(role_sources(spark, sf_dir))


@query("training_set")
def training_set_table(spark, sf_dir):
    return training_set_from_logs(role_sources(spark, sf_dir))


@query("prediction_set")
def prediction_set_table(spark, sf_dir):
    return prediction_set_from_logs(role_sources(spark, sf_dir))


@query("training_set_point_in_time")
def training_set_point_in_time(spark, sf_dir):
    sources = role_sources(spark, sf_dir)
    return training_set(sources, feature_tables(sources))


@query("prediction_set_point_in_time")
def prediction_set_point_in_time(spark, sf_dir):
    sources = role_sources(spark, sf_dir)
    return prediction_set(sources, feature_tables(sources))


@query("all_features")
def all_features(spark, sf_dir):
    """All 53 features in one pass."""
    sources = role_sources(spark, sf_dir)
    tables = ["account", "battle", "purchase", "progression", "social", "social_enriched", "session",
              "purchase_enriched"]
    names = [c.split()[0] for t in tables for c in TABLE_COLUMNS[t].split(", ")]
    return wide_features(sources, names, full_axis(sources))


# --- joins ------------------------------------------------------------------------------


def _grid(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    spine = date_spine(roles.login(spark, sf_dir))
    return observation_grid(roles.accounts(spark, sf_dir), spine), spine


@query("observation_grid")
def observation_grid_rows(spark, sf_dir):
    return _grid(spark, sf_dir)[0]


@query("trailing_range_join")
def trailing_range_join(spark, sf_dir):
    log = roles.battle(spark, sf_dir).select(ENTITY, EVENT_DATE, "won", "duration_seconds")
    return range_join(*_grid(spark, sf_dir), log, back_to(7))


@query("trailing_range_join_90d")
def trailing_range_join_90d(spark, sf_dir):
    log = roles.purchase(spark, sf_dir).select(
        ENTITY, EVENT_DATE, "category", F.col("amount_usd").cast("double").alias("amount_usd")
    )
    joined = range_join(*_grid(spark, sf_dir), log, back_to(90))
    return joined.withColumn("days_back", C.days_between(F.col(OBSERVED), F.col(EVENT_DATE)))


@query("history_to_date_join")
def history_to_date_join(spark, sf_dir):
    log = roles.progression(spark, sf_dir).select(ENTITY, EVENT_DATE, "new_level")
    return range_join(*_grid(spark, sf_dir), log, TO_DATE)


@query("forward_range_join")
def forward_range_join(spark, sf_dir):
    login = roles.login(spark, sf_dir)
    spine = observable(date_spine(login), 7)
    grid = observation_grid(roles.accounts(spark, sf_dir), spine)
    return range_join(grid, spine, login.select(ENTITY, EVENT_DATE), next_dates(7))


@query("range_only_join")
def range_only_join(spark, sf_dir):
    login = roles.login(spark, sf_dir).select(ENTITY, EVENT_DATE)
    newest = latest(login, EVENT_DATE)
    recent = login.where(F.col(EVENT_DATE).between(F.date_sub(newest, 30), newest))
    return recent.withColumn(OBSERVED, newest)


@query("fan_in_join")
def fan_in_join(spark, sf_dir):
    purchase = build_table(role_sources(spark, sf_dir), "purchase")
    base = purchase.select(*KEYS, "purchases_amount_sum_30d")
    return fan_in(base, spender_tiers(purchase), purchase_velocity(purchase))


@query("snapshot_join")
def snapshot_join_rows(spark, sf_dir):
    return snapshot_join(_grid(spark, sf_dir)[0], roles.membership(spark, sf_dir))


@query("point_in_time_join")
def point_in_time_join(spark, sf_dir):
    """Labels with the battle totals of the latest active day at or before each date."""
    active = daily_partials(
        roles.battle(spark, sf_dir),
        {
            "battles": "count(won)",
            "wins": "sum(won)",
            # NULL on many active days: the newest row must win even where its value is NULL.
            "long_battles": "sum(CASE WHEN duration_seconds >= 60 THEN 1 END)",
        },
    ).withColumnRenamed(EVENT_DATE, OBSERVED)
    labels = build_table(role_sources(spark, sf_dir), "label_login_7d")
    wanted = {"battle": (active, ["battles", "wins", "long_battles"])}
    return point_in_time(labels, wanted, unique_spine=True)


@query("point_in_time_join_repeated_spine")
def point_in_time_join_repeated_spine(spark, sf_dir):
    """One row per battle, so keys repeat, with the latest spend at most five days old."""
    spend = daily_partials(
        roles.purchase(spark, sf_dir), {"spent": "CAST(sum(amount_usd) AS DOUBLE)"}
    ).withColumnRenamed(EVENT_DATE, OBSERVED)
    battles = roles.battle(spark, sf_dir).select(ENTITY, F.col(EVENT_DATE).alias(OBSERVED), "battle_ts")
    return point_in_time(battles, {"spend": (spend, ["spent"])}, max_age_days=5)


@query("attach_last_state")
def attach_last_state(spark, sf_dir):
    levels = max_per_key(roles.progression(spark, sf_dir), ENTITY, "new_level", "max_level")
    return attach_state(roles.accounts(spark, sf_dir).select(ENTITY), levels, ENTITY, "max_level", 1)


@query("grid_for_dates")
def grid_for_given_dates(spark, sf_dir):
    login = roles.login(spark, sf_dir)
    return grid_for_dates(roles.accounts(spark, sf_dir), restatement_dates(login))


def _active_interval(spark, sf_dir) -> DataFrame:
    """Accounts with the date of their last battle, after which they count as gone."""
    ends = max_per_key(roles.battle(spark, sf_dir), ENTITY, EVENT_DATE, "end_date")
    return roles.accounts(spark, sf_dir).join(ends, ENTITY, "left")


@query("grid_in_interval")
def grid_in_interval(spark, sf_dir):
    spine = date_spine(roles.login(spark, sf_dir))
    return observation_grid(_active_interval(spark, sf_dir), spine, until="end_date")


# --- aggregations -----------------------------------------------------------------------


@query("distinct_dates")
def distinct_dates(spark, sf_dir):
    return roles.battle(spark, sf_dir).select(EVENT_DATE).distinct()


@query("distinct_rows")
def distinct_rows(spark, sf_dir):
    return roles.login(spark, sf_dir).select(ENTITY, EVENT_DATE).distinct()


@query("global_minmax")
def global_minmax(spark, sf_dir):
    return date_bounds(roles.login(spark, sf_dir), "login_ts")


def _form(table, form: str, *columns: str, axis=full_axis) -> Query:
    def run(spark, sf_dir):
        sources = role_sources(spark, sf_dir)
        return window_table(table, sources, axis(sources), form).select(*KEYS, *columns)

    return run


# The same tables through the other two window forms.
QUERIES["count_nonnull"] = _form(BATTLE, "join", "battles_7d")
QUERIES["avg_as_double"] = _form(BATTLE, "spread", "win_rate_7d", "avg_duration_7d")
QUERIES["conditional_count"] = _form(SOCIAL, "spread", "messages_7d", "invites_7d", "gifts_7d")
QUERIES["session_counts_by_join"] = _form(SESSION, "join", *[
    c.split()[0] for c in TABLE_COLUMNS["session"].split(", ")
])
QUERIES["max_with_default"] = _form(PROGRESSION, "join", "level_ups_7d", "level_ups_30d", "current_level")
QUERIES["any_in_window"] = _form(LABEL, "spread", "did_login_within_7d", axis=label_axis)


@query("spend_pivot")
def spend_pivot(spark, sf_dir):
    return build_table(role_sources(spark, sf_dir), "purchase").select(*KEYS, *SPEND_COLUMNS)


@query("spend_in_doubles")
def spend_in_doubles(spark, sf_dir):
    """The purchase table from amounts in doubles, as the declared source has them (here whole quarters)."""
    sources = role_sources(spark, sf_dir)
    amount = F.floor(F.col("amount_usd") * 4).cast("double") / 4
    return build_table(sources.replace(purchase=sources["purchase"].withColumn("amount_usd", amount)), "purchase")


@query("enriched_in_doubles")
def enriched_in_doubles(spark, sf_dir):
    """The enriched purchase table from the same amounts."""
    sources = role_sources(spark, sf_dir)
    amount = F.floor(F.col("amount_usd") * 4).cast("double") / 4
    return build_table(sources.replace(purchase=sources["purchase"].withColumn("amount_usd", amount)), "purchase_enriched")


@query("spend_totals")
def spend_totals(spark, sf_dir):
    totals = ["purchases_count_7d", "purchases_amount_sum_30d", "purchases_amount_sum_90d"]
    return build_table(role_sources(spark, sf_dir), "purchase").select(*KEYS, *totals)


@query("spend_by_category_and_date")
def spend_by_category_and_date(spark, sf_dir):
    """The daily pre-aggregation under the pivot."""
    pivot = roles.purchase(spark, sf_dir).groupBy(ENTITY, EVENT_DATE).pivot("category", CATEGORIES)
    return pivot.agg(F.sum("amount_usd").cast("double")).na.fill(0.0, CATEGORIES)


@query("max_per_key")
def max_per_account(spark, sf_dir):
    return max_per_key(roles.progression(spark, sf_dir), ENTITY, "new_level", "max_level")


@query("rows_by_table_and_date")
def rows_by_log_and_date(spark, sf_dir):
    sources = role_sources(spark, sf_dir)
    return rows_by_table_and_date({name: sources[name] for name in LOG_TIMESTAMP})


# --- numbering and latest rows ------------------------------------------------------------


@query("running_level")
def running_level_rows(spark, sf_dir):
    return roles.progression(spark, sf_dir).select(ENTITY, "level_up_ts", "new_level")


@query("running_level_by_range")
def running_level_by_range(spark, sf_dir):
    """The same numbers from ranges of equal size, which split any account and any minute."""
    levels = running_level(roles.level_ups(spark, sf_dir), spread="range")
    return levels.select(ENTITY, "level_up_ts", "new_level")


@query("busiest_account_numbered")
def busiest_account_numbered(spark, sf_dir):
    """All events as one account's, without their times: the one key and the one (missing) time hold every row."""
    events = roles.session(spark, sf_dir).select(
        F.lit(0).cast("long").alias(ENTITY), F.lit(None).cast("timestamp").alias("session_ts"),
        F.col(ENTITY).alias("visitor"), EVENT_DATE,
    )
    numbered = running_number(events, ENTITY, "session_ts", "number", spread="range")
    return numbered.select("visitor", EVENT_DATE, "number")


@query("continue_level")
def continue_level_rows(spark, sf_dir):
    """The level-ups of the newest date, numbered onward from the log before it."""
    log = roles.progression(spark, sf_dir)
    newest = latest(log, EVENT_DATE)
    batch = roles.level_ups(spark, sf_dir).where(F.col(EVENT_DATE) == newest)
    leveled = continue_level(batch, log.where(F.col(EVENT_DATE) < newest))
    return leveled.select(ENTITY, "level_up_ts", "new_level")


@query("latest_row_per_key")
def latest_row_per_key(spark, sf_dir):
    return latest_per_key(roles.membership(spark, sf_dir), ENTITY, "date", ["is_clan_member"])


# --- projections and scalar functions -------------------------------------------------------


def _account_spend(spark, sf_dir) -> DataFrame:
    """All accounts with their total spend, missing for those that never bought."""
    spend = roles.purchase(spark, sf_dir).groupBy(ENTITY).agg(
        F.sum("amount_usd").cast("double").alias("spend"), F.count(F.lit(1)).alias("purchases")
    )
    return roles.accounts(spark, sf_dir).join(spend, ENTITY, "left")


@query("created_filter")
def created_filter(spark, sf_dir):
    """Logins on or after the creation of their account."""
    login = roles.login(spark, sf_dir).join(roles.accounts(spark, sf_dir), ENTITY)
    kept = login.where(F.col(EVENT_DATE) >= F.col("created_at"))
    return kept.select(ENTITY, "login_ts", F.col("created_at").alias("since"))


@query("tier_case")
def tier_case(spark, sf_dir):
    tier = C.spender_tier(F.col("spend"))
    return _account_spend(spark, sf_dir).select(
        ENTITY,
        tier.alias("tier"),
        C.tier_weight(tier).alias("weight"),
        (tier == "whale").alias("is_whale"),
        C.band(F.col("spend"), {"whale": 100.0}).eqNullSafe("whale").alias("over_100"),
        (C.band(F.col("spend"), {"whale": 100.0}) == "whale").alias("whale_or_unknown"),
    )


@query("guarded_ratio")
def guarded_ratio(spark, sf_dir):
    spend, count = F.col("spend"), F.coalesce("purchases", F.lit(0))
    return _account_spend(spark, sf_dir).select(
        ENTITY,
        C.ratio(spend, count).alias("spend_per_purchase"),
        C.ratio(count.cast("double"), spend).alias("purchases_per_dollar"),
        C.total([F.coalesce(spend, F.lit(0.0)), count]).alias("spend_plus_count"),
        C.total([spend, count]).alias("spend_plus_count_or_null"),
    )


@query("feature_score")
def feature_score(spark, sf_dir):
    share = F.coalesce(C.ratio(F.lit(50.0), F.col("spend")), F.lit(0.0))
    return _account_spend(spark, sf_dir).select(
        ENTITY,
        (share > 0.5).alias("is_high"),
        (C.tier_weight(C.spender_tier(F.col("spend"))) * share * F.coalesce("spend", F.lit(0.0))).alias("score"),
    )


@query("row_predicates")
def row_predicates(spark, sf_dir):
    category = F.col("category")
    keep = (category.isin("gems", "pass") & F.col("amount_usd").between(5, 50)) | (
        category.isNull() | ~category.isin(*CATEGORIES[:4])
    )
    return roles.purchase(spark, sf_dir).where(keep).select(
        ENTITY, "purchase_ts", "category", F.col("amount_usd").cast("double").alias("amount_usd")
    )


@query("struct_fields")
def struct_fields(spark, sf_dir):
    return parse_sessions(roles.session(spark, sf_dir))


@query("json_payload")
def json_payload_rows(spark, sf_dir):
    return roles.session(spark, sf_dir).select(ENTITY, "session_ts", "payload_json")


@query("date_functions")
def date_functions(spark, sf_dir):
    joined = roles.login(spark, sf_dir).join(roles.accounts(spark, sf_dir), ENTITY)
    day = F.col(EVENT_DATE)
    return joined.select(
        ENTITY,
        "login_ts",
        C.days_between(day, F.col("created_at")).alias("age_days"),
        F.date_add(day, 7).alias("week_later"),
        F.date_sub(day, 30).alias("month_before"),
        F.date_add(F.col("created_at"), F.dayofmonth(day).cast("int")).alias("shifted"),
        F.timestamp_add("SECOND", F.lit(90), day.cast("timestamp_ntz")).alias("second_90"),
        F.col("login_ts").cast("date").alias("login_day"),
    )


@query("scalar_functions")
def scalar_functions(spark, sf_dir):
    amount = F.col("amount_usd")
    return roles.purchase(spark, sf_dir).select(
        ENTITY,
        "purchase_ts",
        F.round(amount, 1).cast("double").alias("rounded"),
        F.greatest(F.lit(0), F.floor(amount).cast("int") - 20).alias("over_20"),
        F.floor(amount).cast("int").alias("whole"),
        (amount > 20).cast("boolean").alias("is_large"),
        F.coalesce(F.when(amount > 20, F.col("category")), F.lit("small")).alias("large_category"),
    )


@query("expand_rows")
def expand_rows_by_count(spark, sf_dir):
    """Each battle repeated as often as its duration has tens of seconds; short ones vanish."""
    tens = F.floor(F.col("duration_seconds") / 10).cast("int")
    battles = roles.battle(spark, sf_dir).select(ENTITY, "battle_ts", "duration_seconds")
    return expand_rows(battles, tens, "copy").select(ENTITY, "battle_ts", "copy")


@query("interval_to_daily")
def interval_to_daily_rows(spark, sf_dir):
    """Membership from an account's first login to its last battle, on every spine date."""
    starts = roles.login(spark, sf_dir).groupBy(ENTITY).agg(F.min(EVENT_DATE).alias("start_date"))
    intervals = _active_interval(spark, sf_dir).join(starts, ENTITY, "left")
    spine = date_spine(roles.login(spark, sf_dir))
    return interval_to_daily(intervals, spine, "start_date", "end_date", "is_clan_member")


@query("hash_bucket")
def hash_bucket(spark, sf_dir):
    key = [F.col(ENTITY)]
    shares = {"whale": 20, "dolphin": 25, "minnow": 30, "non_spender": 25}
    return roles.accounts(spark, sf_dir).select(
        ENTITY,
        C.stable_bucket([*key, F.lit("spender_class")], 100).alias("bucket"),
        C.stable_class(shares, [*key, F.lit("spender_class")]).alias("spender_class"),
        C.stable_pick(["organic", "paid", "referral"], key).alias("install_source"),
    )


# --- quality ------------------------------------------------------------------------------


@query("quality_counts")
def quality_counts(spark, sf_dir):
    sources = role_sources(spark, sf_dir)
    tables = [n for n in FEATURE_QUERIES.values() if n != "label_login_7d"]
    return quality_report({name: build_table(sources, name) for name in tables})


@query("repeated_keys")
def repeated_keys(spark, sf_dir):
    """Account and date pairs with several logins: a key that is not unique."""
    return duplicate_keys(roles.login(spark, sf_dir), [ENTITY, EVENT_DATE])


@query("misdated_counts")
def misdated_counts(spark, sf_dir):
    return misdated_rows(role_sources(spark, sf_dir))


# --- stored tables ------------------------------------------------------------------------


@query("next_batch_date")
def next_batch_day(spark, sf_dir):
    bounds = date_bounds(roles.login(spark, sf_dir), "login_ts")
    return bounds.select(F.date_add("last_date", 1).alias("next_date"))


@query("carry_forward_snapshot")
def carry_forward_rows(spark, sf_dir):
    day = next_batch_date(roles.login(spark, sf_dir))
    return carry_forward_snapshot(roles.membership(spark, sf_dir), roles.accounts(spark, sf_dir), day)


@query("append_batch")
def append_batch_rows(spark, sf_dir):
    """A login log stored without its newest date, then that date appended twice."""
    login = roles.login(spark, sf_dir)
    newest = latest(login, EVENT_DATE)
    path = shared_folder(spark, "append")
    overwrite(login.where(F.col(EVENT_DATE) < newest), path, EVENT_DATE)
    batch = login.where(F.col(EVENT_DATE) == newest)
    append_batch(batch, path)
    append_batch(batch, path)
    return read_table(spark, path).select(*login.columns)


def _social_from_logins(spark, sf_dir) -> DataFrame:
    """Replacement social events: every login counts as a message."""
    return roles.login(spark, sf_dir).select(
        ENTITY, F.col("login_ts").alias("event_ts"), F.lit("message").alias("event_type"), EVENT_DATE
    )


@query("restate_dates")
def restate_dates_rows(spark, sf_dir):
    """The stored social log after three of its dates were restated."""
    social = roles.social(spark, sf_dir)
    root = shared_folder(spark, "restate")
    overwrite(social, f"{root}/social", EVENT_DATE)
    dates = restatement_dates(roles.login(spark, sf_dir))
    restate_dates(root, {"social": _social_from_logins(spark, sf_dir)}, dates)
    return read_table(spark, f"{root}/social").select(*social.columns)


@query("restated_view")
def restated_view(spark, sf_dir):
    """The same restatement as a plan, nothing stored."""
    dates = restatement_dates(roles.login(spark, sf_dir))
    return with_restated(roles.social(spark, sf_dir), _social_from_logins(spark, sf_dir), dates)


@query("appended_view")
def appended_view(spark, sf_dir):
    """Appending all logins to the battle-day log as a plan: only dates it lacks come in."""
    login = roles.login(spark, sf_dir).select(ENTITY, EVENT_DATE)
    older = login.where(F.col(EVENT_DATE) < F.date_sub(latest(login, EVENT_DATE), 3))
    return with_appended(older, login)


@query("delete_dates")
def delete_dates(spark, sf_dir):
    """The stored session log with the rows of three dates removed."""
    session = roles.session(spark, sf_dir).select(ENTITY, "session_ts", EVENT_DATE)
    path = shared_folder(spark, "delete")
    overwrite(session, path, EVENT_DATE)
    clear_dates(spark, path, EVENT_DATE, restatement_dates(roles.login(spark, sf_dir)))
    return read_table(spark, path).select(*session.columns)


@query("append_rows")
def append_rows(spark, sf_dir):
    """Two logs written to one table, the second by a plain append."""
    path = shared_folder(spark, "rows")
    overwrite(roles.login(spark, sf_dir).select(ENTITY, EVENT_DATE), path, EVENT_DATE)
    append(roles.battle(spark, sf_dir).select(ENTITY, EVENT_DATE), path, EVENT_DATE)
    return read_table(spark, path).select(ENTITY, EVENT_DATE)


@query("published_table")
def published_table(spark, sf_dir):
    """The battle table published under its contract and read back."""
    path = shared_folder(spark, "publish")
    overwrite(build_table(role_sources(spark, sf_dir), "battle"), path, OBSERVED)
    return conform(read_table(spark, path), "battle")


def _store(spark, sf_dir, purpose: str, before: F.Column | None = None) -> FeatureStore:
    """A store of the benchmark's source tables, or of their rows before a date."""
    sources = role_sources(spark, sf_dir)
    if before is not None:
        cut = {n: sources[n].where(F.col(SOURCE_DATE[n]) < before) for n in SOURCE_DATE}
        sources = sources.replace(**cut)
    store = FeatureStore(spark, shared_folder(spark, purpose))
    store.load(sources)
    return store


def _append_newest(spark, sf_dir, store: FeatureStore) -> None:
    """Add the rows of the newest login date, as a daily job would."""
    sources = role_sources(spark, sf_dir)
    day = store.next_day()
    store.append_day({n: sources[n].where(F.col(SOURCE_DATE[n]) == F.lit(day)) for n in SOURCE_DATE}, day)


def _newest_login(spark, sf_dir) -> F.Column:
    return F.lit(roles.login(spark, sf_dir).agg(F.max(EVENT_DATE)).first()[0])


@query("dataset_by_path")
def dataset_by_path(spark, sf_dir):
    """The training set stored over an older dataset of other columns, and read back."""
    path = shared_folder(spark, "dataset")
    sources = role_sources(spark, sf_dir)
    save_dataset(prediction_set_from_logs(sources), path)
    save_dataset(training_set_from_logs(sources), path)
    return read_table(spark, path)


@query("registered_table")
def registered_table(spark, sf_dir):
    """The published battle table, found by name in the catalog under its contract."""
    store = _store(spark, sf_dir, "registered")
    store.publish(["battle"])
    schema = f"features_{uuid4().hex}"
    store.register(schema)
    return spark.table(f"{schema}.battle").select(*schema_of("battle").fieldNames())


@query("refresh_slice")
def refresh_slice(spark, sf_dir):
    """The stored social table after a restatement and a refresh of the dates it affects."""
    store = _store(spark, sf_dir, "refresh")
    store.publish(["social"])
    dates = restatement_dates(store.sources()["login"])
    store.restate_dates({"social": _social_from_logins(spark, sf_dir)}, dates)
    store.refresh(names=["social"])
    return conform(store.table("social"), "social")


@query("refresh_by_parts")
def refresh_by_parts(spark, sf_dir):
    """Battle and level tables after a day was appended and each was refreshed by a run of its own."""
    store = _store(spark, sf_dir, "parts", _newest_login(spark, sf_dir))
    store.publish(["battle", "progression"])
    _append_newest(spark, sf_dir, store)
    store.refresh(names=["battle"])
    store.refresh(names=["battle", "progression"])
    return fan_in(conform(store.table("battle"), "battle"), conform(store.table("progression"), "progression"))


@query("stored_prediction_after_append")
def stored_prediction_after_append(spark, sf_dir):
    """The scoring set of a store that took in its newest day in two partial refreshes."""
    store = _store(spark, sf_dir, "scoring", _newest_login(spark, sf_dir))
    names = ["account", "battle", "progression", "social"]
    store.publish(names)
    _append_newest(spark, sf_dir, store)
    store.refresh(names=names[1:3])
    store.refresh(names=names)
    return store.prediction_set(["account_age_days", "win_rate_7d", "level_ups_7d", "current_level", "messages_7d"])


@query("refresh_new_accounts")
def refresh_new_accounts(spark, sf_dir):
    """The battle table after every seventh account came later: stored without them, then merged in."""
    store = _store(spark, sf_dir, "accounts")
    sources = role_sources(spark, sf_dir)
    late = F.col(ENTITY) % 7 == 0
    overwrite(sources["account"].where(~late), f"{store.source_root}/account")
    store.publish(["battle"])
    overwrite(sources["account"], f"{store.source_root}/account")
    store.refresh(names=["battle"], accounts=sources["account"].where(late).select(ENTITY))
    return conform(store.table("battle"), "battle")


@query("carried_snapshot")
def carried_snapshot(spark, sf_dir):
    """The next day's snapshot from the state that appends keep, without the snapshot's history."""
    store = _store(spark, sf_dir, "carried", _newest_login(spark, sf_dir))
    _append_newest(spark, sf_dir, store)
    return store.carried_snapshot(store.next_day())


@query("feature_slice")
def feature_slice(spark, sf_dir):
    """Only the three restated dates of the level table, computed on their own."""
    sources = role_sources(spark, sf_dir)
    dates = restatement_dates(sources["login"])
    return build_table(sources, "progression", Axis.of_days(spark, dates))


@query("feature_slice_from_state")
def feature_slice_from_state(spark, sf_dir):
    """The level table's second half from its stored rows on the date before, and thirty dates of log."""
    sources = role_sources(spark, sf_dir)
    days = sorted(r[0] for r in date_spine(sources["login"]).collect())  # one per calendar day
    before = days[len(days) // 2]
    path = shared_folder(spark, "state")
    overwrite(build_table(sources, "progression", Axis.of_days(spark, [before])), path, OBSERVED)
    carry = Carry(before, read_table(spark, path, schema_of("progression")))
    return build_table(sources, "progression", Axis.of_days(spark, [d for d in days if d > before]), carry)


# --- checks on write ----------------------------------------------------------------------

# Per table: the damage done to the rows of accounts with a remainder modulo 11.
DAMAGE = {
    "account": {1: {"account_age_days": "-1"}},
    "battle": {1: {"win_rate_7d": "2D"}, 2: {"avg_duration_7d": "-1D"}},
    "purchase": {},
    "progression": {1: {"current_level": "0"}, 2: {"level_ups_7d": "-1L"}, 3: {"level_ups_7d": "level_ups_30d + 1"}},
    "social": {1: {"gifts_7d": "-1L"}},
    "social_enriched": {},
    "session": {1: {"sessions_7d": "-1L"}, 2: {"avg_session_seconds_7d": "-1D"}, 3: {"sessions_ios_7d": "sessions_7d + 1"}},
    "spender_tier": {1: {"spender_tier": "'tin'"}},
    "purchase_velocity": {1: {"spend_7d_total": "-1D"}, 2: {"spend_velocity_7d_over_30d": "1.5D"}},
    "purchase_enriched": {1: {"enriched_spend_score": "-1D"}},
}


def _damaged(df: DataFrame, table: str) -> DataFrame:
    """Rows that break every check of their table, missing accounts and repeated keys among them."""
    columns = {}
    for rest, changes in DAMAGE[table].items():
        for column, value in changes.items():
            text = columns.get(column, column)
            columns[column] = f"CASE WHEN {ENTITY} % 11 = {rest} THEN {value} ELSE {text} END"
    columns[ENTITY] = f"CASE WHEN {ENTITY} % 11 = 5 THEN NULL ELSE {ENTITY} END"
    rows = df.selectExpr(*[f"{columns.get(c, c)} AS {c}" for c in df.columns])
    return rows.unionAll(rows.where(F.col(ENTITY) % 11 == 6))


@query("checks_on_write")
def checks_on_write(spark, sf_dir):
    """What the checks count while damaged tables are written: every one of them finds rows."""
    sources = role_sources(spark, sf_dir)
    root, counted = shared_folder(spark, "checks"), []
    for table in DAMAGE:
        rows = _damaged(build_table(sources, table), table)
        counted += write_checked(rows, table, f"{root}/{table}")
    return spark.createDataFrame(counted, REPORT_SCHEMA)


@query("checks_kept")
def checks_kept(spark, sf_dir):
    """The counts that a publishing run kept: two tables of sound rows, and a snapshot that repeats its rows."""
    sources = role_sources(spark, sf_dir)
    store = FeatureStore(spark, shared_folder(spark, "kept"))
    store.load(sources.replace(membership=sources["membership"].unionAll(sources["membership"].where(F.col(ENTITY) % 5 == 0))))
    store.publish(["battle", "social_enriched", "purchase_enriched"])
    return store.quality_log().select(*REPORT_SCHEMA.fieldNames())
