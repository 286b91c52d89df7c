"""Appends, restatements, slice refreshes and leaks, on stored tables."""

import datetime as dt
import random

import pytest
from handmade import day, sources
from pyspark.sql import functions as F

from tidemark.contracts import FEATURE_TABLES, LOG_TIMESTAMP
from tidemark.maintain import (
    PUBLISHED,
    FeatureStore,
    affected_dates,
    append_batch,
    append_day,
    carry_forward_snapshot,
    next_batch_date,
    restate_dates,
    restatement_dates,
    rows_by_table_and_date,
    shared_folder,
)
from tidemark.operators.asof import point_in_time
from tidemark.operators.grid import Axis
from tidemark.plans.datasets import (
    feature_tables,
    prediction_set,
    prediction_set_from_logs,
    training_set,
    training_set_from_logs,
)
from tidemark.plans.features import build_table
from tidemark.plans.labels import eligibility_prediction
from tidemark.sources.tables import Sources, append_table, overwrite, read_table, save_table

# Stored tables have one folder per date; a shorter span keeps those tests quick.
STORED_SPAN = 32


def _random_sources(spark, seed=1, span=100):
    rng = random.Random(seed)

    def when():
        return rng.randrange(span)

    def who():
        return 0 if rng.random() < 1 / 3 else rng.randrange(12)

    many = range(400)
    return sources(
        spark,
        account=[(a, rng.randrange(span // 2)) for a in range(12)],
        login=[(who(), when()) for _ in many],
        battle=[(who(), when(), rng.randrange(2), rng.randrange(30, 270)) for _ in many],
        purchase=[(who(), when(), rng.choice(["gems", "cards", "pass"]), float(rng.randrange(99))) for _ in many],
        progression=[(who(), when(), rng.randrange(2, 30)) for _ in many],
        social=[(who(), when(), rng.choice(["message", "gift"])) for _ in many],
        session=[(who(), when(), f'{{"duration_s": {rng.randrange(99)}, "device": "ios"}}') for _ in many],
        membership=[(a, d, rng.random() < 0.5) for a in range(12) for d in range(0, span, 3)],
    )


@pytest.fixture
def store(spark, tmp_path):
    s = FeatureStore(spark, str(tmp_path / "store"))
    s.load(_random_sources(spark, span=STORED_SPAN))
    return s


def _same(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _logs(store):
    return {n: df for n, df in store.sources().items() if n != "account"}


def _assert_current(store):
    """Every stored table equals a full rebuild from the stored sources."""
    s = store.sources()
    for name in PUBLISHED:
        assert _same(build_table(s, name), store.table(name)), name
    assert _same(eligibility_prediction(s), store.table("eligibility_prediction"))


def test_refresh_after_restatement_equals_rebuild(spark, store):
    store.publish()
    assert store.refresh({}) == {}
    dates = restatement_dates(store.sources()["login"])
    assert len(dates) == 3
    other = _random_sources(spark, seed=2, span=STORED_SPAN)
    # The middle date loses all its rows, logins included, so it leaves the spine.
    kept = [dates[0], dates[2]]
    changed = {name: dates for name in LOG_TIMESTAMP}
    restate_dates(store.source_root, {n: other[n].where(F.col("event_date").isin(kept)) for n in LOG_TIMESTAMP}, dates)
    after = store.sources()
    assert after["login"].where(F.col("event_date") == dates[1]).isEmpty()
    done = store.refresh(changed)
    assert dates[1] in done["battle"] and dates[1] in done["date_spine"]
    assert len(done["battle"]) < STORED_SPAN
    _assert_current(store)


def test_refresh_after_append_touches_only_new_dates(spark, store):
    store.publish()
    logs = store.sources()
    new_day = next_batch_date(logs["login"])
    one = _random_sources(spark, seed=3, span=STORED_SPAN)
    batch = {
        name: one[name].where(F.col("event_date") == day(15)).withColumn("event_date", F.lit(new_day))
        .withColumn(ts, F.lit(new_day).cast("timestamp"))
        for name, ts in LOG_TIMESTAMP.items()
    }
    batch["membership"] = carry_forward_snapshot(logs["membership"], logs["account"], new_day)
    append_day(store.source_root, batch, new_day)
    counts = sorted(rows_by_table_and_date(_logs(store), [new_day]).collect())
    append_day(store.source_root, batch, new_day)
    assert counts == sorted(rows_by_table_and_date(_logs(store), [new_day]).collect())
    done = store.refresh({name: [new_day] for name in batch})
    assert done["battle"] == done["account"] == done["social_enriched"] == [new_day]
    assert done["label_login_7d"][-1] == new_day - dt.timedelta(days=7)
    _assert_current(store)


def test_refresh_after_new_accounts(spark, store):
    store.publish(["account", "battle"])
    logs = store.sources()
    added = logs["account"].union(spark.createDataFrame([(99, day(10), "US", "paid")], logs["account"].schema))
    overwrite(spark.createDataFrame(added.collect(), added.schema), f"{store.source_root}/account")
    overwrite(spark.createDataFrame([], "account_id long, observation_date date"), store.path("eligibility_prediction"))
    store.refresh({}, accounts_changed=True, names=["account", "battle"])
    for name in ("account", "battle"):
        assert _same(build_table(store.sources(), name), store.table(name))
    with pytest.raises(KeyError):
        store.publish(["nothing"])


def test_affected_dates():
    spine = [day(d) for d in range(200)]
    hit = lambda table, e: [(d - day(0)).days for d in sorted(affected_dates(table, [day(e)], spine))]
    assert hit("battle", 50) == list(range(50, 58))
    assert hit("purchase", 50) == list(range(50, 140))
    assert hit("purchase_enriched", 50) == list(range(50, 80))
    assert hit("progression", 50) == list(range(50, 200))
    assert hit("social_enriched", 50) == [50]
    assert hit("label_login_7d", 50) == list(range(43, 50))
    assert hit("account", 50) == []


@pytest.mark.parametrize("name", [*FEATURE_TABLES, "spender_tier", "purchase_velocity", "label_login_7d"])
def test_slices_equal_the_full_table(spark, name):
    s = _random_sources(spark)
    days = [day(3), day(40), day(41), day(77)]
    full = build_table(s, name, Axis(s["login"].selectExpr("event_date AS observation_date").distinct()))
    part = build_table(s, name, Axis.of_days(spark, days))
    assert part.count() > 0 and _same(full.where(F.col("observation_date").isin(days)), part)


def test_datasets_agree(spark, store):
    store.publish()
    s = store.sources()
    assert _same(training_set(s, store.tables()), training_set_from_logs(s))
    assert _same(prediction_set(s, store.tables()), prediction_set_from_logs(s))
    assert _same(store.training_set(), training_set_from_logs(s))
    assert _same(store.prediction_set(), prediction_set_from_logs(s))
    assert training_set_from_logs(s).count() == build_table(s, "label_login_7d").count()


def test_nothing_leaks_from_the_future(spark):
    s = _random_sources(spark)
    cut = day(60)
    past = Sources({
        n: df if n == "account" else df.where(F.col("date" if n == "membership" else "event_date") <= F.lit(cut))
        for n, df in s.items()
    })
    for name, table in feature_tables(s).items():
        assert _same(table.where(F.col("observation_date") <= F.lit(cut)), build_table(past, name)), name


def test_window_properties(spark):
    s = _random_sources(spark)
    purchase, levels = build_table(s, "purchase"), build_table(s, "progression")
    broken = purchase.where(
        "NOT (spend_gems_3d <= spend_gems_7d AND spend_gems_7d <= spend_gems_90d"
        " AND purchases_amount_sum_30d <= purchases_amount_sum_90d)"
        " OR purchases_amount_sum_90d != spend_gems_90d + spend_cards_90d + spend_pass_90d"
    )
    assert broken.isEmpty() and levels.where("level_ups_7d > level_ups_30d").isEmpty()


def test_empty_log_is_an_error(spark):
    s = sources(spark)
    with pytest.raises(RuntimeError):
        next_batch_date(s["login"])
    with pytest.raises(RuntimeError):
        restatement_dates(s["login"])
    with pytest.raises(ValueError):
        restate_dates("nowhere", {"membership": s["membership"]}, [])
    with pytest.raises(ValueError):
        Sources({})


def test_catalog_tables(spark):
    s = _random_sources(spark, span=5)
    spark.sql("CREATE DATABASE IF NOT EXISTS game")
    names = {n: f"t_{n}" for n in s}
    for name, df in s.items():
        save_table(df, f"game.{names[name]}", "event_date" if name in LOG_TIMESTAMP else None)
    append_table(s["login"].limit(0), "game.t_login", "event_date")
    stored = Sources.from_catalog(spark, "game", names)
    assert _same(build_table(s, "battle"), build_table(stored, "battle"))
    spark.sql("DROP DATABASE game CASCADE")


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_stale_store_is_not_scored(spark, tmp_path):
    s = _random_sources(spark, span=12)
    store = FeatureStore(spark, str(tmp_path))
    store.load(s)
    store.publish()
    assert store.prediction_set().count() > 0
    new = next_batch_date(s["login"])
    batch = s["login"].limit(3).withColumn("event_date", F.lit(new)).withColumn("login_ts", F.lit(new).cast("timestamp"))
    append_day(store.source_root, {"login": batch.select(*s["login"].columns)}, new)
    with pytest.raises(RuntimeError, match="refresh"):
        store.prediction_set()
    store.refresh({"login": [new]})
    got = store.prediction_set(["battles_7d", "account_age_days"])
    assert got.count() > 0 and got.where("battles_7d IS NULL OR account_age_days IS NULL").isEmpty()
    with pytest.raises(KeyError, match="account"):
        store.refresh({"account": [new]})


def test_skipped_rows_are_counted(spark, tmp_path):
    log = spark.createDataFrame([(1, dt.date(2024, 3, 1)), (2, dt.date(2024, 3, 2))], "account_id long, event_date date")
    overwrite(log.limit(1), str(tmp_path / "log"), "event_date")
    assert append_batch(log, str(tmp_path / "log")) == 1 and append_batch(log, str(tmp_path / "log")) == 2
    assert read_table(spark, str(tmp_path / "log")).count() == 2


def test_repeated_feature_rows_give_one_answer(spark):
    spine = spark.createDataFrame([(1, dt.date(2024, 3, 2))], "account_id long, observation_date date")
    rows = [(1, dt.date(2024, 3, 1), v) for v in range(50)]
    table = spark.createDataFrame(rows, "account_id long, observation_date date, v int").repartition(7)
    got = {point_in_time(spine, {"f": (table, ["v"])}).first().v for _ in range(3)}
    assert got == {49}
