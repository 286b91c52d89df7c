"""Window boundaries, empty windows, malformed input and other single cases."""

import datetime as dt

import pytest
from handmade import at, day, noon, sources, spine_logins

from tidemark.contracts import FEATURE_TABLES, schema_of
from tidemark.operators.asof import exact_join, point_in_time
from tidemark.plans.catalog import FeatureIndex
from tidemark.plans.datasets import CHURN_FEATURES, assemble, feature_tables
from tidemark.plans.features import (
    build_table,
    purchase_enriched,
    purchase_velocity,
    rolled,
    PURCHASE,
    full_axis,
    WINDOW_TABLES,
    window_table,
)
from tidemark.plans.labels import eligibility_prediction
from tidemark.quality import duplicate_keys, misdated_rows, quality_report, watch


@pytest.mark.parametrize("form", ["frame", "join", "spread"])
def test_week_covers_eight_dates(spark, form):
    s = sources(
        spark,
        account=[(1, 0)],
        login=spine_logins(20),
        battle=[(1, 20, 1, 60), (1, 13, 0, 30), (1, 12, 1, 900), (1, 21, 1, 900)],
        session=[(1, d, '{"duration_s": 10, "device": "ios"}') for d in (20, 13, 12, 21)],
        social=[(1, d, "gift") for d in (20, 13, 12, 21)],
    )
    row = at(window_table(WINDOW_TABLES["battle"], s, full_axis(s), form), 1, 20)
    assert (row.battles_7d, row.win_rate_7d, row.avg_duration_7d) == (2, 0.5, 45.0)
    assert at(window_table(WINDOW_TABLES["session"], s, full_axis(s), form), 1, 20).sessions_7d == 2
    assert at(window_table(WINDOW_TABLES["social"], s, full_axis(s), form), 1, 20).gifts_7d == 2


@pytest.mark.parametrize("form", ["frame", "join", "spread"])
def test_spend_windows_cover_exact_dates(spark, form):
    ages = [6, 7, 29, 30, 89, 90]
    s = sources(
        spark,
        account=[(1, 0)],
        login=spine_logins(100),
        purchase=[(1, 100 - age, "gems", 1.0) for age in ages],
    )
    row = at(window_table(PURCHASE, s, full_axis(s), form), 1, 100)
    assert (row.spend_gems_7d, row.spend_gems_14d, row.spend_gems_30d) == (1.0, 2.0, 3.0)
    assert (row.spend_gems_60d, row.spend_gems_90d, row.spend_gems_3d) == (4.0, 5.0, 0.0)
    assert (row.purchases_count_7d, row.purchases_amount_sum_30d, row.purchases_amount_sum_90d) == (1, 3.0, 5.0)


@pytest.mark.parametrize("form", ["frame", "join"])
def test_level_windows_and_history(spark, form):
    ups = [(1, 100 - age, level) for age, level in [(6, 5), (7, 4), (29, 3), (30, 9), (99, 2)]]
    s = sources(spark, account=[(1, 0), (2, 0)], login=spine_logins(100), progression=ups)
    table = window_table(WINDOW_TABLES["progression"], s, full_axis(s), form)
    row, empty = at(table, 1, 100), at(table, 2, 100)
    assert (row.level_ups_7d, row.level_ups_30d, row.current_level) == (1, 3, 9)
    assert (empty.level_ups_7d, empty.level_ups_30d, empty.current_level) == (0, 0, 1)


@pytest.mark.parametrize("form", ["frame", "join", "spread"])
@pytest.mark.parametrize("ahead,expected", [(0, False), (1, True), (7, True), (8, False)])
def test_label_looks_one_to_seven_dates_ahead(spark, form, ahead, expected):
    s = sources(spark, account=[(1, 0)], login=[(1, 20 + ahead), *spine_logins(20, 40)])
    axis_table = window_table(WINDOW_TABLES["label_login_7d"], s, full_axis(s), form)
    assert at(axis_table, 1, 20).did_login_within_7d is expected


def test_label_only_where_observable(spark):
    s = sources(spark, account=[(1, 0)], login=[(1, d) for d in (5, 12, 13, 19)])
    labelled = {r.observation_date for r in build_table(s, "label_login_7d").collect()}
    assert labelled == {day(5), day(12)}


def test_eligibility_covers_31_dates(spark):
    s = sources(spark, login=[(1, 100), (2, 70), (3, 69), (2, 71)])
    rows = eligibility_prediction(s).collect()
    assert sorted(rows) == [(1, day(100)), (2, day(100))]


def test_creation_cuts_the_grid_but_not_the_events(spark):
    s = sources(
        spark,
        account=[(1, 10), (2, None)],
        login=spine_logins(9, 10),
        battle=[(1, 8, 1, 60), (2, 10, 1, 60)],
    )
    rows = build_table(s, "battle").collect()
    assert [(r.account_id, r.observation_date, r.battles_7d) for r in rows] == [(1, day(10), 1)]
    assert at(build_table(s, "account"), 1, 10).account_age_days == 0


def test_empty_windows(spark):
    s = sources(spark, account=[(1, 0)], login=spine_logins(5))
    battle, purchase = at(build_table(s, "battle"), 1, 5), at(build_table(s, "purchase"), 1, 5)
    assert (battle.battles_7d, battle.win_rate_7d, battle.avg_duration_7d) == (0, None, None)
    assert set(purchase[2:]) == {0.0, 0}
    assert at(build_table(s, "social_enriched"), 1, 5).is_clan_member is False
    assert at(build_table(s, "purchase_velocity"), 1, 5).spend_velocity_7d_over_30d is None
    enriched = at(build_table(s, "purchase_enriched"), 1, 5)
    assert (enriched.is_whale, enriched.is_high_velocity, enriched.enriched_spend_score) == (False, False, 0.0)


def test_malformed_payloads(spark):
    texts = ["not json", None, '{"duration_s":"x","device":"ios"}', '{"duration_s":5.7,"device":"ios"}']
    s = sources(spark, account=[(1, 0)], login=spine_logins(5), session=[(1, 5, t) for t in texts])
    table = build_table(s, "session")
    row = at(table, 1, 5)
    assert (row.sessions_7d, row.sessions_ios_7d, row.sessions_android_7d) == (0, 2, 0)
    report = {r.check_name: r.violations for r in quality_report({"session": table}).collect()}
    assert report == {"nonneg_sessions": 0, "nonneg_session_seconds": 0, "device_split_subset": 1, "keys_not_null": 0}


@pytest.mark.parametrize(
    "spend,tier",
    [(0.0, "non_spender"), (0.01, "minnow"), (19.99, "minnow"), (20.0, "dolphin"), (99.99, "dolphin"), (100.0, "whale")],
)
def test_tier_edges(spark, spend, tier):
    s = sources(spark, account=[(1, 0)], login=spine_logins(40), purchase=[(1, 40, "gems", spend), (1, 10, "gems", 500.0)])
    assert at(build_table(s, "spender_tier"), 1, 40).spender_tier == tier


def test_unknown_category_counts_only_in_totals(spark):
    s = sources(spark, account=[(1, 0)], login=spine_logins(5), purchase=[(1, 5, "hats", 80.0), (1, 5, None, 40.0)])
    row = at(build_table(s, "purchase"), 1, 5)
    assert (row.purchases_amount_sum_30d, row.spend_gems_90d, row.purchases_count_7d) == (120.0, 0.0, 2)
    assert at(build_table(s, "purchase_velocity"), 1, 5).spend_velocity_7d_over_30d == 0.0


def test_velocity_of_stored_decimals_never_exceeds_one(spark):
    amounts = {"gems": 0.1, "cards": 0.2, "chest": 0.3, "pass": 0.7, "cosmetic": 0.01}
    s = sources(spark, account=[(1, 0)], login=spine_logins(5), purchase=[(1, 5, c, a) for c, a in amounts.items()])
    exact = s["purchase"].withColumn("amount_usd", s["purchase"].amount_usd.cast("decimal(18,2)"))
    s = s.replace(purchase=exact)
    stored = build_table(s, "purchase")
    assert stored.schema["spend_gems_7d"].metadata == {"money_scale": 2}
    assert at(purchase_velocity(stored), 1, 5).spend_velocity_7d_over_30d == 1.0
    assert at(purchase_velocity(stored), 1, 5) == at(build_table(s, "purchase_velocity"), 1, 5)
    assert at(purchase_enriched(stored), 1, 5) == at(build_table(s, "purchase_enriched"), 1, 5)


def test_double_amounts_keep_small_values_beside_large_ones(spark):
    s = sources(
        spark, account=[(1, 0)], login=spine_logins(50), purchase=[(1, 0, "gems", 1e17), (1, 50, "gems", 0.25)]
    )
    assert at(build_table(s, "purchase"), 1, 50).spend_gems_30d == 0.25
    assert rolled(PURCHASE, s, full_axis(s)).schema["spend_gems_30d"].dataType.simpleString() == "double"


def test_duplicate_snapshot_rows_fan_out_and_are_reported(spark):
    s = sources(
        spark,
        account=[(1, 0)],
        login=spine_logins(5, 6),
        membership=[(1, 5, True), (1, 5, False), (1, 6, True)],
    )
    table = build_table(s, "social_enriched")
    assert table.count() == 3
    assert [(r.account_id, r.observation_date, r.row_count) for r in duplicate_keys(table).collect()] == [(1, day(5), 2)]


def test_misdated_rows(spark):
    s = sources(spark, login=[(1, 5), (1, 6)])
    wrong = s["login"].withColumn("event_date", s["login"].event_date + 1)
    report = {r.log: (r.row_count, r.misdated) for r in misdated_rows({"login": wrong}).collect()}
    assert report == {"login": (2, 2)}


def test_watch_counts_during_the_write(spark, tmp_path):
    s = sources(spark, account=[(1, 0)], login=spine_logins(5))
    df, seen = watch(build_table(s, "account"), "account")
    df.write.parquet(str(tmp_path / "account"))
    assert seen.get == {"row_count": 1, "nonneg_account_age": 0, "keys_not_null": 0}


# --- point-in-time ------------------------------------------------------------------------


def _features(spark, rows, column="value"):
    return spark.createDataFrame([(a, day(d), v) for a, d, v in rows], f"account_id long, observation_date date, {column} int")


def _spine(spark, rows):
    return spark.createDataFrame([(a, day(d)) for a, d in rows], "account_id long, observation_date date")


@pytest.mark.parametrize("unique", [True, False])
def test_as_of_takes_the_newest_row_whole(spark, unique):
    features = _features(spark, [(1, 5, 50), (1, 8, None), (2, 9, 90)])
    spine = _spine(spark, [(1, 4), (1, 5), (1, 7), (1, 8), (1, 20), (2, 8), (3, 8)])
    got = point_in_time(spine, {"f": (features, ["value"])}, unique_spine=unique)
    values = {(r.account_id, r.observation_date): r.value for r in got.collect()}
    expected = {(1, 4): None, (1, 5): 50, (1, 7): 50, (1, 8): None, (1, 20): None, (2, 8): None, (3, 8): None}
    assert values == {(a, day(d)): v for (a, d), v in expected.items()}


def test_as_of_keeps_repeated_and_null_keys(spark):
    features = _features(spark, [(1, 5, 50), (None, 5, 1)])
    spine = _spine(spark, [(1, 6), (1, 6), (None, 6)])
    rows = point_in_time(spine, {"f": (features, ["value"])}).collect()
    assert sorted(str(r.value) for r in rows) == ["50", "50", "None"]


def test_as_of_age_limit(spark):
    features = _features(spark, [(1, 5, 50)])
    spine = _spine(spark, [(1, 8), (1, 9)])
    got = point_in_time(spine, {"f": (features, ["value"])}, max_age_days=3, unique_spine=True)
    assert {r.observation_date: r.value for r in got.collect()} == {day(8): 50, day(9): None}


def test_as_of_several_tables_equals_exact_join_on_a_dense_grid(spark):
    keys = [(1, d) for d in range(5)] + [(2, d) for d in range(3)]
    a = _features(spark, [(*k, i) for i, k in enumerate(keys)], "a")
    b = _features(spark, [(*k, None if i % 2 else i) for i, k in enumerate(keys)], "b")
    wanted = {"a": (a, ["a"]), "b": (b, ["b"])}
    spine = _spine(spark, keys)
    assert sorted(point_in_time(spine, wanted, unique_spine=True).collect(), key=str) == sorted(
        exact_join(spine, wanted).collect(), key=str
    )


def test_as_of_needs_dates(spark):
    bad = spark.createDataFrame([(1, noon(1), 1)], "account_id long, observation_date timestamp, v int")
    with pytest.raises(TypeError, match="DATE"):
        point_in_time(_spine(spark, [(1, 1)]), {"f": (bad, ["v"])})


# --- catalog and datasets -------------------------------------------------------------------


def test_catalog(spark):
    s = sources(spark, account=[(1, 0)], login=spine_logins(5))
    tables = feature_tables(s)
    catalog = FeatureIndex(tables)
    assert len(catalog) == 53 and "account_id" not in catalog
    assert [f.name for f in catalog.pick(CHURN_FEATURES)] == CHURN_FEATURES
    with pytest.raises(KeyError, match="win_rate_7d"):
        catalog.pick(["no_such_feature"])
    with pytest.raises(ValueError, match="battles_7d"):
        FeatureIndex({"one": tables["battle"], "two": tables["battle"]})


def test_assemble_orders_columns(spark):
    s = sources(spark, account=[(1, 0)], login=[(1, 5), (1, 20)])
    tables = feature_tables(s)
    features = FeatureIndex(tables).pick(["win_rate_7d", "country", "battles_7d"])
    spine = _spine(spark, [(1, 5)]).selectExpr("true AS label", "*")
    for dense in (False, True):
        got = assemble(spine, features, tables, "label", dense=dense)
        assert got.columns == ["account_id", "observation_date", "win_rate_7d", "country", "battles_7d", "label"]
        assert [tuple(r) for r in got.collect()] == [(1, day(5), None, "US", 0, True)]
    assert assemble(spine, [], tables).columns == ["account_id", "observation_date"]


def test_contracts(spark):
    s = sources(spark, account=[(1, 0)], login=spine_logins(5))
    for name in FEATURE_TABLES:
        built, declared = build_table(s, name).schema, schema_of(name)
        assert [(f.name, f.dataType) for f in built] == [(f.name, f.dataType) for f in declared]
    with pytest.raises(KeyError):
        build_table(s, "nothing")
    assert dt.date(2024, 3, 1) == day(0)
