"""Partial refreshes, changed accounts, checks on write, carried state, and numbering by ranges."""

import datetime as dt
import random
import re

import pytest
from handmade import day, sources
from pyspark.sql import functions as F

from test_maintain import _assert_current, _random_sources, _same
from test_plans import plan
from tidemark.contracts import ENTITY, LOG_TIMESTAMP, OBSERVED
from tidemark.maintain import PUBLISHED, FeatureStore, carry_forward_snapshot
from tidemark.manifest import KEPT, Manifest
from tidemark.operators.dyadic import dates_after
from tidemark.operators.grid import Axis, date_spine, observation_grid
from tidemark.operators.joins import range_join
from tidemark.operators.sequence import expand_rows, ranged, running_number
from tidemark.operators.windows import TO_DATE, Rolling, Span, attach
from tidemark.plans.features import Carry, build_table
from tidemark.quality import EXPECTATIONS, KEY_CHECK, UNIQUE_CHECK, counts, watch_keys, write_checked
from tidemark.sources import files
from tidemark.sources.tables import clear_dates, inline_dates, overwrite, read_table, replace_dates, save_dataset

SPAN = 14


@pytest.fixture
def store(spark, tmp_path):
    s = FeatureStore(spark, str(tmp_path / "store"))
    s.load(_random_sources(spark, span=SPAN))
    return s


def _next_batch(spark, store, seed=3):
    """A day's rows for every dated source table."""
    new = store.next_day()
    one = _random_sources(spark, seed=seed, span=SPAN)
    batch = {
        name: one[name].where(F.col("event_date") == day(5)).withColumn("event_date", F.lit(new)).withColumn(ts, F.lit(new).cast("timestamp"))
        for name, ts in LOG_TIMESTAMP.items()
    }
    batch["membership"] = store.carried_snapshot(new)
    return batch, new


# --- manifest and partial refreshes ----------------------------------------------------------


def test_manifest_keeps_changes_until_all_tables_took_them_in():
    m = Manifest().with_table("battle", [day(0)]).with_table("social", [day(0)])
    m = m.with_changes({"battle": [day(3), day(1), day(3)], "social": [], "login": [day(2)]})
    assert [(c.number, c.source, c.dates) for c in m.changes] == [(1, "battle", (day(1), day(3))), (2, "login", (day(2),))]
    m = m.with_table("battle", [day(0), day(3)])
    assert not m.pending("battle", "battle") and len(m.pending("social", "battle")) == 1 and len(m.changes) == 2
    m = m.with_changes({}, accounts="somewhere")
    assert m.pending("social", "account")[0].accounts == "somewhere" and m.changed == 3
    assert Manifest.from_json(m.to_json()) == m
    assert m.with_table("social", []).with_table("battle", []).changes == ()
    assert [c.number for c in m.pending("new table", "login")] == [2]


def test_manifest_versions(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    assert Manifest.read(spark, folder) == Manifest()
    m = Manifest()
    for _ in range(KEPT + 3):
        m = m.with_changes({"login": [day(1)]}).write(spark, folder)
    assert Manifest.read(spark, folder) == m and m.version == KEPT + 3
    assert len(files.names_in(spark, folder)) == KEPT + 1
    with pytest.raises(RuntimeError, match="another run"):
        Manifest().write(spark, folder)


def test_refresh_by_parts_equals_a_rebuild(spark, store):
    store.publish()
    batch, new = _next_batch(spark, store)
    store.append_day(batch, new)
    other = _random_sources(spark, seed=9, span=SPAN)
    store.restate_dates({n: other[n] for n in ("battle", "login", "progression")}, [day(4), day(8)])
    first = store.refresh(names=["battle", "social"])
    assert set(first) >= {"battle", "social"} and "progression" not in first
    with pytest.raises(RuntimeError, match="progression"):
        store.prediction_set(["current_level", "battles_7d"])
    assert store.prediction_set(["battles_7d"]).where("battles_7d IS NULL").isEmpty()
    with pytest.raises(RuntimeError, match="label_login_7d|account_age|session|not current"):
        store.training_set(["sessions_7d"])
    second = store.refresh()
    assert "battle" not in second and "social" not in second and second["progression"][0] == day(4)
    _assert_current(store)
    assert store.refresh() == {} and store.manifest.changes == ()
    assert store.prediction_set().where("account_age_days IS NULL OR current_level IS NULL").isEmpty()


def test_a_run_that_fails_midway_is_repeated(spark, store, monkeypatch):
    store.publish(["battle", "social", "session"])
    batch, new = _next_batch(spark, store)
    store.append_day(batch, new)
    whole = FeatureStore._refresh_table

    def failing(self, manifest, name, *rest):
        if name == "session":
            raise OSError("lost")
        return whole(self, manifest, name, *rest)

    monkeypatch.setattr(FeatureStore, "_refresh_table", failing)
    with pytest.raises(OSError):
        store.refresh(names=["battle", "session", "social"])
    monkeypatch.undo()
    done = store.refresh(names=["battle", "session", "social"])
    assert "battle" not in done and done["session"] == done["social"] == [new]
    for name in ("battle", "session", "social"):
        assert _same(build_table(store.sources(), name), store.table(name))


def test_refresh_builds_what_was_never_published(spark, store):
    done = store.refresh(names=["battle"])
    assert done["battle"] == list(store.manifest.tables["battle"].dates)
    assert _same(build_table(store.sources(), "battle"), store.table("battle"))
    assert list(store.tables()) == ["battle"]


# --- accounts --------------------------------------------------------------------------------


def test_new_changed_and_removed_accounts(spark, store):
    store.publish()
    before = store.sources()["account"].collect()
    schema = store.sources()["account"].schema
    late = day(SPAN - 4)
    rows = [r for r in before if r.account_id not in (3, 4)]
    rows += [(99, late, "US", "paid"), (4, day(1), "FR", "organic")]  # 3 leaves, 4 moves, 99 comes
    overwrite(spark.createDataFrame(rows, schema), f"{store.source_root}/account")
    only_new = store.refresh(names=["battle"], accounts=[99, 3, 4])
    store.refresh(names=["social"])
    done = store.refresh()
    assert "battle" not in done and only_new["battle"]
    _assert_current(store)
    # One account more: only the dates from its creation on are rewritten.
    overwrite(spark.createDataFrame([*store.sources()["account"].collect(), (100, late, "US", "paid")], schema), f"{store.source_root}/account")
    done = store.refresh(accounts=spark.createDataFrame([(100,)], "account_id long"))
    assert min(done["battle"]) >= late and min(done["purchase_enriched"]) >= late and min(done["progression"]) >= late
    _assert_current(store)
    assert files.names_in(spark, f"{store.root}/changes") == []


# --- daily state -----------------------------------------------------------------------------


def test_daily_jobs_read_no_history(spark, store):
    new = store.next_day()
    assert new == max(r[0] for r in store.sources()["login"].select("event_date").distinct().collect()) + dt.timedelta(days=1)
    got = store.carried_snapshot(new)
    assert "sources/membership" not in plan(got) and "FileScan" in plan(got)
    assert _same(carry_forward_snapshot(store.sources()["membership"], store.sources()["account"], new), got)
    for seed in (3, 4):
        batch, new = _next_batch(spark, store, seed)
        store.append_day(batch, new)
        store.append_day(batch, new)  # repeated after a failure
    assert store.next_day() == new + dt.timedelta(days=1)
    after = store.sources()
    assert _same(carry_forward_snapshot(after["membership"], after["account"], day(60)), store.carried_snapshot(day(60)))
    assert len(files.names_in(spark, f"{store.root}/state")) == 2  # the current one and the one before


def test_level_slices_start_from_stored_state(spark, store):
    store.publish(["progression"])
    s = store.sources()
    spine = sorted(r[0] for r in date_spine(s["login"]).collect())
    at, days = spine[-6], spine[-5:]
    late = s["account"].where(F.col("created_at") > F.lit(at)).count()
    carry = Carry(at, store.table("progression").where(F.col(OBSERVED) == F.lit(at)))
    got = build_table(s, "progression", Axis.of_days(spark, days), carry)
    assert _same(store.table("progression").where(F.col(OBSERVED).isin(days)), got)
    scans = [line for line in plan(got).splitlines() if "FileScan" in line and "new_level" in line]
    assert len(scans) == (2 if late else 1)
    assert re.search(r"event_date#\d+ >= \d{4}-\d\d-\d\d", scans[0]) and re.search(r"event_date#\d+ <= \d{4}-\d\d-\d\d", scans[0])
    state = next(line for line in plan(got).splitlines() if "FileScan" in line and "current_level" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*observation_date", state)


def test_accounts_without_state_are_read_whole(spark):
    """Level-ups before an account's creation count although no earlier row carries them."""
    s = sources(
        spark, account=[(1, 0), (2, 60)], login=[(1, d) for d in range(0, 70)],
        progression=[(1, 2, 5), (2, 3, 9), (2, 65, 10), (1, 66, 6)],
    )
    full = build_table(s, "progression")
    for first in (50, 61, 64, 67):
        days = [day(d) for d in range(first, 70)]
        carry = Carry(day(first - 1), full.where(F.col(OBSERVED) == F.lit(day(first - 1))))
        assert _same(full.where(F.col(OBSERVED).isin(days)), build_table(s, "progression", Axis.of_days(spark, days), carry))


# --- checks on write -------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 7])
def test_checks_are_counted_in_the_write(spark, tmp_path, buckets):
    s = _random_sources(spark, span=SPAN)
    rows = build_table(s, "battle")
    twice = rows.unionAll(rows.where("account_id = 0")).unionAll(rows.selectExpr("NULL", "observation_date", "1L", "2D", "-1D").limit(2))
    path = str(tmp_path / "battle")
    got = {(c.table_name, c.check_name): (c.row_count, c.violations) for c in write_checked(twice, "battle", path, buckets=buckets)}
    n = twice.count()
    assert got[("battle", "valid_win_rate")] == got[("battle", "nonneg_duration")] == (n, 2)
    assert got[("battle", KEY_CHECK)] == (n, 2)
    assert got[("battle", UNIQUE_CHECK)] == (n, n - twice.select(ENTITY, OBSERVED).distinct().count())
    assert read_table(spark, path).count() == n


def test_the_check_of_keys_adds_one_exchange(spark):
    rows = build_table(_random_sources(spark, span=SPAN), "battle")
    exchanges = lambda df: len(re.findall(r"[-: ]Exchange\b", plan(df)))
    watched, _ = watch_keys(rows, "battle")
    assert exchanges(watched) == exchanges(rows) + 1
    # The writer's order by date is there already: one sort for the check and for the files.
    sorts = lambda df: len(re.findall(r"[-: ]Sort\b", plan(df)))
    assert sorts(watched) == sorts(rows) + 1


@pytest.mark.parametrize("table", sorted(PUBLISHED))
def test_a_planted_duplicate_is_found(spark, table):
    rows = build_table(_random_sources(spark, span=SPAN), table)
    watched, seen = watch_keys(rows.unionAll(rows.limit(1)).repartition(5), table)
    watched.write.format("noop").mode("overwrite").save()
    assert {c.check_name: c.violations for c in counts(seen, table)}[UNIQUE_CHECK] == 1


def test_publish_and_refresh_return_and_keep_their_counts(spark, store):
    counted = store.publish(["battle", "purchase_enriched"])
    checked = {c.table_name for c in counted}
    assert checked == {"battle", "purchase_enriched", "spender_tier", "purchase_velocity"}
    for name in checked:
        assert {c.check_name for c in counted if c.table_name == name} == {*EXPECTATIONS[name], KEY_CHECK, UNIQUE_CHECK}
    assert set(store.table("purchase_enriched").columns) == {ENTITY, OBSERVED, "is_whale", "is_high_velocity", "enriched_spend_score"}
    batch, new = _next_batch(spark, store)
    store.append_day(batch, new)
    done = store.refresh(names=["battle"])
    rows = store.table("battle").where(F.col(OBSERVED).isin(done["battle"])).count()
    assert {c.row_count for c in done.checks} == {rows} and not any(c.violations for c in done.checks)
    log = store.quality_log()
    assert log.select("run").distinct().count() == 2 and log.count() == len(counted) + len(done.checks)
    assert _same(build_table(store.sources(), "battle"), store.table("battle"))


# --- removing dates --------------------------------------------------------------------------


def _dated(spark, path, n):
    rows = spark.createDataFrame([(i, day(i)) for i in range(n)], "v int, event_date date")
    overwrite(rows.coalesce(1), path, "event_date")


def test_many_dates_are_removed_without_a_job(spark, tmp_path):
    path = str(tmp_path / "log")
    _dated(spark, path, 400)
    spark.sparkContext.setJobGroup("removal", "removal")
    clear_dates(spark, path, "event_date", [day(i) for i in range(5, 370)])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("removal")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 2
    assert sorted(r.v for r in read_table(spark, path).collect()) == [*range(5), *range(370, 400)]
    assert files.stored_dates(spark, path, "event_date") == [day(i) for i in [*range(5), *range(370, 400)]]


def test_an_interrupted_removal_is_completed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    _dated(spark, path, 20)
    left = {"n": 3}
    real = files.discard

    def failing(spark_, target):
        if "event_date=" in target:
            if not left["n"]:
                raise OSError("lost")
            left["n"] -= 1
        real(spark_, target)

    monkeypatch.setattr(files, "discard", failing)
    with pytest.raises(OSError):
        clear_dates(spark, path, "event_date", [day(i) for i in range(10)])
    monkeypatch.undo()
    assert read_table(spark, path).count() == 17  # readers skip the list
    clear_dates(spark, path, "event_date", [day(15)])
    assert sorted(r.v for r in read_table(spark, path).collect()) == [10, 11, 12, 13, 14, 16, 17, 18, 19]
    assert not [n for n in files.names_in(spark, path) if n.startswith("_tomb")]


def test_replaced_dates_without_rows_go(spark, tmp_path):
    path = str(tmp_path / "log")
    _dated(spark, path, 6)
    new = spark.createDataFrame([(70, day(2)), (71, day(2)), (72, day(5))], "v int, event_date date")
    replace_dates(new, path, "event_date", [day(1), day(2)])
    assert sorted(r.v for r in read_table(spark, path).collect()) == [0, 3, 4, 5, 70, 71]


# --- open ranges as blocks of dates ------------------------------------------------------------


def test_open_ranges_meet_in_one_block(spark):
    r = random.Random(4)
    days = sorted({dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(1969, 12, 31), dt.date(1970, 1, 1)} | {dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(900)) for _ in range(60)})
    starts = [(i, r.choice(days) if i % 3 else dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(900))) for i in range(80)] + [(900, None)]
    rows = spark.createDataFrame(starts, "id int, event_date date")
    got = dates_after(rows, F.col("event_date"), inline_dates(spark, [*days, None], OBSERVED), OBSERVED)
    want = sorted((i, d) for i, s in starts if s for d in days if d >= s)
    assert sorted((x.id, x.observation_date) for x in got.collect()) == want


def test_history_join_has_no_nested_loop(spark):
    s = _random_sources(spark)
    spine = date_spine(s["login"])
    grid = observation_grid(s["account"], spine)
    log = s["progression"].select(ENTITY, "event_date", "new_level")
    text = plan(range_join(spark.createDataFrame(grid.collect(), grid.schema), spine, log, TO_DATE))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_open_windows_by_blocks_equal_frames(spark):
    s = _random_sources(spark)
    spine = date_spine(s["login"])
    grid = observation_grid(s["account"], spine)
    daily = s["progression"].groupBy(ENTITY, "event_date").agg(F.max("new_level").alias("top"), F.count(F.lit(1)).alias("n"))
    rollings = [
        Rolling("top", "top", TO_DATE, "max"), Rolling("n_all", "n", TO_DATE), Rolling("n_7", "n", Span(-6, 0)),
        Rolling("low", "top", Span(None, 3), "min"), Rolling("n_before", "n", Span(None, -1)),
    ]
    want = attach(observation_grid(s["account"], spine, colocate=True), daily, rollings)
    assert _same(want, attach(grid, daily, rollings, "join"))
    assert _same(want.select(ENTITY, OBSERVED, "top"), attach(grid, daily, rollings[:1], "join"))
    # No row pairs a date with an event: blocks are aggregated, then joined by equality.
    text = plan(attach(grid, daily, rollings[:1], "join"))
    assert not re.search(r"Join.*event_date#\d+ <= ", text)


# --- numbering by ranges -----------------------------------------------------------------------


def test_ranges_split_a_hot_key_a_hot_minute_and_missing_times(spark):
    n, at = 20_000, dt.datetime(2024, 3, 1, 12, 0, 30)
    rows = [(0 if i % 10 else i, at if i % 10 else at + dt.timedelta(seconds=i), i) for i in range(n)]
    for data in (rows, [(a, None, v) for a, _, v in rows]):
        log = spark.createDataFrame(data, "account_id long, ts timestamp, v int")
        sizes = sorted(r["count"] for r in ranged(log, ["account_id", "ts", "v"], "part", 8).groupBy("part").count().collect())
        assert len(sizes) == 8 and sizes[-1] < 2 * sizes[len(sizes) // 2]
        got = running_number(log, "account_id", "ts", "number", spread="range")
        want = running_number(log, "account_id", "ts", "number")
        assert _same(want, got)
        assert got.where("account_id = 0").agg(F.max("number"), F.count_distinct("number")).first() == (n * 9 // 10 + 1,) * 2


def test_ranges_keep_copies_and_missing_keys(spark):
    log = spark.createDataFrame(
        [(1, day(1)), (1, day(1)), (1, None), (None, day(2)), (2, day(0))] * 3, "account_id long, ts date"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    got = running_number(log, "account_id", "ts", "number", spread="range").collect()
    assert sorted(r.number for r in got if r.account_id == 1) == list(range(1, 10))
    assert [r.number for r in got if r.account_id is None] == [None] * 3
    assert running_number(log.limit(0), "account_id", "ts", "number", spread="range").count() == 0


def test_rows_expand_in_chunks(spark):
    rows = spark.createDataFrame([(1, 250_001), (2, 0), (3, None), (4, -3), (5, 2)], "id int, n int")
    got = expand_rows(rows, F.col("n"), "copy")
    assert got.schema["copy"].dataType.simpleString() == "int" and got.count() == 250_003
    assert got.where("id = 1").agg(F.min("copy"), F.max("copy"), F.count_distinct("copy")).first() == (1, 250_001, 250_001)


# --- datasets and the catalog ------------------------------------------------------------------


def test_registered_tables_carry_their_contract(spark, store):
    store.publish(["battle", "label_login_7d"])
    assert store.register("known") == ["known.battle", "known.label_login_7d"]
    assert store.register("known")  # again, after a change of contract
    found = spark.table("known.battle")
    assert _same(build_table(store.sources(), "battle"), found)
    told = {r.col_name: r.comment for r in spark.sql("DESCRIBE known.battle").collect()}
    assert "key" in told[ENTITY] and "7 days" in told["win_rate_7d"]
    ddl = spark.sql("SHOW CREATE TABLE known.battle").first()[0]
    assert "seven dates before it" in ddl and "PARTITIONED BY (observation_date)" in ddl
    pruned = plan(spark.sql(f"SELECT battles_7d FROM known.battle WHERE observation_date = DATE'{day(3)}'"))
    assert re.search(r"PartitionFilters: \[[^\]]*observation_date", pruned)
    spark.sql("DROP SCHEMA known CASCADE")
    assert store.table("battle").count() > 0  # the rows stay


def test_a_strict_store_refuses_missing_keys(spark, tmp_path):
    s = _random_sources(spark, span=SPAN)
    broken = s["account"].unionAll(s["account"].limit(1).withColumn(ENTITY, F.lit(None).cast("long")))
    counted = FeatureStore(spark, str(tmp_path / "counts"))
    counted.load(s.replace(account=broken))
    missing = {c.check_name: c.violations for c in counted.publish(["account"])}
    assert missing[KEY_CHECK] > 0
    strict = FeatureStore(spark, str(tmp_path / "strict"), strict=True)
    strict.load(s.replace(account=broken))
    with pytest.raises(Exception, match="account_id is missing"):
        strict.publish(["account"])
    strict.load(s)
    assert not any(c.violations for c in strict.publish(["account"]))


def test_datasets_are_stored_by_path_and_by_name(spark, store, tmp_path):
    store.publish(["account", "battle", "label_login_7d"])
    names = ["account_age_days", "battles_7d"]
    path = str(tmp_path / "set")
    store.save_training_set(path, names)
    assert _same(store.training_set(names), read_table(spark, path))
    store.save_prediction_set(path, ["win_rate_7d"])  # other columns
    assert _same(store.prediction_set(["win_rate_7d"]), read_table(spark, path))
    save_dataset(read_table(spark, path).where("win_rate_7d IS NULL"), path)  # over what it reads
    assert read_table(spark, path).where("win_rate_7d IS NOT NULL").isEmpty()
    spark.sql("CREATE SCHEMA IF NOT EXISTS sets")
    for chosen in (names, names[1:]):
        store.save_training_set("sets.churn", chosen)
        assert _same(store.training_set(chosen), spark.table("sets.churn"))
    spark.sql("DROP SCHEMA sets CASCADE")


# --- money in doubles --------------------------------------------------------------------------


def test_sums_of_doubles_are_exact(spark):
    from fractions import Fraction

    r = random.Random(6)
    kinds = [lambda: r.choice([0.1, 19.99, 4.99, 0.01]), lambda: r.uniform(-5, 5), lambda: float(r.randrange(10**9)) + 0.07, lambda: 2.0**-30, lambda: None]
    rows = [(1 + i % 3, i % 40, r.choice(["gems", "pass", "other"]), r.choice(kinds)()) for i in range(900)]
    rows += [(4, 5, "gems", float("inf")), (4, 9, "gems", 1.0), (5, 9, "gems", 1.0)]
    s = sources(spark, account=[(a, 0) for a in range(1, 6)], login=[(1, d) for d in range(40)], purchase=rows)
    got = {(x.account_id, (x.observation_date - day(0)).days): x for x in build_table(s, "purchase").collect()}
    text = plan(build_table(s, "purchase"))
    assert not re.search(r"RangeFrame, -?\d+", text)  # no frame with a moving start
    for (account, d), x in got.items():
        for window, column in ((3, "spend_gems_3d"), (90, "spend_gems_90d")):
            inside = [v for a, e, c, v in rows if a == account and c == "gems" and d - window < e <= d and v is not None]
            if any(v == float("inf") for v in inside):
                assert x[column] != x[column]
            else:
                assert x[column] == pytest.approx(float(sum(map(Fraction, inside))), rel=3e-16, abs=0), (account, d, column)
    assert got[4, 4].spend_gems_3d == 0.0 and got[4, 9].spend_gems_3d == 1.0  # out of range only while in the window
