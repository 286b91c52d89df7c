"""The three window forms agree, on random data with gaps and a hot account."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.grid import Axis, date_spine, observable, observation_grid
from tidemark.operators.joins import range_join
from tidemark.operators.windows import (
    SAME_DATE,
    TO_DATE,
    Rolling,
    Span,
    attach,
    back_to,
    daily_partials,
    last_dates,
    next_dates,
)

FIRST = dt.date(2024, 2, 1)


def _day(n):
    return FIRST + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    accounts = [(a, _day(rng.randrange(60))) for a in range(40)]
    # A third of all events belong to account 0; some accounts have none; some dates are missing.
    events = [
        (0 if rng.random() < 1 / 3 else rng.randrange(1, 50), _day(rng.choice([d for d in range(90) if d % 11])),
         rng.randrange(100), rng.random())
        for _ in range(3000)
    ]
    spine = [(_day(d),) for d in range(0, 90) if d % 7]
    return (
        spark.createDataFrame(accounts, "account_id long, created_at date"),
        spark.createDataFrame(events, "account_id long, event_date date, v int, x double"),
        spark.createDataFrame(spine, "observation_date date"),
        accounts,
        events,
        [d for (d,) in spine],
    )


ROLLINGS = [
    Rolling("n8", "n", back_to(7)),
    Rolling("n7", "n", last_dates(7)),
    Rolling("s90", "s", last_dates(90)),
    Rolling("today", "s", SAME_DATE),
    Rolling("ahead", "n", next_dates(7)),
    Rolling("around", "s", Span(-3, 3)),
    Rolling("x30", "x", last_dates(30)),
    Rolling("top30", "m", last_dates(30), "max"),
]
MEASURES = {"n": "count(v)", "s": "sum(v)", "x": "sum(x)", "m": "max(v)"}


def _brute(accounts, events, spine):
    out = {}
    for account, created in accounts:
        for day in spine:
            if day < created:
                continue
            mine = [((e[1] - day).days, e[2]) for e in events if e[0] == account]
            pick = lambda lo, hi: [v for o, v in mine if lo <= o <= hi]
            out[account, day] = (
                len(pick(-7, 0)), len(pick(-6, 0)), sum(pick(-89, 0)), sum(pick(0, 0)), len(pick(1, 7)),
                sum(pick(-3, 3)), max(pick(-29, 0), default=None),
            )
    return out


@pytest.mark.parametrize("form", ["frame", "join", "spread"])
def test_forms_match_brute_force(data, form):
    accounts, events, spine, *raw = data
    grid = observation_grid(accounts, spine, colocate=True)
    got = attach(grid, daily_partials(events, MEASURES), ROLLINGS, form)
    columns = ["n8", "n7", "s90", "today", "ahead", "around", "top30"]
    rows = {(r.account_id, r.observation_date): tuple(r[c] for c in columns) for r in got.collect()}
    assert rows == _brute(*raw)


def test_double_sums_agree_across_forms(data):
    accounts, events, spine, *_ = data
    grid = observation_grid(accounts, spine, colocate=True)
    daily = daily_partials(events, MEASURES)
    frame = attach(grid, daily, ROLLINGS).withColumnRenamed("x30", "a").select("account_id", "observation_date", "a")
    join = attach(grid, daily, ROLLINGS, "join").select("account_id", "observation_date", "x30")
    worst = frame.join(join, ["account_id", "observation_date"]).agg(F.max(F.abs(F.col("a") - F.col("x30")))).first()[0]
    assert worst < 1e-9


@pytest.mark.parametrize("form", ["frame", "join"])
def test_history_frames(data, form):
    accounts, events, spine, raw_accounts, raw_events, raw_spine = data
    rollings = [Rolling("top", "m", TO_DATE, "max"), Rolling("all", "n", TO_DATE)]
    got = attach(observation_grid(accounts, spine, colocate=True), daily_partials(events, MEASURES), rollings, form)
    for r in got.collect():
        seen = [e[2] for e in raw_events if e[0] == r.account_id and e[1] <= r.observation_date]
        assert (r.top, r["all"]) == (max(seen, default=None), len(seen))


def test_spread_refuses_history(data):
    accounts, events, spine, *_ = data
    with pytest.raises(ValueError):
        attach(observation_grid(accounts, spine), daily_partials(events, MEASURES), [Rolling("t", "m", TO_DATE, "max")], "spread")


@pytest.mark.parametrize("span", [back_to(7), next_dates(7), TO_DATE])
def test_range_join_keeps_all_pairs(data, span):
    accounts, events, spine, raw_accounts, raw_events, raw_spine = data
    got = range_join(observation_grid(accounts, spine), spine, events.select("account_id", "event_date", "v"), span)
    pairs = 0
    for account, created in raw_accounts:
        for day in raw_spine:
            if day >= created:
                seen = [
                    e for e in raw_events
                    if e[0] == account and (e[1] - day).days <= span.last
                    and (span.first is None or (e[1] - day).days >= span.first)
                ]
                pairs += max(1, len(seen))
    assert got.count() == pairs


def test_grid_bounds_and_spine(spark, data):
    accounts, events, spine, *_ = data
    until = accounts.withColumn("gone", F.expr("CASE WHEN account_id % 2 = 0 THEN date_add(created_at, 5) END"))
    grid = observation_grid(until, spine, until="gone", keep=["created_at", "gone"]).collect()
    assert all(r.observation_date >= r.created_at and (r.gone is None or r.observation_date < r.gone) for r in grid)
    full = observation_grid(accounts, spine).count()
    assert 0 < len(grid) < full
    dates = sorted(r[0] for r in date_spine(events).collect())
    seen = sorted(r[0] for r in observable(date_spine(events), 7).collect())
    assert seen == [d for d in dates if d <= dates[-1] - dt.timedelta(days=7)]


def test_axis_reads_only_what_it_can_see(spark, data):
    _, events, *_ = data
    axis = Axis.of_days(spark, [_day(20), _day(21), _day(60)])
    days = {r.event_date for r in axis.events(events, "event_date", (-7, 0)).select("event_date").collect()}
    allowed = {_day(d) for d in [*range(13, 22), *range(53, 61)]}
    assert days and days <= allowed
    assert axis.events(events, "event_date", (None, 0)).agg(F.max("event_date")).first()[0] <= _day(60)
    assert Axis.of_days(spark, []).events(events, "event_date", (-7, 0)).count() == 0
