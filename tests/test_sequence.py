"""Numbering, latest rows and expansion against plain Python."""

import datetime as dt
import random

import pytest

from tidemark.functions.columns import json_payload, stable_bucket, stable_class, stable_pick
from tidemark.operators.sequence import continue_level, expand_rows, latest_per_key, running_level, running_number
from pyspark.sql import functions as F

START = dt.datetime(2024, 3, 30, 12)


def _rows(seed: int, n: int = 400):
    """Random events with many ties and copies; account 0 has about half of the rows."""
    rng = random.Random(seed)
    return [
        (rng.choice([0, 0, 0, 1, 2, 3]), START + dt.timedelta(seconds=rng.randrange(0, 2000, 7)), rng.choice("ab"))
        for _ in range(n)
    ]


def _numbered(rows):
    out, last = [], {}
    for account, ts, tag in sorted(rows):
        last[account] = last.get(account, 0) + 1
        out.append((account, ts, tag, last[account]))
    return sorted(out)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("bucket", [1, 60, 86400])
def test_running_number(spark, kind, bucket):
    rows = _rows(bucket)
    df = spark.createDataFrame(rows, f"account_id long, ts {kind}, tag string")
    got = running_number(df, "account_id", "ts", "n", bucket_seconds=bucket)
    assert sorted(tuple(r) for r in got.collect()) == _numbered(rows)


def test_running_number_across_a_clock_change(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        stamps = [dt.datetime(2024, 10, 27, h, m) for h in range(5) for m in (0, 30)]
        df = spark.createDataFrame([(1, t) for t in stamps], "account_id long, ts timestamp_ntz")
        got = running_number(df, "account_id", "ts", "n").collect()
        assert [r.ts for r in sorted(got, key=lambda r: r.n)] == stamps
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_missing_times_come_first_and_missing_keys_stay(spark):
    df = spark.createDataFrame(
        [(1, START), (1, None), (None, START)], "account_id long, ts timestamp"
    )
    got = {(r.account_id, r.ts): r.n for r in running_number(df, "account_id", "ts", "n").collect()}
    assert got == {(1, None): 1, (1, START): 2, (None, START): None}


def test_many_copies_expand(spark):
    df = spark.range(250_000).select(F.lit(1).alias("account_id"), F.lit(START).alias("ts"))
    got = running_number(df, "account_id", "ts", "n")
    assert got.agg(F.count("n"), F.countDistinct("n"), F.max("n")).first() == (250_000, 250_000, 250_000)


def test_levels_continue_across_batches(spark):
    rows = [(a, t) for a, t, _ in _rows(3)]
    cut = START + dt.timedelta(seconds=1000)
    whole = running_level(spark.createDataFrame(rows, "account_id long, level_up_ts timestamp"))
    log = running_level(spark.createDataFrame([r for r in rows if r[1] < cut], whole.schema[:2]))
    batch = spark.createDataFrame([r for r in rows if r[1] >= cut] + [(77, cut)], whole.schema[:2])
    got = sorted(tuple(r) for r in continue_level(batch, log).collect())
    assert got == sorted([tuple(r) for r in whole.where(F.col("level_up_ts") >= cut).collect()] + [(77, cut, 2)])


def test_latest_per_key(spark):
    rows = [(1, dt.date(2024, 1, d), d % 2 == 0) for d in (3, 1, 2)] + [(2, dt.date(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "account_id long, date date, flag boolean")
    got = {r.account_id: (r.date.day, r.flag) for r in latest_per_key(df, "account_id", "date", ["flag"]).collect()}
    assert got == {1: (3, False), 2: (1, None)}


def test_expand_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, -2), (4, None)], "id long, n int")
    got = expand_rows(df, F.col("n"), "i").collect()
    assert [(r.id, r.i) for r in got] == [(1, 1), (1, 2), (1, 3)]


def test_stable_classes(spark):
    shares = {"a": 20, "b": 80}
    df = spark.range(20_000).select(
        stable_bucket([F.col("id")], 7).alias("bucket"),
        stable_class(shares, [F.col("id")]).alias("kind"),
        stable_pick(["x", "y"], [F.col("id")]).alias("pick"),
    )
    counts = df.agg(
        F.min("bucket"), F.max("bucket"), F.count_if(F.col("kind") == "a"), F.count_if(F.col("pick") == "x")
    ).first()
    assert counts[:2] == (0, 6) and 3800 < counts[2] < 4200 and 9700 < counts[3] < 10300
    with pytest.raises(ValueError):
        stable_class({"a": 50}, [F.col("id")])


def test_json_payload(spark):
    text = spark.range(1).select(json_payload(n=F.col("id"), s=F.lit('q"')).alias("j")).first().j
    assert text == '{"n":0,"s":"q\\""}'
