"""Properties of the physical plans that matter at scale."""

import re

import pytest
from handmade import sources

from tidemark.maintain import FeatureStore
from tidemark.operators.grid import Axis
from tidemark.plans.datasets import training_set_from_logs
from tidemark.plans.features import build_table
from tidemark.plans.labels import eligibility_prediction
from tidemark.sources import roles as role
from tidemark.sources.roles import role_sources
from tidemark.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(text: str, operator: str) -> int:
    return len(re.findall(rf"[-: ]{operator}\b", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = FeatureStore(spark, str(tmp_path_factory.mktemp("plans")))
    store.load(
        sources(
            spark,
            account=[(a, 0) for a in range(5)],
            login=[(a % 5, a) for a in range(40)],
            battle=[(a % 5, a, 1, 60) for a in range(40)],
        )
    )
    store.publish(["account", "battle", "label_login_7d"])
    return store


@pytest.mark.parametrize("name", ["battle", "purchase", "social", "session", "label_login_7d"])
def test_window_tables_shuffle_accounts_and_partials_only(spark, name):
    text = plan(build_table(role_sources(spark, SF_DIR), name))
    # One shuffle of account rows, one of raw partials by account and date, one of daily rows by
    # account; the grid itself goes from its expansion to the window without any.
    assert text.count("REPARTITION_BY_NUM") == 2
    assert count(text, "Window") == 1 and count(text, "Sort") == 1
    union_to_window = text[text.index("Window ["):text.index("Union")]
    assert "Exchange" not in union_to_window


def test_training_set_is_one_window_pass(spark):
    s = role_sources(spark, SF_DIR)
    # The role view of the level log numbers its rows itself; a stored log has its levels.
    levels = role.level_ups(spark, SF_DIR).selectExpr("*", "2 AS new_level")
    s = s.replace(progression=levels)
    text = plan(training_set_from_logs(s))
    grid_windows = [w for w in re.findall(r"Window \[.*", text) if "RangeFrame" in w]
    assert len(grid_windows) == 1
    assert "Python" not in text and "CartesianProduct" not in text
    assert not re.search(r"SortMergeJoin|ShuffledHashJoin", text)


@pytest.mark.parametrize("name", ["trailing_range_join", "trailing_range_join_90d", "forward_range_join"])
def test_exploded_events_are_not_broadcast(spark, name):
    # The log itself is far below the size that Spark broadcasts; what follows it has a row per event and day.
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "BroadcastHashJoin [account_id" not in text
    assert count(text, "SortMergeJoin") == 2 and count(text, "BroadcastNestedLoopJoin") >= 2


def test_only_the_spine_is_broadcast_to_the_grid(spark):
    text = plan(build_table(role_sources(spark, SF_DIR), "battle"))
    assert count(text, "BroadcastNestedLoopJoin") == 1
    assert "HashAggregate(keys=[observation_date" in text[text.index("BroadcastExchange"):]


def test_slices_prune_partitions_and_columns(spark, stored):
    s = stored.sources()
    days = [r[0] for r in s["login"].select("event_date").distinct().orderBy("event_date").collect()]
    text = plan(build_table(s, "battle", Axis.of_days(spark, days[-1:])))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "sources/battle" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", scan)
    assert "ReadSchema: struct<account_id:bigint,won:int,duration_seconds:int>" in scan


def test_eligibility_reads_recent_partitions(stored):
    text = plan(eligibility_prediction(stored.sources()))
    assert re.search(r"PartitionFilters: \[[^\]]*(subquery|Subquery)", text)


def test_scoring_reads_the_newest_partition(stored):
    stored.publish()
    text = plan(stored.prediction_set(["win_rate_7d"]))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "features/battle" in line)
    filters = scan[scan.index("PartitionFilters:"):scan.index("PushedFilters:")]
    # A literal bound prunes while planning; a subquery would only do so at run time.
    assert re.search(r"observation_date#\d+ <= \d{4}-\d\d-\d\d", filters), scan
    assert "ReadSchema: struct<account_id:bigint,win_rate_7d:double>" in scan
