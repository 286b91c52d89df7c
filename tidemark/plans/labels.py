"""The forward-looking label and the set of accounts to score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ENTITY, EVENT_DATE, OBSERVED
from tidemark.operators.grid import Axis, date_spine, latest, observable
from tidemark.plans.features import LABEL, LABEL_DAYS, window_table
from tidemark.sources.tables import Sources

ACTIVE_DAYS = 30


def label_axis(sources: Sources) -> Axis:
    """Dates whose label window is fully observed."""
    return Axis(observable(date_spine(sources["login"]), LABEL_DAYS))


def login_labels(sources: Sources, axis: Axis | None = None) -> DataFrame:
    """Did the account log in on one of the seven dates after the observation date?"""
    return window_table(LABEL, sources, axis or label_axis(sources))


def recent_entities(log: DataFrame, days: int = ACTIVE_DAYS) -> DataFrame:
    """Accounts with an event from ``days`` before the log's newest date through that date.

    The newest date is a scalar subquery inside the filter, so only the partitions of the last
    days are read, and duplicates collapse before the shuffle.
    """
    newest = latest(log, EVENT_DATE)
    recent = log.where((F.col(EVENT_DATE) >= F.date_sub(newest, days)) & (F.col(EVENT_DATE) <= newest))
    return recent.select(ENTITY).distinct().select(ENTITY, newest.alias(OBSERVED))


def eligibility_prediction(sources: Sources) -> DataFrame:
    return recent_entities(sources["login"])
