"""Training and scoring datasets: a spine, chosen features and, for training, a label."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ENTITY, EVENT_DATE, FEATURE_TABLES, KEYS, TABLE_COLUMNS
from tidemark.operators.asof import Dates, exact_join, point_in_time
from tidemark.operators.grid import Axis, observation_grid
from tidemark.operators.windows import attach
from tidemark.plans.catalog import FeatureIndex, FeatureRef
from tidemark.plans.features import (
    ACCOUNT_ATTRIBUTES,
    DERIVED,
    LABEL,
    PURCHASE,
    WINDOW_TABLES,
    WindowTable,
    account_columns,
    build_table,
    daily_of,
    enriched_columns,
)
from tidemark.plans.labels import eligibility_prediction, label_axis, login_labels
from tidemark.sources.tables import Sources

# The features of the churn model, in the order of its dataset.
CHURN_FEATURES = [
    "account_age_days",
    "win_rate_7d",
    "purchases_count_7d",
    "level_ups_7d",
    "current_level",
    "is_clan_member",
    "messages_7d",
    "sessions_7d",
    "avg_session_seconds_7d",
]
LABEL_COLUMN = "did_login_within_7d"


def feature_tables(sources: Sources) -> dict[str, DataFrame]:
    """The eight feature tables, unbuilt; naming their columns runs no job."""
    return {name: build_table(sources, name) for name in FEATURE_TABLES}


def assemble(
    spine: DataFrame,
    features: Sequence[FeatureRef],
    tables: Mapping[str, DataFrame],
    label: str | None = None,
    *,
    max_age_days: int | None = None,
    unique_spine: bool = False,
    dense: bool = False,
    dates: Dates | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """Join features to ``spine`` as of each row's date: keys, features in order, label last.

    Only the tables and columns asked for are read. ``dense`` declares that every feature table
    has a row for every spine key, which allows plain equi joins instead of the as-of join.
    ``dates`` names the dates the spine lies on, if they are known more cheaply than by computing
    it; feature rows that none of them can see are not read. ``unique`` names tables known not to repeat a key.
    """
    keep = [*KEYS, *([label] if label else [])]
    wanted: dict[str, tuple[DataFrame, list[str]]] = {}
    for ref in features:
        wanted.setdefault(ref.table, (tables[ref.table], []))[1].append(ref.name)
    spine = spine.select(*keep)
    if not wanted:
        joined = spine
    elif dense:
        joined = exact_join(spine, wanted, dates)
    else:
        joined = point_in_time(
            spine, wanted, max_age_days=max_age_days, unique_spine=unique_spine, dates=dates, unique=unique
        )
    return joined.select(*KEYS, *[f.name for f in features], *([label] if label else []))


def training_set(
    sources: Sources,
    tables: Mapping[str, DataFrame],
    names: Sequence[str] = CHURN_FEATURES,
    *,
    labels: DataFrame | None = None,
    dense: bool = False,
    dates: Dates | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """Labelled rows with point-in-time features from the given (usually stored) tables.

    ``labels`` is the stored label table if there is one; otherwise it is computed.
    """
    features = FeatureIndex(tables).pick(names)
    axis = label_axis(sources)
    spine = login_labels(sources, axis) if labels is None else labels
    dates = axis.spine if dates is None else dates
    return assemble(
        spine, features, tables, LABEL_COLUMN, unique_spine=True, dense=dense, dates=dates, unique=unique
    )


def prediction_set(
    sources: Sources,
    tables: Mapping[str, DataFrame],
    names: Sequence[str] = CHURN_FEATURES,
    *,
    eligible: DataFrame | None = None,
    dense: bool = False,
    dates: Dates | None = None,
    unique: Collection[str] = (),
) -> DataFrame:
    """The accounts to score with the same features and no label.

    With ``dense`` (true of tables built on the grid) only the newest date of every feature
    table is read. ``eligible`` is the stored eligibility table if there is one; otherwise it is computed.
    """
    features = FeatureIndex(tables).pick(names)
    dates = Axis.latest_of(sources["login"]).spine if dates is None else dates
    spine = eligibility_prediction(sources) if eligible is None else eligible
    return assemble(
        spine, features, tables, unique_spine=True, dense=dense, dates=dates, unique=unique
    )


# --- straight from the logs ---------------------------------------------------------------

_HOME = {
    column.split()[0]: table for table in FEATURE_TABLES for column in TABLE_COLUMNS[table].split(", ")
}


def wide_features(
    sources: Sources, names: Sequence[str], axis: Axis, label: WindowTable | None = None
) -> DataFrame:
    """Features of several tables, and optionally a label, in one pass over the grid.

    The daily partials of all logs involved are merged to one row per account and date, so the
    grid is shuffled (as account rows), sorted and scanned once instead of once per table, and
    no table has to be joined to another. Unused windows are pruned by the optimizer.
    """
    unknown = [n for n in names if n not in _HOME]
    if unknown:
        raise KeyError(f"unknown features {unknown}; known features: {sorted(_HOME)}")
    homes = list(dict.fromkeys("purchase" if _HOME[n] in DERIVED else _HOME[n] for n in names))
    tables = [WINDOW_TABLES[h] for h in homes if h != "account"] + ([label] if label else [])

    grid = observation_grid(sources["account"], axis.spine, keep=ACCOUNT_ATTRIBUTES, colocate=True)
    if tables:
        grid = attach(grid, _merged_partials(tables, sources, axis), [r for t in tables for r in t.rollings])
    columns = dict(account_columns())
    for table in tables:
        columns.update(table.columns(sources[table.log].schema))
    rows = grid.selectExpr(*KEYS, *[f"{c} AS {n}" for n, c in columns.items()])
    if PURCHASE in tables:
        rows = rows.withColumns(enriched_columns(rows.schema))
    picked = list(names) + (list(label.columns(sources[label.log].schema)) if label else [])
    return rows.select(*KEYS, *picked)


def _merged_partials(tables: Sequence[WindowTable], sources: Sources, axis: Axis) -> DataFrame:
    """Daily partials of several logs side by side, one row per account and date.

    Each log was already shuffled by account and date for its own partials, so this merge runs
    where the rows are.
    """
    parts = [daily_of(t, sources, axis) for t in tables]
    if len(parts) == 1:
        return parts[0]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    how = {r.measure: r.how for t in tables for r in t.rollings}
    measures = [c for c in stacked.columns if c not in (ENTITY, EVENT_DATE)]
    # Parts of an exact sum are summed like the measure they belong to.
    return stacked.groupBy(ENTITY, EVENT_DATE).agg(*[getattr(F, how[m.split("__")[0]])(m).alias(m) for m in measures if m.split("__")[0] in how])


def training_set_from_logs(sources: Sources, names: Sequence[str] = CHURN_FEATURES) -> DataFrame:
    """The training set without stored tables. Labelled keys all lie on the grid, so the latest
    feature row at or before each key is the row of that very date."""
    return wide_features(sources, names, label_axis(sources), LABEL)


def prediction_set_from_logs(sources: Sources, names: Sequence[str] = CHURN_FEATURES) -> DataFrame:
    """The scoring set without stored tables: features of the newest date only, so each log is
    read just as far back as its windows reach."""
    axis = Axis.latest_of(sources["login"])
    features = wide_features(sources, names, axis)
    return eligibility_prediction(sources).join(features, KEYS, "left").select(*KEYS, *names)
