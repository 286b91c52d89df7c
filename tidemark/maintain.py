"""Keeping stored tables current: append a day, restate dates, refresh the affected slice."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import (
    ENTITY,
    EVENT_DATE,
    FEATURE_TABLES,
    LOG_TIMESTAMP,
    OBSERVED,
    SOURCE_COLUMNS,
    SOURCE_DATE,
    required,
    schema_of,
)
from tidemark.manifest import Manifest
from tidemark.operators.grid import Axis
from tidemark.operators.sequence import attach_state, latest_per_key
from tidemark.operators.windows import reach
from tidemark.plans.datasets import CHURN_FEATURES, prediction_set, training_set
from tidemark.plans.catalog import FeatureIndex
from tidemark.plans.features import (
    DERIVED,
    DERIVED_REACH,
    WINDOW_TABLES,
    Carry,
    build_table,
    enriched_with_parts,
    is_exact,
)
from tidemark.plans.labels import ACTIVE_DAYS, LABEL_DAYS, eligibility_prediction
from tidemark.quality import REPORT_SCHEMA, UNIQUE_CHECK, Counted, write_checked
from tidemark.sources.files import discard, names_in, shared_folder, stored_dates
from tidemark.sources.tables import (
    Sources,
    append,
    clear_dates,
    declare_table,
    inline_dates,
    overwrite,
    read_table,
    replace_dates,
    save_dataset,
    write_sources,
)

DAY = dt.timedelta(days=1)


# --- dates ------------------------------------------------------------------------------


def date_bounds(log: DataFrame, column: str) -> DataFrame:
    """First and last date of a log, one row."""
    day = F.col(column).cast("date")
    return log.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def _one_row(df: DataFrame, what: str) -> list[dt.date]:
    """The dates of a one-row frame; an error if the log they come from has no dated rows."""
    values = list(df.first())
    if None in values:
        raise RuntimeError(f"no dated rows to derive {what} from")
    return values


def next_batch_date(log: DataFrame, column: str = "login_ts") -> dt.date:
    """The day after the log's newest event."""
    after = date_bounds(log, column).select(F.date_add("last_date", 1))
    return _one_row(after, "the next batch date")[0]


def restatement_dates(log: DataFrame, column: str = "login_ts", shares=(0.25, 0.5, 0.75)) -> list[dt.date]:
    """Dates at the given shares of the log's span, truncated to whole days."""
    span = F.datediff("last_date", "first_date")
    at = [F.date_add("first_date", F.floor(span * F.lit(share)).cast("int")) for share in shares]
    return _one_row(date_bounds(log, column).select(*at), "restatement dates")


def rows_by_table_and_date(logs: Mapping[str, DataFrame], dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Row count of every log on every date (or on the given ones), as one job."""
    days = None if dates is None else sorted(set(dates))
    parts = []
    for name, log in logs.items():
        day = SOURCE_DATE.get(name, EVENT_DATE)
        rows = log if days is None else log.where(F.col(day).isin(days))
        parts.append(
            rows.groupBy(F.col(day).alias(EVENT_DATE))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), EVENT_DATE, "row_count")
        )
    return reduce(DataFrame.unionAll, parts)


# --- batches ----------------------------------------------------------------------------


def absent_dates(batch: DataFrame, stored: DataFrame, column: str = EVENT_DATE) -> DataFrame:
    """Rows of ``batch`` on dates that ``stored`` does not have yet.

    The stored dates are broadcast: one row per calendar day at most.
    """
    present = stored.select(column).distinct()
    return batch.join(F.broadcast(present), column, "left_anti").select(*batch.columns)


def with_appended(stored: DataFrame, batch: DataFrame, column: str = EVENT_DATE) -> DataFrame:
    """The log after appending ``batch``; dates already present are left alone."""
    return stored.unionByName(absent_dates(batch, stored, column))


def with_restated(
    stored: DataFrame, replacement: DataFrame, dates: Iterable[dt.date], column: str = EVENT_DATE
) -> DataFrame:
    """The log after replacing all rows on ``dates``."""
    days = sorted(set(dates))
    kept = stored.where(~F.coalesce(F.col(column).isin(days), F.lit(False)))
    return kept.unionByName(replacement.where(F.col(column).isin(days)))


def append_batch(batch: DataFrame, path: str, column: str = EVENT_DATE) -> int:
    """Append the rows of ``batch`` on dates the table does not have. Running it again adds nothing.

    Returns how many rows were left out because their date is already stored.
    """
    days = [r[0] for r in batch.select(column).distinct().toLocalIterator()]  # one per calendar day
    stored = read_table(batch.sparkSession, path).where(F.col(column).isin(days))
    present = [r[0] for r in stored.select(column).distinct().toLocalIterator()]
    late = F.coalesce(F.col(column).isin(present), F.lit(False))
    skipped = batch.where(late).count()
    append(batch.where(~late), path, column)
    return skipped


def append_day(root: str, batches: Mapping[str, DataFrame], day: dt.date) -> None:
    """Add one day to several stored logs.

    Each table replaces its partition of that day and the login log, from which the next day is
    derived, goes last. A run that fails midway is simply repeated: it works on the same day.
    """
    for name in sorted(batches, key=lambda n: n == "login"):
        replace_dates(batches[name], f"{root}/{name}", SOURCE_DATE[name], [day])


def restate_dates(root: str, replacements: Mapping[str, DataFrame], dates: Iterable[dt.date]) -> None:
    """Replace all rows of ``dates`` in each stored log; snapshots are not touched.

    Replacements are first written to a staging table, since they may be derived from the very
    log that is overwritten.
    """
    days = sorted(set(dates))
    for name, df in replacements.items():
        if name not in LOG_TIMESTAMP:
            raise ValueError(f"{name} is not an event log")
        spark = df.sparkSession
        staged = shared_folder(spark, f"restate-{name}")
        overwrite(df.where(F.col(EVENT_DATE).isin(days)), staged)
        replace_dates(read_table(spark, staged), f"{root}/{name}", EVENT_DATE, days)
        discard(spark, staged)


def carry_forward_snapshot(snapshot: DataFrame, accounts: DataFrame, day: dt.date) -> DataFrame:
    """The snapshot of a new day: each account's last known value, FALSE if there is none."""
    known = latest_per_key(snapshot, ENTITY, "date", ["is_clan_member"])
    existing = accounts.where(F.col("created_at") <= F.lit(day)).select(ENTITY)
    return attach_state(existing, known, ENTITY, "is_clan_member", False).select(
        ENTITY, F.lit(day).alias("date"), "is_clan_member"
    )


# --- stored features ----------------------------------------------------------------------

# Tables published for use, and the log each is computed from. The label follows the login log.
PUBLISHED = {
    "account": None,
    "battle": "battle",
    "purchase": "purchase",
    "progression": "progression",
    "social": "social",
    "social_enriched": "membership",
    "session": "session",
    "purchase_enriched": "purchase",
    "label_login_7d": "login",
}


def table_reach(table: str) -> tuple[int | None, int]:
    """Day offsets from the observation date that a table's columns depend on."""
    if table in DERIVED:
        return DERIVED_REACH
    return reach(WINDOW_TABLES[table].rollings)


def affected_dates(table: str, changed: Iterable[dt.date], spine: Iterable[dt.date]) -> set[dt.date]:
    """Spine dates whose rows in ``table`` can differ after its log changed on ``changed``.

    An observation date sees an event through offsets ``first .. last``; turned around, an event
    on date E reaches the observation dates ``E - last .. E - first``.
    """
    changed = sorted(set(changed))
    if not changed or PUBLISHED.get(table, table) is None:
        return set()
    first, last = table_reach(table)
    hit: set[dt.date] = set()
    for day in spine:
        # The window [day + first, day + last] must contain a changed date.
        at = 0 if first is None else bisect_left(changed, day + first * DAY)
        if at < len(changed) and changed[at] <= day + last * DAY:
            hit.add(day)
    return hit


#: Accounts that one task of a write holds on one date.
ACCOUNTS_A_TASK = 2_000_000
# What a publishing run counted, as kept in the store.
LOG_COLUMNS = "run STRING, version INT, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REPORT_SCHEMA)


class Done(dict):
    """Observation dates rewritten per table, and what the checks of those writes counted."""

    def __init__(self):
        super().__init__()
        self.checks: list[Counted] = []


class FeatureStore:
    """Source and feature tables under one folder, laid out by date.

    ``sources/<name>`` holds the source tables, ``features/<name>`` the published ones, ``manifest`` what each of them was
    built from, ``quality`` the counts of every write's checks and ``state`` small tables that appends keep
    up, so that daily jobs need no history. One run at a time may change a store; a second one that does is refused when
    it stores its manifest. Source tables are changed through the store (``append_day``, ``restate_dates``) or, if changed
    otherwise, by naming the dates or accounts to ``refresh``.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, strict: bool = False):
        """``buckets`` sets in how many parts a date is written; ``strict`` refuses rows without a key instead of
        counting them."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.source_root = f"{self.root}/sources"
        self._buckets = buckets
        self.strict = strict

    # --- reading ----------------------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/features/{table}"

    @property
    def manifest(self) -> Manifest:
        return Manifest.read(self.spark, f"{self.root}/manifest")

    def _commit(self, manifest: Manifest) -> Manifest:
        return manifest.write(self.spark, f"{self.root}/manifest")

    def sources(self) -> Sources:
        return Sources.from_parquet(self.spark, self.source_root)

    def table(self, name: str) -> DataFrame:
        if name == "purchase":
            # Its files say whether the spend columns are exact, and to how many places.
            return read_table(self.spark, self.path(name), schema_of(name))
        if name in PUBLISHED:
            return self.spark.read.schema(schema_of(name)).parquet(self.path(name))
        return read_table(self.spark, self.path(name))

    def tables(self) -> dict[str, DataFrame]:
        """The feature tables that have been published."""
        published = self.manifest.tables
        return {name: self.table(name) for name in FEATURE_TABLES if name in published}

    def quality_log(self) -> DataFrame:
        """One row per run, table and check: what each write counted."""
        return self.spark.read.schema(LOG_COLUMNS).parquet(f"{self.root}/quality")

    def _unique(self, manifest: Manifest) -> list[str]:
        """Tables whose writes saw no key twice."""
        return [name for name, built in manifest.tables.items() if not built.repeated]

    def training_set(self, names: Sequence[str] = CHURN_FEATURES, dense: bool = True) -> DataFrame:
        """The training set from the stored tables. They share the label's grid, so equi joins do (``dense``); the
        general as-of join gives the same rows.

        It is an error if a table in use lacks a date of the label or has changes to take in there.
        """
        manifest, tables = self.manifest, self.tables()
        labels = manifest.tables["label_login_7d"].dates
        self._require(manifest, ["label_login_7d", *self._homes(tables, names)], labels)
        dates = (labels[0], labels[-1]) if labels else None
        return training_set(
            self.sources(), tables, names, labels=self.table("label_login_7d"), dense=dense, dates=dates,
            unique=self._unique(manifest),
        )

    def prediction_set(self, names: Sequence[str] = CHURN_FEATURES, dense: bool = True) -> DataFrame:
        """The scoring set from the stored tables, reading one date of each.

        It is an error if a table in use, or the list of accounts to score, was not built for the newest login
        date or has changes to take in there: other tables may be in any state.
        """
        manifest, tables = self.manifest, self.tables()
        newest = self._spine()[-1:]
        used = self._homes(tables, names)
        self._require(manifest, [*used, "eligibility_prediction"], newest)
        dates = (newest[0], newest[0]) if newest else None
        eligible = self.table("eligibility_prediction")
        return prediction_set(
            self.sources(), tables, names, eligible=eligible, dense=dense, dates=dates, unique=self._unique(manifest)
        )

    @staticmethod
    def _homes(tables: Mapping[str, DataFrame], names: Sequence[str]) -> list[str]:
        return list(dict.fromkeys(ref.table for ref in FeatureIndex(tables).pick(names)))

    def _require(self, manifest: Manifest, names: Iterable[str], dates: Sequence[dt.date]) -> None:
        """An error naming the tables that do not say the truth about ``dates``."""
        behind = [n for n in names if self._behind(manifest, n, dates)]
        if behind:
            raise RuntimeError(f"{', '.join(behind)} not current for {dates[-1]}; call refresh first")

    def _behind(self, manifest: Manifest, name: str, dates: Sequence[dt.date]) -> bool:
        built = manifest.tables.get(name)
        if not dates:
            return False
        if built is None or not set(dates) <= set(built.dates) or manifest.pending(name, "account"):
            return True
        if name == "eligibility_prediction":
            return any(d >= built.dates[-1] - ACTIVE_DAYS * DAY for c in manifest.pending(name, "login") for d in c.dates)
        touched = [d for c in manifest.pending(name, PUBLISHED[name]) for d in c.dates]
        return bool(affected_dates(name, touched, dates))

    def _spine(self) -> list[dt.date]:
        """The dates of the login log: its folders, at most one per calendar day. No job, no footers."""
        return stored_dates(self.spark, f"{self.source_root}/login", EVENT_DATE)

    # --- source tables ----------------------------------------------------------------------

    def load(self, sources: Sources) -> None:
        """Store the source tables. Whatever had been published before counts as never built."""
        write_sources(sources, self.source_root)
        folder = self._stored_state(self.sources()["membership"])
        newest = {name: d[-1] for name in SOURCE_DATE if (d := stored_dates(self.spark, f"{self.source_root}/{name}", SOURCE_DATE[name]))}
        before = self.manifest
        self._commit(Manifest(before.version, before.changed, newest=newest, folders={"membership": folder}))
        self._discard_state(before, {"membership": folder})

    def append_day(self, batches: Mapping[str, DataFrame], day: dt.date) -> None:
        """Add one day to the stored logs and remember it for the next ``refresh``.

        The change is listed before the rows are written: a run that fails midway can be repeated, and a refresh in between
        recomputes something in vain at worst. Derived state follows last.
        """
        manifest = self._commit(self.manifest.with_changes({name: [day] for name in batches}))
        append_day(self.source_root, batches, day)
        newest = {**manifest.newest, **{n: max(day, manifest.newest.get(n, day)) for n in batches}}
        folders = dict(manifest.folders)
        if "membership" in batches:
            new = read_table(self.spark, f"{self.source_root}/membership", SOURCE_COLUMNS["membership"])
            both = self._state(manifest, "membership").unionByName(
                new.where(F.col("date") == F.lit(day)).select(ENTITY, "date", "is_clan_member")
            )
            folders["membership"] = self._stored_state(both)
        self._commit(replace(manifest, newest=newest, folders=folders))
        self._discard_state(manifest, folders)

    def restate_dates(self, replacements: Mapping[str, DataFrame], dates: Iterable[dt.date]) -> None:
        """Replace all rows of ``dates`` in each stored log and remember them for the next ``refresh``."""
        days = sorted(set(dates))
        manifest = self._commit(self.manifest.with_changes(dict.fromkeys(replacements, days)))
        restate_dates(self.source_root, replacements, days)
        newest = dict(manifest.newest)
        for name in replacements:  # its last date may be new, or gone
            newest.pop(name, None)
            if left := stored_dates(self.spark, f"{self.source_root}/{name}", SOURCE_DATE[name]):
                newest[name] = left[-1]
        self._commit(replace(manifest, newest=newest))

    def next_day(self) -> dt.date:
        """The day after the newest login date, from the manifest: nothing is read."""
        if "login" not in (newest := self.manifest.newest):
            raise RuntimeError("no dated rows to derive the next batch date from")
        return newest["login"] + DAY

    def carried_snapshot(self, day: dt.date) -> DataFrame:
        """The snapshot of a new day from each account's last known value, which appends keep: no history is read."""
        return carry_forward_snapshot(self._state(self.manifest, "membership"), self.sources()["account"], day)

    def _state(self, manifest: Manifest, name: str) -> DataFrame:
        return self.spark.read.schema("account_id BIGINT, date DATE, is_clan_member BOOLEAN").parquet(manifest.folders[name])

    def _stored_state(self, snapshot: DataFrame) -> str:
        """Each account's last value, in a folder of its own."""
        folder = f"{self.root}/state/membership-{uuid4().hex}"
        latest = latest_per_key(snapshot.where(F.col("date").isNotNull()), ENTITY, "date", ["is_clan_member"])
        overwrite(latest.select(ENTITY, "date", "is_clan_member"), folder)
        return folder

    def _discard_state(self, before: Manifest, folders: Mapping[str, str]) -> None:
        """Delete state that is neither current nor the one before, which plans made earlier may still read."""
        keep = {f.rsplit("/", 1)[-1] for f in [*folders.values(), *before.folders.values()]}
        for name in set(names_in(self.spark, f"{self.root}/state")) - keep:
            discard(self.spark, f"{self.root}/state/{name}")

    # --- published tables -------------------------------------------------------------------

    @property
    def buckets(self) -> int:
        """Parts that the accounts of one date are written in."""
        if self._buckets is None:
            self._buckets = max(1, -(-self.sources()["account"].count() // ACCOUNTS_A_TASK))
        return self._buckets

    def publish(self, names: Iterable[str] = tuple(PUBLISHED), at_once: int = 8) -> list[Counted]:
        """Build and store the named tables over the whole spine. Returns, and keeps, what their checks counted.

        ``at_once`` tables are built side by side, so that the end of one write leaves no cores idle. The enriched
        purchase table is a projection of the purchase table's rows and is read from there if both are published.
        """
        names = self._check(names)
        sources, spine, manifest = self.sources(), self._spine(), self.manifest
        _ = self.buckets  # counted once, before there are threads
        later = [n for n in names if n == "purchase_enriched" and "purchase" in names]
        counted: list[Counted] = []
        with ThreadPoolExecutor(max(1, at_once)) as threads:
            for wave in ([n for n in names if n not in later], later):
                # The widest table first: it takes longest.
                order = sorted(wave, key=lambda n: n != "purchase")
                for name, new in zip(order, threads.map(lambda n: self._whole(sources, n, bool(later)), order), strict=True):
                    manifest = self._commit(manifest.with_table(name, self._dates_of(name, spine), _repeated(name, new)))
                    counted += new
        manifest = self._lists(sources, spine, manifest)
        self._log(manifest, counted)
        return counted

    @staticmethod
    def _check(names: Iterable[str]) -> list[str]:
        names = list(dict.fromkeys(names))
        unknown = sorted(set(names) - set(PUBLISHED))
        if unknown:
            raise KeyError(f"unknown tables {unknown}; known tables: {sorted(PUBLISHED)}")
        return names

    @staticmethod
    def _dates_of(name: str, spine: Sequence[dt.date]) -> list[dt.date]:
        return _observable(spine) if name == "label_login_7d" else list(spine)

    def _whole(self, sources: Sources, name: str, from_stored: bool = False) -> list[Counted]:
        """A table over the whole spine; ``from_stored``: the enriched purchases from the stored ones, where those are exact."""
        rows, also = self._built(sources, name)
        if from_stored and name == "purchase_enriched" and is_exact(self.table("purchase")):
            rows = enriched_with_parts(sources, purchase=self.table("purchase"))
        return self._written(rows, name, also=also)

    def _written(self, rows: DataFrame, name: str, dates: Iterable[dt.date] | None = None, also: Sequence[str] = ()) -> list[Counted]:
        rows = required(rows) if self.strict else rows
        return write_checked(rows, name, self.path(name), dates=dates, buckets=self.buckets, also=also)

    @staticmethod
    def _built(sources: Sources, name: str, axis: Axis | None = None, carry: Carry | None = None):
        """A table's rows, and the names of tables that are functions of the same row and checked with it."""
        if name == "purchase_enriched":
            return enriched_with_parts(sources, axis), ("spender_tier", "purchase_velocity")
        return build_table(sources, name, axis, carry), ()

    def register(self, schema: str) -> list[str]:
        """Make the published tables known in a catalog schema, with their contracts. Returns their names.

        The entries point at the store's folders and list the dates that these have now; call it again after later writes.
        """
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        names = [n for n in PUBLISHED if n in self.manifest.tables]
        for name in names:
            declare_table(self.spark, f"{schema}.{name}", name, self.path(name))
        return [f"{schema}.{n}" for n in names]

    def save_training_set(self, target: str, names: Sequence[str] = CHURN_FEATURES) -> None:
        """Store the training set in a folder or under a catalog name, replacing what was there."""
        save_dataset(self.training_set(names), target)

    def save_prediction_set(self, target: str, names: Sequence[str] = CHURN_FEATURES) -> None:
        """Store the scoring set in a folder or under a catalog name, replacing what was there."""
        save_dataset(self.prediction_set(names), target)

    def _lists(self, sources: Sources, spine: Sequence[dt.date], manifest: Manifest) -> Manifest:
        """Store the accounts to score and the spine."""
        overwrite(eligibility_prediction(sources), self.path("eligibility_prediction"))
        overwrite(inline_dates(self.spark, spine, OBSERVED), self.path("date_spine"))
        return self._commit(manifest.with_table("eligibility_prediction", spine[-1:]).with_table("date_spine", spine))

    def _log(self, manifest: Manifest, counted: Sequence[Counted]) -> None:
        if counted:
            run = uuid4().hex
            rows = [(run, manifest.version, *c) for c in counted]
            append(self.spark.createDataFrame(rows, LOG_COLUMNS).coalesce(1), f"{self.root}/quality")

    def refresh(
        self,
        changed: Mapping[str, Iterable[dt.date]] | None = None,
        accounts_changed: bool = False,
        names: Iterable[str] = tuple(PUBLISHED),
        accounts: DataFrame | Iterable[int] | None = None,
    ) -> Done:
        """Recompute only what changes of the source tables can affect.

        ``changed`` maps source tables to dates on which they gained, lost or changed rows, in addition to those that the
        store knows of; ``accounts`` are the ids of new, changed or removed accounts. Both stay listed until each table
        has taken them in, so refreshing some tables now and the others later, in any order, ends in the same tables as
        refreshing all at once. ``accounts_changed`` rebuilds the named tables whole. Returns the
        observation dates rewritten per table, and the counts of the checks; nothing is written where nothing changed.
        Every table is entered in the manifest after it has been written: a run that fails midway can be repeated.
        """
        names = self._check(names)
        if strange := sorted(set(changed or ()) - set(SOURCE_DATE)):
            raise KeyError(f"not dated source tables: {strange}; known ones: {sorted(SOURCE_DATE)}")
        manifest = self.manifest
        if changed or accounts is not None:
            listed = None if accounts is None else self._stored_ids(accounts)
            manifest = self._commit(manifest.with_changes(changed or {}, listed))
        sources, spine = self.sources(), self._spine()
        done, stored_as = Done(), manifest
        for name in names:
            already = len(done.checks)
            rewritten = self._refresh_table(manifest, name, sources, spine, accounts_changed, done)
            repeated = _repeated(name, done.checks[already:])
            if name in manifest.tables and not accounts_changed:  # rows that were not rewritten may repeat keys as well
                repeated += manifest.tables[name].repeated
            manifest = manifest.with_table(name, self._dates_of(name, spine), repeated)
            if rewritten:
                done[name] = sorted(rewritten)
                manifest = stored_as = self._commit(manifest)
        if self._behind(manifest, "eligibility_prediction", spine[-1:]):
            overwrite(eligibility_prediction(sources), self.path("eligibility_prediction"))
            done["eligibility_prediction"] = spine[-1:]
        before = manifest.tables["date_spine"].dates if "date_spine" in manifest.tables else ()
        if set(before) != set(spine):
            overwrite(inline_dates(self.spark, spine, OBSERVED), self.path("date_spine"))
            done["date_spine"] = sorted(set(before) ^ set(spine))
        manifest = manifest.with_table("eligibility_prediction", spine[-1:]).with_table("date_spine", spine)
        if manifest != stored_as:
            manifest = self._commit(manifest)
        self._drop_ids(manifest)
        self._log(manifest, done.checks)
        return done

    def _refresh_table(
        self, manifest: Manifest, name: str, sources: Sources, spine: Sequence[dt.date], whole: bool, done: Done
    ) -> set[dt.date]:
        """Bring one table up to date; gives the dates that were rewritten."""
        new = self._dates_of(name, spine)
        if whole or name not in manifest.tables:
            done.checks += self._whole(sources, name)
            return set(new)
        old = manifest.tables[name].dates
        touched = [d for c in manifest.pending(name, PUBLISHED[name]) for d in c.dates]
        days = set(new) - set(old) | affected_dates(name, touched, new)
        people = [c.accounts for c in manifest.pending(name, "account")]
        if days:
            carry = None if people else self._carry(name, old, new, days)
            rows, also = self._built(sources, name, Axis.of_days(self.spark, days), carry)
            done.checks += self._written(rows, name, days, also)
        merged = self._merge_accounts(name, sources, people, sorted(set(new) - days), done) if people else set()
        gone = set(old) - set(new)
        clear_dates(self.spark, self.path(name), OBSERVED, gone)
        return days | merged | gone

    def _carry(self, name: str, old: Sequence[dt.date], new: Sequence[dt.date], days: set[dt.date]) -> Carry | None:
        """The table's own rows on the date before a slice. Everything affected lies in the slice, so they are right."""
        if name not in WINDOW_TABLES or not WINDOW_TABLES[name].state:
            return None
        earlier = [d for d in set(old) & set(new) if d < min(days)]
        if not earlier:
            return None
        return Carry(max(earlier), self.table(name).where(F.col(OBSERVED) == F.lit(max(earlier))))

    def _stored_ids(self, accounts: DataFrame | Iterable[int]) -> str:
        if not isinstance(accounts, DataFrame):
            accounts = self.spark.createDataFrame([(a,) for a in accounts], f"{ENTITY} long")
        folder = f"{self.root}/changes/accounts-{uuid4().hex}"
        overwrite(accounts.select(F.col(ENTITY).cast("long").alias(ENTITY)).where(F.col(ENTITY).isNotNull()).distinct(), folder)
        return folder

    def _drop_ids(self, manifest: Manifest) -> None:
        """Delete lists of accounts that every table has taken in."""
        wanted = {c.accounts for c in manifest.changes}
        for name in names_in(self.spark, f"{self.root}/changes"):
            if (folder := f"{self.root}/changes/{name}") not in wanted:
                discard(self.spark, folder)

    def _merge_accounts(
        self, name: str, sources: Sources, folders: Sequence[str], dates: Sequence[dt.date], done: Done
    ) -> set[dt.date]:
        """Replace the rows of some accounts on the dates that they are, or were, observed on."""
        ids = self.spark.read.schema(f"{ENTITY} long").parquet(*folders).distinct()
        some = Sources({n: df.join(ids, ENTITY, "left_semi").select(*df.columns) for n, df in sources.items()})
        stored = self.table(name)
        created = some["account"].agg(F.min("created_at")).first()[0]
        seen = stored.join(ids, ENTITY, "left_semi").agg(F.min(OBSERVED)).first()[0]
        days = [d for d in dates if any(first is not None and d >= first for first in (created, seen))]
        if not days:
            return set()
        on_days = F.col(OBSERVED).between(F.lit(days[0]), F.lit(days[-1])) & F.col(OBSERVED).isin(days)
        kept = stored.where(on_days).join(ids, ENTITY, "left_anti").select(*stored.columns)
        both = kept.unionByName(build_table(some, name, Axis.of_days(self.spark, days)))
        # The rows to keep come from the very folders that are replaced.
        staged = shared_folder(self.spark, f"merge-{name}")
        overwrite(both, staged)
        table = self.spark.read.schema(both.schema).parquet(staged)
        done.checks += self._written(table, name, days)
        discard(self.spark, staged)
        return set(days)


def _repeated(name: str, counted: Iterable[Counted]) -> int:
    return sum(c.violations for c in counted if (c.table_name, c.check_name) == (name, UNIQUE_CHECK))


def _observable(spine: Sequence[dt.date]) -> list[dt.date]:
    return [d for d in spine if d <= spine[-1] - LABEL_DAYS * DAY]
