"""What a store's tables were built from: per table its dates and the source changes it has taken in.

A manifest is one small JSON file per version; the newest complete file is the current one, so replacing it is
one rename. Changes of source tables are numbered. A table remembers the last change that it reflects; changes that
some table has yet to take in stay listed, whoever else has taken them in already.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from tidemark.sources.files import discard, names_in, read_text, write_text

#: Older versions that are kept beside the current one.
KEPT = 20


@dataclass(frozen=True)
class Change:
    """Rows of a source table changed on some dates, or (``accounts``: a folder of ids) some accounts did."""

    number: int
    source: str
    dates: tuple[dt.date, ...] = ()
    accounts: str | None = None


@dataclass(frozen=True)
class Built:
    """A table's observation dates, the number of the last change it reflects, and how many rows repeat a key, as
    its writes counted them (too many, if such rows were replaced later)."""

    dates: tuple[dt.date, ...]
    seen: int
    repeated: int = 0


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    changed: int = 0
    tables: Mapping[str, Built] = field(default_factory=dict)
    changes: tuple[Change, ...] = ()
    #: Newest date of source tables that appends keep up, and folders of derived state.
    newest: Mapping[str, dt.date] = field(default_factory=dict)
    folders: Mapping[str, str] = field(default_factory=dict)

    def with_changes(self, dates: Mapping[str, Iterable[dt.date]], accounts: str | None = None) -> Manifest:
        """The manifest with further changes listed. Sources without dates are left out."""
        new = [(source, tuple(sorted(set(days)))) for source, days in sorted(dates.items())]
        listed = [Change(self.changed + 1 + i, s, d) for i, (s, d) in enumerate((s, d) for s, d in new if d)]
        if accounts is not None:
            listed.append(Change(self.changed + 1 + len(listed), "account", accounts=accounts))
        return replace(self, changed=self.changed + len(listed), changes=(*self.changes, *listed))

    def with_table(self, name: str, dates: Iterable[dt.date], repeated: int = 0) -> Manifest:
        """The manifest after ``name`` took in everything listed so far; changes that all tables have seen go."""
        tables = {**self.tables, name: Built(tuple(sorted(set(dates))), self.changed, repeated)}
        least = min(t.seen for t in tables.values())
        return replace(self, tables=tables, changes=tuple(c for c in self.changes if c.number > least))

    def pending(self, table: str, source: str | None) -> list[Change]:
        """Changes of ``source`` that ``table`` does not reflect yet."""
        seen = self.tables[table].seen if table in self.tables else 0
        return [c for c in self.changes if c.number > seen and c.source == source]

    # --- storage ----------------------------------------------------------------------------

    def to_json(self) -> str:
        def plain(value):
            if isinstance(value, dt.date):
                return value.isoformat()
            if isinstance(value, (Change, Built)):
                return vars(value)
            raise TypeError(type(value))

        return json.dumps(vars(self), default=plain, indent=1)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        raw = json.loads(text)

        def days(values):
            return tuple(dt.date.fromisoformat(v) for v in values)

        return cls(
            raw["version"], raw["changed"],
            {n: Built(days(t["dates"]), t["seen"], t["repeated"]) for n, t in raw["tables"].items()},
            tuple(Change(c["number"], c["source"], days(c["dates"]), c["accounts"]) for c in raw["changes"]),
            {n: dt.date.fromisoformat(d) for n, d in raw["newest"].items()}, raw["folders"],
        )

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Manifest:
        """The newest version in ``folder``, or an empty manifest."""
        versions = _versions(spark, folder)
        return cls.from_json(read_text(spark, f"{folder}/{versions[-1]}")) if versions else cls()

    def write(self, spark: SparkSession, folder: str) -> Manifest:
        """Store this as the next version, if it is still the successor of the newest one."""
        versions = _versions(spark, folder)
        if versions and int(versions[-1][2:-5]) > self.version:
            raise RuntimeError(f"{folder} has been changed by another run; read it again")
        new = replace(self, version=self.version + 1)
        write_text(spark, f"{folder}/{_name(new.version)}", new.to_json())
        for old in versions[:-KEPT]:
            discard(spark, f"{folder}/{old}")
        return new


def _name(version: int) -> str:
    return f"v-{version:012d}.json"


def _versions(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in names_in(spark, folder) if n.startswith("v-")]
