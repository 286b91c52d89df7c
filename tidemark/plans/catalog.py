"""An index of the features that a set of tables offers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.contracts import KEYS


class FeatureRef(NamedTuple):
    """A feature is a column of a feature table; its name is the column's name."""

    name: str
    table: str
    data_type: T.DataType


class FeatureIndex:
    """All columns of the tables but the keys. Only schemas are read, so no job runs."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._owners: dict[str, list[FeatureRef]] = defaultdict(list)
        for ref in (FeatureRef(f.name, t, f.dataType) for t, df in tables.items() for f in df.schema if f.name not in KEYS):
            self._owners[ref.name].append(ref)
        shared = {name: [r.table for r in refs] for name, refs in self._owners.items() if len(refs) > 1}
        if shared:
            listed = "; ".join(f"{name} in {', '.join(where)}" for name, where in sorted(shared.items()))
            raise ValueError(f"columns of the same name in several tables: {listed}")

    def __iter__(self) -> Iterator[str]:
        return iter(self._owners)

    def __len__(self) -> int:
        return len(self._owners)

    def pick(self, names: Iterable[str]) -> list[FeatureRef]:
        """The named features, in the order asked for."""
        asked = tuple(names)
        if absent := sorted(set(asked).difference(self._owners)):
            raise KeyError(f"no such features: {', '.join(absent)} (there are {', '.join(sorted(self._owners))})")
        return [self._owners[n][0] for n in asked]
