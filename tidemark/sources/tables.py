"""Reading the source tables and writing date-laid-out parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import (
    CATALOG_NAMES,
    OBSERVED,
    SOURCE_COLUMNS,
    SOURCE_DATE,
    TABLE_COMMENTS,
    column_comment,
    schema_of,
)
from tidemark.sources.files import put_in_place, remove_dates


class Sources(Mapping[str, DataFrame]):
    """The eight source tables by short name, also readable as attributes.

    A table may be given as a function that opens it, called when the table is first used:
    opening a stored table lists its files and reads a footer.
    """

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        missing = sorted(set(SOURCE_COLUMNS) - set(frames))
        if missing:
            raise ValueError(f"missing source tables: {missing}")
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.__dict__.get("_frames", ()):
            raise AttributeError(name)
        return self[name]

    def replace(self, **frames: DataFrame) -> Sources:
        return Sources({**self._frames, **frames})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Sources:
        """One folder per table under ``root``, as ``write_sources`` lays them out."""
        return cls(
            {n: partial(read_table, spark, f"{root}/{n}", ddl) for n, ddl in SOURCE_COLUMNS.items()}
        )

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, schema: str, names: Mapping[str, str] = CATALOG_NAMES
    ) -> Sources:
        """Tables of a catalog schema, under their stored names."""
        return cls({n: partial(spark.table, f"{schema}.{stored}") for n, stored in names.items()})


def read_table(spark: SparkSession, path: str, empty: str | T.StructType | None = None) -> DataFrame:
    """A stored table. A table laid out by date that has no rows has no files and hence no
    schema; ``empty`` is the schema it then gets."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if empty is None or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(empty).parquet(path)


def inline_dates(spark: SparkSession, dates: Iterable[dt.date], column: str) -> DataFrame:
    """A one-column table of the given dates."""
    return spark.createDataFrame([(d,) for d in dates], schema=f"{column} date")


def _writer(df: DataFrame, layout: str | None, mode: str, arranged: bool = False):
    if layout is None:
        return df.write.mode(mode)
    if arranged:  # the rows of a date are together already
        return df.write.mode(mode).partitionBy(layout)
    # REBALANCE puts a date's rows together so each date gets few files, and lets adaptive
    # execution split a date that is larger than the advisory partition size.
    return df.hint("rebalance", layout).write.mode(mode).partitionBy(layout)


def overwrite(df: DataFrame, path: str, layout: str | None = None, arranged: bool = False) -> None:
    """Replace a whole table, its schema included; ``layout`` is the date column to lay out by."""
    _writer(df, layout, "overwrite", arranged).option("partitionOverwriteMode", "static").parquet(path)


def append(df: DataFrame, path: str, layout: str | None = None) -> None:
    """Add rows to a table."""
    _writer(df, layout, "append").parquet(path)


def replace_dates(df: DataFrame, path: str, layout: str, dates: Iterable[dt.date], arranged: bool = False) -> None:
    """Replace every row on ``dates`` by the rows of ``df``, in one write.

    A dynamic partition overwrite only touches partitions that receive rows, so dates for which
    ``df`` brings none are cleared separately. ``df`` must not read ``path`` lazily again after
    this call; stage it first if it does.
    """
    dates = sorted(set(dates))
    if not dates:
        return
    # The dates that received rows are observed during the write: no second pass over ``df``,
    # and at most one value per calendar day reaches the driver.
    seen = Observation()
    kept = df.where(F.col(layout).isin(dates)).observe(seen, F.collect_set(layout).alias("dates"))
    _writer(kept, layout, "overwrite", arranged).option("partitionOverwriteMode", "dynamic").parquet(path)
    written = set(seen.get["dates"])
    clear_dates(df.sparkSession, path, layout, [d for d in dates if d not in written])


def clear_dates(spark: SparkSession, path: str, layout: str, dates: Iterable[dt.date]) -> None:
    """Remove all rows of a date-laid-out table on ``dates``: their folders go, without a job. An interrupted
    removal is completed by the next one."""
    remove_dates(spark, path, layout, dates)


def write_sources(sources: Sources, root: str, at_once: int = 8) -> None:
    """Store all source tables under ``root``, event logs and snapshot laid out by date; ``at_once`` of them side by side."""
    frames = dict(sources.items())
    with ThreadPoolExecutor(at_once) as threads:
        list(threads.map(lambda n: overwrite(frames[n], f"{root}/{n}", SOURCE_DATE.get(n)), frames))


def save_table(df: DataFrame, name: str, layout: str | None = None) -> None:
    """Replace a catalog table, its schema included."""
    _writer(df, layout, "overwrite").option("partitionOverwriteMode", "static").saveAsTable(name)


def save_dataset(df: DataFrame, target: str) -> None:
    """Replace a dataset, its columns included. ``target`` is a folder (it has a slash) or a name in the catalog.

    A folder is written beside and put in place of the old one, so that ``df`` may read the dataset that it replaces.
    """
    if "/" not in target:
        save_table(df, target)
        return
    spark, draft = df.sparkSession, f"{target.rstrip('/')}.{uuid4().hex}"
    overwrite(df, draft)
    put_in_place(spark, draft, target)


def declare_table(spark: SparkSession, name: str, table: str, location: str) -> None:
    """A catalog entry for a stored feature table under its contract: columns in order, types, comments.

    The rows stay where they are; the entry is replaced, so a changed contract takes effect. Spark's file tables drop
    the NOT NULL of a declaration; a strict store refuses such rows when it writes.
    """
    fields = schema_of(table).fields
    columns = [
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'} COMMENT '{_quoted(column_comment(table, f.name))}'"
        for f in fields
    ]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet PARTITIONED BY ({OBSERVED}) "
        f"LOCATION '{_quoted(location)}' COMMENT '{_quoted(TABLE_COMMENTS[table])}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def append_table(df: DataFrame, name: str, layout: str | None = None) -> None:
    """Add rows to a catalog table."""
    _writer(df, layout, "append").saveAsTable(name)
