"""Files beside the tables: staging folders, partition folders by name, small text files.

Everything goes through the file system that a path belongs to, so it works wherever Spark reads and writes.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, under the checkpoint folder the session names.

    Where none is named, the session's warehouse folder, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder; nothing happens if it is not there."""
    system, where = _located(spark, path)
    system.delete(where, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if the folder is missing."""
    system, where = _located(spark, folder)
    if not system.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(where))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written under another name and renamed."""
    system, where = _located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_draft-{uuid4().hex}")
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not system.rename(draft, where):
        system.delete(draft, False)
        raise FileExistsError(f"{path} could not be put in place")


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _located(spark, path)
    source = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def put_in_place(spark: SparkSession, draft: str, path: str) -> None:
    """Move a finished folder to ``path``; what was there is deleted first."""
    system, where = _located(spark, path)
    system.delete(where, True)
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), where):
        raise FileExistsError(f"{path} could not be put in place; the rows are in {draft}")


# --- tables laid out by date ----------------------------------------------------------------

_TOMBSTONES = "_tombstones-"


def stored_dates(spark: SparkSession, path: str, layout: str) -> list[dt.date]:
    """The dates a table laid out by ``layout`` has folders for, from one listing: no job, no footers.

    Writes leave no folder without rows and ``remove_dates`` deletes folders, so these are the dates with rows.
    """
    sign = f"{layout}="
    found = [n[len(sign):] for n in names_in(spark, path) if n.startswith(sign)]
    return sorted(dt.date.fromisoformat(d) for d in found if d != "__HIVE_DEFAULT_PARTITION__")


def remove_dates(spark: SparkSession, path: str, layout: str, dates: Iterable[dt.date]) -> None:
    """Delete the folders of ``dates``. No job runs, however many there are.

    The list of dates is stored first, under a name that readers skip. If the run ends before all of them are gone, the
    next call on the table, or ``finish_removals``, deletes the rest.
    """
    finish_removals(spark, path)
    doomed = sorted(set(dates) & set(stored_dates(spark, path, layout)))
    if not doomed:
        return
    note = f"{path}/{_TOMBSTONES}{uuid4().hex}"
    write_text(spark, note, json.dumps([f"{layout}={d.isoformat()}" for d in doomed]))
    _delete_listed(spark, path, note)


def finish_removals(spark: SparkSession, path: str) -> None:
    """Complete removals that were begun and not ended."""
    for name in names_in(spark, path):
        if name.startswith(_TOMBSTONES):
            _delete_listed(spark, path, f"{path}/{name}")


def _delete_listed(spark: SparkSession, path: str, note: str) -> None:
    for folder in json.loads(read_text(spark, note)):
        discard(spark, f"{path}/{folder}")
    discard(spark, note)
