"""Row numbering, latest state and row expansion, safe for keys that hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import shared_folder
from tidemark.sources.tables import overwrite

_CHUNK = 100_000


def running_number(
    df: DataFrame, key: str, order: str, name: str, bucket_seconds: int = 60, spread: str = "minute"
) -> DataFrame:
    """Number each key's rows 1, 2, 3, ... by the timestamp ``order``, into a BIGINT column.

    A plain window would sort all rows of a key in one task. Here a row's number is the count of
    the key's rows in earlier buckets plus its rank inside its own bucket:

    * exact copies are collapsed to one row with a count, before the shuffle, and expanded again;
    * ranks are windows over (key, bucket), which spreads a hot key over all its buckets;
    * earlier buckets are counted from pre-aggregated rows, at most one per key and bucket.

    With ``spread="minute"`` a bucket is a time of ``bucket_seconds``: a plan and nothing else, for logs in which no key has
    very many rows in one of them. With ``spread="range"`` buckets are ranges of equal size of (key, time, other
    columns), see ``ranged``: any key, any minute and missing times are split alike, at the price of storing the rows once.

    Rows with equal timestamps are ordered by their other columns, so reruns agree. Rows without
    a key are kept with a NULL number.
    """
    others = [c for c in df.columns if c not in (key, order)]
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    if spread == "range":
        rows = ranged(copies, [key, order, *others], "_bucket")
    else:
        rows = copies.withColumn("_bucket", _time_bucket(df, order, bucket_seconds))

    inside = Window.partitionBy(key, "_bucket").orderBy(order, *others)
    ranked = rows.withColumn(
        "_before", F.sum("_copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies")
    )
    by_bucket = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(key, "_bucket")
        .agg(F.sum("_copies").alias("_here"))
        .select(key, "_bucket", F.coalesce(F.sum("_here").over(by_bucket), F.lit(0)).alias("_start"))
    )
    numbered = ranked.join(starts, [key, "_bucket"], "left")
    # Copies expand chunk by chunk, so no array grows with the number of copies.
    return (
        numbered.withColumn(
            "_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {_CHUNK}")))
        )
        .withColumn(
            "_copy",
            F.explode(
                F.sequence(
                    F.col("_chunk") * _CHUNK + 1,
                    F.least(F.col("_copies"), (F.col("_chunk") + 1) * _CHUNK),
                )
            ),
        )
        .select(*df.columns, (F.col("_start") + F.col("_before") + F.col("_copy")).alias(name))
    )


def ranged(df: DataFrame, order: Sequence[str], bucket: str, buckets: int | None = None) -> DataFrame:
    """``df`` with the number of its range: consecutive ranges of rows by ``order``, of about equal size.

    Borders come from a sample, so a range has its number only once the rows are stored; they are written to the
    session's shared folder and read again. Distinct rows are split however many share their first columns.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark, "ranges")
    overwrite(df.repartitionByRange(buckets, *order).withColumn(bucket, F.spark_partition_id()), folder)
    return spark.read.schema(df.withColumn(bucket, F.lit(0)).schema).parquet(folder)


def _time_bucket(df: DataFrame, order: str, seconds: int) -> Column:
    """Bucket number that never decreases as ``order`` grows; missing values come first."""
    ts = F.col(order)
    if isinstance(df.schema[order].dataType, T.TimestampNTZType):
        # From the wall-clock fields: converting to an instant would fold hours at DST changes.
        epoch = (
            F.unix_date(ts.cast("date")).cast("bigint") * 86400
            + F.hour(ts) * 3600
            + F.minute(ts) * 60
            + F.floor(F.second(ts))
        )
    else:
        epoch = F.unix_seconds(ts.cast("timestamp"))
    return F.coalesce(F.floor(epoch / seconds), F.lit(-(2**62)))


def running_level(
    log: DataFrame, key: str = "account_id", ts: str = "level_up_ts", spread: str = "minute"
) -> DataFrame:
    """Level after each level-up: the first one reaches level 2."""
    numbered = running_number(log, key, ts, "_n", spread=spread)
    return numbered.select(*log.columns, (F.col("_n") + 1).cast("int").alias("new_level"))


def max_per_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(name))


def latest_per_key(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """The newest row of each key. A maximum of structs combines on the map side, unlike a sort
    of each key's rows; rows of the same ``order`` are decided by the larger column values."""
    newest = df.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("_row"))
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in (order, *columns)])


def attach_state(df: DataFrame, state: DataFrame, key: str, column: str, default) -> DataFrame:
    """Left join a one-row-per-key state, with a default for keys that have none."""
    return df.join(state.select(key, column), key, "left").withColumn(
        column, F.coalesce(F.col(column), F.lit(default))
    )


def continue_level(
    batch: DataFrame, log: DataFrame, key: str = "account_id", ts: str = "level_up_ts", spread: str = "range"
) -> DataFrame:
    """Number a new batch's level-ups onward from each account's highest level so far (or 1).

    A batch is one day, in which a minute may hold most rows: it is numbered by ranges unless ``spread`` says otherwise.
    """
    numbered = running_number(batch, key, ts, "_n", spread=spread)
    state = max_per_key(log, key, "new_level", "_reached")
    leveled = attach_state(numbered, state, key, "_reached", 1)
    return leveled.select(*batch.columns, (F.col("_reached") + F.col("_n")).cast("int").alias("new_level"))


def expand_rows(df: DataFrame, times: Column, index: str) -> DataFrame:
    """Repeat each row ``times`` times with an index from 1; no rows where it is not positive.

    Expands chunk by chunk, so no row holds an array as long as its count.
    """
    counted = df.withColumn("_times", times.cast("long")).where(F.col("_times") > 0)
    chunked = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_times - 1) div {_CHUNK}"))))
    last = F.least(F.col("_times"), (F.col("_chunk") + 1) * _CHUNK)
    kind = "long" if df.withColumn("_t", times).schema["_t"].dataType == T.LongType() else "int"
    numbered = chunked.withColumn(index, F.explode(F.sequence(F.col("_chunk") * _CHUNK + 1, last)))
    return numbered.withColumn(index, F.col(index).cast(kind)).drop("_times", "_chunk")
