"""Column helpers: bands, guarded ratios, stable buckets, payloads, day arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contracts import TIER_FLOORS, TIER_WEIGHTS


def band(value: Column, floors: Mapping[str, float]) -> Column:
    """Name of the first floor that ``value`` reaches, NULL below all of them."""
    chain = None
    for name, floor in floors.items():
        reached = value >= F.lit(float(floor))
        chain = F.when(reached, F.lit(name)) if chain is None else chain.when(reached, F.lit(name))
    return chain


def spender_tier(spend: Column) -> Column:
    """Tier of a 30-date spend; anything positive below the floors is a minnow, NULL is no spend."""
    return band(spend, TIER_FLOORS).when(spend > 0.0, F.lit("minnow")).otherwise(F.lit("non_spender"))


def lookup(value: Column, table: Mapping[str, float], default: float) -> Column:
    """Map a column through a small table of constants."""
    return F.coalesce(*[F.when(value == k, F.lit(float(v))) for k, v in table.items()], F.lit(default))


def tier_weight(tier: Column) -> Column:
    return lookup(tier, TIER_WEIGHTS, 0.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def total(columns: Sequence[Column]) -> Column:
    """Sum of several columns, NULL if any is NULL."""
    return reduce(add, columns)


def count_of(condition: Column) -> Column:
    """Number of rows of a group on which ``condition`` holds."""
    return F.count(F.when(condition, F.lit(1)))


def stable_bucket(keys: Sequence[Column], buckets: int) -> Column:
    """Bucket ``0 .. buckets-1`` of a key, the same on every engine, run and Spark version.

    Taken from the first 60 bits of an MD5 digest, so it needs no ``abs`` (which overflows on
    the smallest integer) and can be recomputed outside Spark.
    """
    text = F.concat_ws("|", *[k.cast("string") for k in keys])
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(digest, F.lit(buckets)).cast("int")


def stable_pick(values: Sequence[str], keys: Sequence[Column]) -> Column:
    """One of ``values``, chosen by the key's bucket."""
    return F.get(F.array(*[F.lit(v) for v in values]), stable_bucket(keys, len(values)))


def stable_class(shares: Mapping[str, int], keys: Sequence[Column]) -> Column:
    """Class of a key under percentage ``shares`` that add up to 100."""
    if sum(shares.values()) != 100:
        raise ValueError("shares must add up to 100")
    bucket = stable_bucket(keys, 100)
    chain, upper = None, 0
    for name, share in shares.items():
        upper += share
        reached = bucket < upper
        chain = F.when(reached, F.lit(name)) if chain is None else chain.when(reached, F.lit(name))
    return chain


def json_payload(**fields: Column) -> Column:
    """JSON text of the named columns."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def second_of_day(day: Column, second: Column) -> Column:
    """Timestamp ``second`` seconds into ``day``."""
    return F.timestamp_add("SECOND", second, day.cast("timestamp"))
