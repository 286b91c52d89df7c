"""Small hand-made source tables."""

from __future__ import annotations

import datetime as dt

from tidemark.contracts import LOG_TIMESTAMP, SOURCE_COLUMNS
from tidemark.sources.tables import Sources


def day(n: int) -> dt.date:
    """Day ``n`` counted from 2024-03-01, which is day 0."""
    return dt.date(2024, 3, 1) + dt.timedelta(days=n)


def noon(n: int) -> dt.datetime:
    return dt.datetime.combine(day(n), dt.time(12))


def sources(spark, **rows) -> Sources:
    """Sources with the given rows; logs name only their value columns and a day number.

    ``accounts`` is a list of ``(account_id, created_day)``; a log row is ``(account_id, day,
    *values)``; missing tables are empty.
    """
    frames = {}
    for name, ddl in SOURCE_COLUMNS.items():
        given = rows.get(name, [])
        if name == "account":
            data = [(a, None if c is None else day(c), "US", "organic") for a, c in given]
        elif name == "membership":
            data = [(a, day(d), v) for a, d, v in given]
        else:
            columns = [c.strip().split()[0] for c in ddl.split(",")]
            values = [c for c in columns if c not in ("account_id", LOG_TIMESTAMP[name], "event_date")]
            data = []
            for account, d, *rest in given:
                row = dict(zip(values, rest, strict=True))
                row |= {"account_id": account, LOG_TIMESTAMP[name]: noon(d), "event_date": day(d)}
                data.append(tuple(row[c] for c in columns))
        frames[name] = spark.createDataFrame(data, ddl)
    return Sources(frames)


def spine_logins(*days: int, account: int = 999) -> list[tuple[int, int]]:
    """Logins of an account outside the dimension, to put dates on the spine."""
    return [(account, d) for d in days]


def at(df, account: int, n: int):
    """The single row of an account and day."""
    found = df.where(f"account_id = {account} AND observation_date = DATE'{day(n)}'").collect()
    assert len(found) == 1, found
    return found[0]
