"""JDBC sources: full and incremental loads of a remote readings table.

Executors pull disjoint slices in parallel (a plain JDBC read is a single
task).  The slices hold about equally many rows: their borders come from counts
by day, and by hour, minute or exact time where there are too many, taken in
the database; only the counts reach the driver.  Each slice is an explicit
predicate with the high-water mark in it.  Tasks that fail mid-read are retried
by Spark; the counting queries get a small bounded retry loop with a fixed delay.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

R = TypeVar("R")
T = TypeVar("T")

ROWS_PER_PARTITION = 1_000_000


def with_retries(action: Callable[[], R], max_retries: int = 3, retry_delay: float = 5.0) -> R:
    """Run ``action`` up to ``max_retries`` times, sleeping between attempts;
    the last error is re-raised."""
    for attempt in range(1, max_retries + 1):
        try:
            return action()
        except Exception as e:  # noqa: BLE001 - any connection failure
            log.error("attempt %d/%d failed: %s", attempt, max_retries, e)
            if attempt == max_retries:
                raise
            time.sleep(retry_delay)
    raise AssertionError("unreachable")


def _reader(spark: SparkSession, url: str, properties: dict[str, str] | None, fetchsize: int):
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'  # standard SQL: exact (lower-case) name


def _instant(t: dt.datetime) -> str:
    """JDBC escape syntax: every driver translates it to its own literal."""
    return f"{{ts '{t.isoformat(sep=' ')}'}}"


@dataclass(frozen=True)
class Span:
    """Rows with a time from ``start`` to before ``end``, and how many."""

    start: dt.datetime
    end: dt.datetime
    n: int


# Levels of counting: what to group by, and the length of a bucket.
_LEVELS = [
    ("CAST({c} AS DATE)", dt.timedelta(days=1)),
    ("{{fn HOUR({c})}}", dt.timedelta(hours=1)),
    ("{{fn MINUTE({c})}}", dt.timedelta(minutes=1)),
]


def _spans(query: Callable[[str], list], where: Callable[[str], str], c: str, heavy: int) -> tuple[list[Span], int]:
    """Counts by day, those of days with more than ``heavy`` rows by hour, of
    such hours by minute, and of such minutes by exact time.  And the number of
    rows without a time.

    Each level is one grouped query in the database, over the heavy buckets only."""
    done: list[Span] = []
    todo: list[Span] | None = None
    missing = 0
    groups: list[str] = []
    for sql, length in [*_LEVELS, (None, None)]:
        groups = [*groups, sql.format(c=c)] if sql else [c]
        within = "" if todo is None else " OR ".join(
            f"({c} >= {_instant(t.start)} AND {c} < {_instant(t.end)})" for t in _joined(todo))
        named = ", ".join(f"{g} AS g{i}" for i, g in enumerate(groups))
        found = []
        for *at, n in query(f"SELECT {named}, COUNT(*) AS n FROM {{table}}{where(within)} GROUP BY {', '.join(groups)}"):
            if at[0] is None:
                missing += n
                continue
            if sql is None:
                start, end = at[0], at[0] + dt.timedelta(microseconds=1)
            else:
                day = dt.datetime(at[0].year, at[0].month, at[0].day)
                start = day + dt.timedelta(**dict(zip(("hours", "minutes"), map(int, at[1:]))))
                end = start + length
            found.append(Span(start, end, n))
        todo = [s for s in found if s.n > heavy and sql is not None]
        done += [s for s in found if s not in todo] if todo else found
        if not todo:
            break
    return sorted(done, key=lambda s: s.start), missing


def _joined(spans: list[Span]) -> list[Span]:
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: s.start):
        if out and out[-1].end == s.start:
            out[-1] = Span(out[-1].start, s.end, out[-1].n + s.n)
        else:
            out.append(s)
    return out


def _packed(sized: list[tuple[T, int]], most: int) -> list[list[T]]:
    """Neighbours together, up to ``most`` rows (or a single one)."""
    out: list[list[T]] = []
    held = 0
    for x, n in sized:
        if out and held + n <= most:
            out[-1].append(x)
            held += n
        else:
            out.append([x])
            held = n
    return out


def slices(
    query: Callable[[str], list], column: str, rows_per_partition: int, after: dt.datetime | None = None, split_column: str | None = None
) -> list[str]:
    """Predicates that cut a table into slices of about ``rows_per_partition``
    rows, however its rows lie in time; together they hold every row once.

    Borders follow from counts taken in the database.  A single time with more
    rows is cut further by the values of ``split_column`` (a text column that can be
    grouped; None: not cut).  Without a row: none."""
    c = _quoted(column)
    only = f"{c} > {_instant(after)}" if after is not None else ""

    def where(more: str) -> str:
        both = [f"({t})" for t in (only, more) if t]
        return f" WHERE {' AND '.join(both)}" if both else ""

    spans, missing = _spans(query, where, c, rows_per_partition)
    out = []
    for group in _packed([(s, s.n) for s in spans], rows_per_partition):
        first, last = group[0], group[-1]
        at = f"{c} >= {_instant(first.start)} AND {c} < {_instant(last.end)}"
        alone = len(group) == 1 and first.n > rows_per_partition
        out += _by_value(query, where, at, split_column, rows_per_partition) if alone and split_column else [at]
    out = [f"({p}) AND {only}" for p in out] if only else out
    return out + ([f"{c} IS NULL"] if missing else [])


def _by_value(query, where, at: str, split_column: str, most: int) -> list[str]:
    v = _quoted(split_column)
    counted = query(f"SELECT {v} AS g0, COUNT(*) AS n FROM {{table}}{where(at)} GROUP BY {v}")
    none = [n for x, n in counted if x is None]
    known = sorted((str(x), n) for x, n in counted if x is not None)
    text = lambda x: "'" + x.replace("'", "''") + "'"
    out = [f"{at} AND {v} IN ({', '.join(map(text, group))})" for group in _packed([(x, n) for x, n in known], most)]
    return out + ([f"{at} AND {v} IS NULL"] if none else [])


def jdbc_load(
    spark: SparkSession,
    url: str,
    table: str = "weather_data",
    properties: dict[str, str] | None = None,
    partition_column: str = "recorded_at",
    after: dt.datetime | None = None,
    fetchsize: int = 10_000,
    max_retries: int = 3,
    retry_delay: float = 5.0,
    rows_per_partition: int = ROWS_PER_PARTITION,
    split_column: str | None = "city",
) -> DataFrame:
    """Rows of ``table`` (optionally only those with ``partition_column`` >
    ``after``), read in slices of about ``rows_per_partition`` rows.

    There are as many slices as the table needs.  Their borders, the mark and
    the times themselves are naive, so no zone matters.  No global sort is
    applied: a loaded table is a bag; ordering belongs to the consumer.
    """

    def reader():
        return _reader(spark, url, properties, fetchsize).option("preferTimestampNTZ", "true")

    def query(sql: str) -> list:
        q = f"({sql.replace('{table}', table)}) counted"
        return with_retries(lambda: [tuple(r) for r in reader().option("dbtable", q).load().collect()], max_retries, retry_delay)

    cut = slices(query, partition_column, rows_per_partition, after, split_column)
    options = {"fetchsize": str(fetchsize), "preferTimestampNTZ": "true", **(properties or {})}
    df = spark.read.jdbc(url, table, predicates=cut or ["1 = 0"], properties=options)
    return df.withColumn(partition_column, F.col(partition_column).cast("timestamp_ntz"))


def jdbc_full_load(spark: SparkSession, url: str, table: str = "weather_data", **kw) -> DataFrame:
    """The whole remote table."""
    return jdbc_load(spark, url, table, after=None, **kw)


def jdbc_incremental_load(
    spark: SparkSession, url: str, mark: dt.datetime | None, table: str = "weather_data", **kw
) -> DataFrame:
    """Rows strictly newer than ``mark``; the whole table when ``mark`` is None."""
    return jdbc_load(spark, url, table, after=mark, **kw)
