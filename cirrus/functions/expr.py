"""Expressions shared by the operators, as Spark SQL text.

All of them are built-in Spark expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.  They are produced as SQL text and turned
into plans with ``selectExpr`` / ``F.expr``: one driver->JVM call per
expression instead of one per node, which keeps planning cheap for the
wide projections of a fused suite.  ``round_to``, ``ntz``, ``band`` and
``lookup`` return Columns for callers that want them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def lit(v) -> str:
    """SQL literal for a Python number or string."""
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float):
        if v != v or v in (float("inf"), float("-inf")):
            return f"CAST('{'NaN' if v != v else ('Infinity' if v > 0 else '-Infinity')}' AS DOUBLE)"
        return f"{v!r}D"
    return str(v)


def ntz_sql(instant: dt.datetime) -> str:
    """A naive-timestamp literal.  ``F.lit(datetime)`` would make a zoned
    timestamp (through the Python process's zone) and shift comparisons with
    naive columns whenever the session zone differs."""
    return f"TIMESTAMP_NTZ'{instant.replace(tzinfo=None).isoformat(sep=' ')}'"


def ntz(instant: dt.datetime) -> Column:
    return F.expr(ntz_sql(instant))


def _d(x: float) -> str:
    return f"{float(x)!r}D"


# ---------------------------------------------------------------------------
# Rounding
# ---------------------------------------------------------------------------


def round_sql(x: str, digits: int) -> str:
    """Round a double to ``digits`` decimals by scale, round, unscale.

    ``round(x, n)`` rounds the decimal text of ``x`` (1.005 -> 1.01), while
    SQL engines that scale in binary give 1.0.  Rounding the scaled value to
    an integer gives the binary result in Spark as well.  The magnitude is
    rounded and the sign put back, so -0.004 gives -0.0 as IEEE rounding does
    (decimal rounding would drop the sign of zero).
    """
    m = _d(10**digits)
    y = f"(({x}) * {m})"
    return f"(CASE WHEN {y} < 0 THEN -ROUND(-{y}) ELSE ROUND({y}) END / {m})"


def round_to(x: str | Column, digits: int) -> Column:
    """Column form of ``round_sql`` (a name or a Column)."""
    if isinstance(x, str):
        return F.expr(round_sql(q(x), digits))
    m = float(10**digits)
    y = x * F.lit(m)
    return F.when(y < 0, -F.round(-y)).otherwise(F.round(y)) / F.lit(m)


# ---------------------------------------------------------------------------
# Calendar buckets on naive timestamps (independent of the session time zone)
# ---------------------------------------------------------------------------


def day_start_sql(ts: str) -> str:
    """Midnight of the day of ``ts`` as a naive timestamp."""
    return f"CAST(TO_DATE({ts}) AS TIMESTAMP_NTZ)"


def month_start_sql(ts: str) -> str:
    """First midnight of the month of ``ts`` as a naive timestamp."""
    return f"CAST(TRUNC(TO_DATE({ts}), 'MM') AS TIMESTAMP_NTZ)"


def hour_of_day_sql(ts: str) -> str:
    return f"CAST(HOUR({ts}) AS BIGINT)"


def period_start_sql(ts: str, period: str) -> str:
    if period == "day":
        return day_start_sql(ts)
    if period == "month":
        return month_start_sql(ts)
    if period == "hour":
        return f"({day_start_sql(ts)} + MAKE_DT_INTERVAL(0, HOUR({ts}), 0, 0))"
    raise ValueError(f"unsupported period {period!r}")


def hour_index_sql(ts: str) -> str:
    """Whole hours since 1970-01-01 00:00 of the hour ``ts`` falls in."""
    return f"(CAST(DATEDIFF(TO_DATE({ts}), DATE'1970-01-01') AS BIGINT) * 24 + CAST(HOUR({ts}) AS BIGINT))"


def hours_crossed_sql(start: str, end: str) -> str:
    """Hour boundaries crossed from ``start`` to ``end`` (10:59 -> 11:01 is 1)."""
    return f"({hour_index_sql(end)} - {hour_index_sql(start)})"


# ---------------------------------------------------------------------------
# Bands and maps
# ---------------------------------------------------------------------------


def band_sql(x: str, bands: Iterable[tuple[float, str]], otherwise: str) -> str:
    """First label whose (exclusive) upper bound exceeds ``x``; NULL -> otherwise."""
    arms = " ".join(f"WHEN {x} < {b} THEN {lit(lab)}" for b, lab in bands)
    return f"CASE {arms} ELSE {lit(otherwise)} END"


def lookup_sql(x: str, mapping: Mapping[str, str], otherwise: str) -> str:
    """Value of ``mapping`` at ``x``; unknown or NULL keys -> otherwise."""
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {x} {arms} ELSE {lit(otherwise)} END"


def band(x: str, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    return F.expr(band_sql(q(x), bands, otherwise))


def lookup(x: str, mapping: Mapping[str, str], otherwise: str) -> Column:
    return F.expr(lookup_sql(q(x), mapping, otherwise))
