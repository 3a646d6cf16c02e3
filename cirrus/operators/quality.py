"""Data-quality checks over a readings frame, as one report DataFrame.

All value checks (row count, null cells, range violations) are one grand
total aggregate (an ``AggSpec`` with no keys, so a fused suite can compute it
in its own pass); the duplicate check is a second, key-shuffled aggregate
attached as a scalar subquery, so the whole report is one Spark action.  Missing columns are decided from the
schema on the driver (metadata only, no job).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirrus import schema as S
from cirrus.functions.expr import lit, q
from cirrus.operators.aggregates import AggSpec, run_spec

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("check_order", T.IntegerType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("passed", T.BooleanType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("failed_records", T.LongType(), True),
        T.StructField("total_records", T.LongType(), True),
    ]
)

# ---------------------------------------------------------------------------
# Check names in report order, and the report messages.
# ---------------------------------------------------------------------------
CHECKS = [
    "not_empty",
    "required_columns",
    "no_nulls",
    "temperature_range",
    "humidity_range",
    "wind_speed_range",
    "no_duplicates",
    "pressure_range",
]
MSG_EMPTY = "Dataset is empty"
MSG_RECORDS_FOUND = "{n} records found"
MSG_ALL_COLUMNS = "All required columns present"
MSG_MISSING_COLUMNS = "Missing columns: {missing}"
MSG_NO_NULLS = "No null values in critical columns"
MSG_NULLS = "{n} null values found"
MSG_NO_DUPLICATES = "No duplicate records found"
MSG_DUPLICATES = "{n} duplicate records found"
MSG_DUPLICATE_COLUMNS_MISSING = "Required columns missing"
# range check -> (column, low, high, message when passed, message when failed)
RANGE_CHECKS = {
    "temperature_range": (S.TEMPERATURE, S.TEMP_MIN, S.TEMP_MAX,
                          "All temperatures in range [-80.0, 60.0]°C", "{n} temperatures out of range"),
    "humidity_range": (S.HUMIDITY, S.HUMIDITY_MIN, S.HUMIDITY_MAX,
                       "All humidity values in range [0, 100]%", "{n} humidity values out of range"),
    "wind_speed_range": (S.WIND_SPEED, S.WIND_SPEED_MIN, S.WIND_SPEED_MAX,
                         "All wind speeds in valid range", "{n} wind speeds out of range"),
    "pressure_range": (S.PRESSURE, S.PRESSURE_MIN, S.PRESSURE_MAX,
                       "All pressures in range [800, 1100] hPa", "{n} pressure values out of range"),
}
MSG_COLUMN_MISSING = "Column '{column}' missing"


def _fractional(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _is_null(df: DataFrame, c: str) -> str:
    """A missing cell: NULL, or NaN in a floating column."""
    return f"({q(c)} IS NULL OR isnan({q(c)}))" if _fractional(df, c) else f"({q(c)} IS NULL)"


def _out_of_range(df: DataFrame, c: str, lo, hi) -> str:
    """Strictly outside [lo, hi]; NULL and NaN never count (NaN > x is true in Spark)."""
    cond = f"({q(c)} < {lo} OR {q(c)} > {hi})"
    return f"({cond} AND NOT isnan({q(c)}))" if _fractional(df, c) else cond


def _fmt(template: str, n: str) -> str:
    before, after = template.split("{n}")
    return f"concat({lit(before)}, CAST({n} AS STRING), {lit(after)})"


def _row(order: int, name: str, passed: str, message: str, failed: str) -> str:
    return (
        f"named_struct('check_order', {order}, 'check_name', {lit(name)}, 'passed', {passed}, "
        f"'message', {message}, 'failed_records', CAST({failed} AS BIGINT), 'total_records', __rows)"
    )


def duplicate_count(df: DataFrame, keys: Sequence[str] = S.DUPLICATE_KEY) -> DataFrame:
    """One-row frame: rows beyond the first per key (NULLs equal each other).

    Map-side combine collapses copies of a hot key inside each task before
    the shuffle, so even a key holding a third of all rows costs one row per
    task.
    """
    per_key = df.groupBy(*keys).agg(F.expr("COUNT(1) - 1 AS extra"))
    return per_key.agg(F.expr("CAST(COALESCE(SUM(extra), 0) AS BIGINT) AS duplicates"))


def quality_spec(df: DataFrame, checks: Sequence[str] | None = None) -> AggSpec:
    """The report as an aggregate spec over the empty grouping (a grand
    total), so it can share a fused GROUPING SETS pass with other specs.

    Buffers: row count, null cells per critical column, violations per range
    check.  The duplicate count is a separate key-shuffled aggregate attached
    as a scalar subquery.
    """
    wanted = [c for c in CHECKS if checks is None or c in checks]
    present = set(df.columns)
    buffers = {"__rows": "COUNT(1)"}
    critical = [c for c in S.CRITICAL_COLUMNS if c in present]
    if "no_nulls" in wanted:
        buffers.update({f"__null_{c}": f"COUNT_IF({_is_null(df, c)})" for c in critical})
    for name, (c, lo, hi, _, _) in RANGE_CHECKS.items():
        if name in wanted and c in present:
            buffers[f"__bad_{name}"] = f"COUNT_IF({_out_of_range(df, c, lo, hi)})"
    dup_possible = all(k in present for k in S.DUPLICATE_KEY)
    dups = duplicate_count(df) if "no_duplicates" in wanted and dup_possible else None

    rows = []
    for order, name in enumerate(CHECKS, start=1):
        if name not in wanted:
            continue
        if name == "not_empty":
            msg = f"CASE WHEN __rows > 0 THEN {_fmt(MSG_RECORDS_FOUND, '__rows')} ELSE {lit(MSG_EMPTY)} END"
            rows.append(_row(order, name, "__rows > 0", msg, "0"))
        elif name == "required_columns":
            missing = [c for c in S.REQUIRED_COLUMNS if c not in present]
            msg = MSG_ALL_COLUMNS if not missing else MSG_MISSING_COLUMNS.format(missing=missing)
            rows.append(_row(order, name, "true" if not missing else "false", lit(msg), "0"))
        elif name == "no_nulls":
            n = "(" + " + ".join(["CAST(0 AS BIGINT)", *[q("__null_" + c) for c in critical]]) + ")"
            msg = f"CASE WHEN {n} = 0 THEN {lit(MSG_NO_NULLS)} ELSE {_fmt(MSG_NULLS, n)} END"
            rows.append(_row(order, name, f"{n} = 0", msg, n))
        elif name == "no_duplicates":
            if dups is None:
                rows.append(_row(order, name, "false", lit(MSG_DUPLICATE_COLUMNS_MISSING), "0"))
                continue
            msg = f"CASE WHEN __dups = 0 THEN {lit(MSG_NO_DUPLICATES)} ELSE {_fmt(MSG_DUPLICATES, '__dups')} END"
            rows.append(_row(order, name, "__dups = 0", msg, "__dups"))
        else:
            c, _, _, msg_ok, msg_bad = RANGE_CHECKS[name]
            if c not in present:
                rows.append(_row(order, name, "false", lit(MSG_COLUMN_MISSING.format(column=c)), "0"))
                continue
            n = f"__bad_{name}"
            msg = f"CASE WHEN {n} = 0 THEN {lit(msg_ok)} ELSE {_fmt(msg_bad, n)} END"
            rows.append(_row(order, name, f"{n} = 0", msg, n))

    def finish(g: DataFrame) -> DataFrame:
        one = g if dups is None else g.select("*", dups.scalar().alias("__dups"))
        return one.selectExpr(f"inline(array({', '.join(rows)}))")

    return AggSpec((), buffers, finish, counts_only=True)


def quality_report(df: DataFrame, checks: Sequence[str] | None = None) -> DataFrame:
    """Report rows (``REPORT_SCHEMA``), one per requested check, in check order."""
    return run_spec(df, quality_spec(df, checks))


def check(df: DataFrame, name: str) -> DataFrame:
    """A single check as a one-row report."""
    if name not in CHECKS:
        raise ValueError(f"unknown check {name!r}")
    return quality_report(df, [name])


def report_summary(report: DataFrame) -> DataFrame:
    """One row: passed (all checks; an empty report passes), counts, summary
    text 'p/n checks passed' and the names of failed checks in check order."""
    return report.agg(
        *[
            F.expr(t)
            for t in (
                "COUNT_IF(passed) = COUNT(1) AS passed",
                "CAST(COUNT_IF(passed) AS BIGINT) AS passed_checks",
                "CAST(COUNT(1) AS BIGINT) AS total_checks",
                "concat(CAST(COUNT_IF(passed) AS STRING), '/', CAST(COUNT(1) AS STRING), ' checks passed') AS summary",
                "transform(array_sort(collect_list(CASE WHEN NOT passed THEN struct(check_order, check_name) END)),"
                " s -> s.check_name) AS failed_checks",
            )
        ]
    )
