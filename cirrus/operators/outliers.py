"""Statistical operators: per-group correlation and z-score outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.functions.expr import q, round_sql
from cirrus.functions.moments import Moments, correlation, prepared
from cirrus.operators.aggregates import AggSpec, asc, desc, moments_of, run_spec
from cirrus.operators.joins import MAX_BROADCAST_BYTES, size_checked_broadcast


def grouped_correlation_spec(df: DataFrame, keys: Sequence[str], x: str, y: str, corr_alias: str) -> AggSpec:
    mx, my = moments_of(df, x), moments_of(df, y)
    # The same moments over complete pairs only.
    paired = f"({q(x)} IS NOT NULL AND {q(y)} IS NOT NULL)"
    for m in (mx, my):
        if m.fractional:
            paired += f" AND ({m.x} - {m.x}) = 0"
    px, py = (Moments(f"{m.name}__{x}_{y}", f"CASE WHEN {paired} THEN {m.x} END", m.dtype) for m in (mx, my))
    buffers = {**mx.mean_buffers(), **my.mean_buffers(), **px.square_buffers(), **py.square_buffers(), **px.product_buffers(py)}
    derived = {**mx.mean_derived(), **my.mean_derived(), **px.square_derived(), **py.square_derived()}

    def finish(g: DataFrame) -> DataFrame:
        out = prepared(g, [px, py], [(px, py)]).selectExpr(
            *[q(k) for k in keys],
            f"{round_sql(correlation(px, py), 4)} AS {q(corr_alias)}",
            f"{round_sql(mx.mean(), 2)} AS {q('avg_' + x)}",
            f"{round_sql(my.mean(), 2)} AS {q('avg_' + y)}",
        )
        return out.orderBy(*desc(corr_alias))

    return AggSpec(tuple(keys), buffers, finish, derived)


def grouped_correlation(df: DataFrame, keys: Sequence[str], x: str, y: str, corr_alias: str) -> DataFrame:
    """Per group: Pearson correlation of x and y (4 decimals) and both means.

    Correlation is NaN for zero variance and NULL without complete pairs
    (see ``moments.correlation``).  Ordered by correlation, highest first.
    """
    return run_spec(df, grouped_correlation_spec(df, keys, x, y, corr_alias))


MEAN, SD = "__mean", "__sd"


def group_moments_spec(df: DataFrame, keys: Sequence[str], value: str) -> AggSpec:
    """Per group: mean and sample stddev of ``value`` (columns ``__mean``,
    ``__sd``); groups without a stddev (fewer than two values) are dropped,
    since nothing can lie beyond it."""
    m = moments_of(df, value)

    def finish(g: DataFrame) -> DataFrame:
        out = prepared(g, [m]).selectExpr(*[q(k) for k in keys], f"{m.mean()} AS {MEAN}", f"{m.stddev(sample=True)} AS {SD}")
        return out.where(f"{SD} IS NOT NULL")

    return AggSpec(tuple(keys), m.square_buffers(), finish, m.square_derived())


def zscore_outliers(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ts: str,
    threshold: float = 2.0,
    limit: int | None = 50,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    names: Sequence[str] = ("city_mean", "city_stddev", "z_score", "is_anomaly"),
    moments: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``value`` lies more than ``threshold`` sample stddevs from
    their group mean, highest z-score first, top ``limit``.

    Plan: one aggregate pass for (mean, stddev) per group (or ``moments``
    already computed, e.g. by a fused suite), size-checked and broadcast into
    an inner join with the readings - the readings are never shuffled or
    broadcast - the deviation test as the join's filter, then a per-task
    top-k merged into ``limit`` rows.  Ties on the rounded z-score are broken
    by (ts, keys, value) so the selection is deterministic.  Rows with NULL
    keys never match.
    """
    if moments is None:
        moments = run_spec(df, group_moments_spec(df, keys, value))
    stats = size_checked_broadcast(moments, max_broadcast_bytes)
    joined = df.select(*keys, value, ts).join(stats, list(keys), "inner")
    return scored_outliers(joined, keys, value, ts, threshold, limit, names)


def scored_outliers(
    joined: DataFrame, keys: Sequence[str], value: str, ts: str, threshold: float, limit: int | None, names: Sequence[str]
) -> DataFrame:
    """Outliers among rows that carry their group's ``__mean`` and ``__sd``."""
    mean_a, sd_a, z_a, flag_a = names
    v = q(value)
    dev = f"ABS({v} - {MEAN})"
    flag = f"({dev} > {float(threshold)!r}D * {SD})"
    out = joined.where(flag).selectExpr(
        *[q(k) for k in keys],
        v,
        q(ts),
        f"{round_sql(MEAN, 2)} AS {q(mean_a)}",
        f"{round_sql(SD, 2)} AS {q(sd_a)}",
        f"{round_sql(f'{dev} / NULLIF({SD}, 0D)', 2)} AS {q(z_a)}",
        f"{flag} AS {q(flag_a)}",
    )
    out = out.orderBy(*desc(z_a), *asc(ts, *keys, value))
    return out.limit(limit) if limit is not None else out


NAMES = ("city_mean", "city_stddev", "z_score", "is_anomaly")


def extremes(df: DataFrame, keys: Sequence[str], value: str, ts: str, keep: int) -> DataFrame:
    """The ``keep`` greatest and ``keep`` least rows of each group (``__side``
    1 and -1; of equal values the earliest), a state that merges: extremes of
    the union of extremes are the extremes of all rows.

    Each task keeps its own first rows of a group before the shuffle, so a
    group of any size costs ``keep`` rows a task.  Rows without a key or value
    are none.  A row may be on both sides."""
    known = df.where(" AND ".join(f"{q(c)} IS NOT NULL" for c in (*keys, value)))
    out = None
    for side, order in ((1, "DESC"), (-1, "ASC")):
        rows = known.where(f"__side = {side}") if "__side" in df.columns else known
        rows = rows.selectExpr(*map(q, keys), q(value), q(ts))
        by = ", ".join(map(q, keys))
        ranked = rows.selectExpr("*", f"ROW_NUMBER() OVER (PARTITION BY {by} ORDER BY {q(value)} {order}, {q(ts)} ASC NULLS LAST) AS __n")
        part = ranked.where(f"__n <= {keep}").drop("__n").selectExpr("*", f"{side} AS __side")
        out = part if out is None else out.unionByName(part)
    return out


def outliers_of_extremes(
    state: DataFrame, moments: DataFrame, keys: Sequence[str], value: str, ts: str, keep: int, threshold: float, limit: int
) -> DataFrame | None:
    """The ``limit`` outliers of all rows from their :func:`extremes` and group
    moments (both stored); None where the extremes do not settle it.

    They do if every row they leave out is no outlier or scores, rounded, below
    the last one shown: then it cannot come before it on a tie either."""
    stats = size_checked_broadcast(moments)
    joined = state.join(stats, list(keys), "inner")
    found = scored_outliers(_each_once(joined, value), keys, value, ts, threshold, limit, NAMES)
    found = found.checkpoint(eager=True)
    shown, last = found.selectExpr("COUNT(1)", f"MIN({NAMES[2]})").first()
    # The innermost row kept on a full side bounds what was left out there.
    inner = joined.groupBy(*keys, "__side", MEAN, SD).agg(
        F.expr("COUNT(1) AS n"), F.expr(f"MIN(__side * {q(value)}) * __side AS edge")
    )
    z = f"GREATEST(__side * (edge - {MEAN}), 0D)"
    floor = f"{round_sql(f'{z} / NULLIF({SD}, 0D)', 2)} >= {last!r}D" if shown >= limit else "true"
    open_sides = inner.where(f"n >= {keep} AND {z} > {float(threshold)!r}D * {SD} AND {floor}")
    return found if open_sides.isEmpty() else None


def _each_once(joined: DataFrame, value: str) -> DataFrame:
    """Rows above the mean from the upper side, the others from the lower: a
    row kept on both sides counts once, equal rows as often as they occur."""
    return joined.where(f"(__side = 1) = ({q(value)} >= {MEAN})")
