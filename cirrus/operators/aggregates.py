"""Grouped statistics: the building block of every aggregate operator.

An aggregate operator is an ``AggSpec``: the grouping keys, the columns to
derive before grouping (calendar buckets, bands, differences), the aggregate
*buffers* it needs (named canonically, e.g. ``__min__temperature``) and a
``finish`` function that turns the aggregated frame (keys + buffers) into the
result (rounding, windows over the aggregate, HAVING, ordering).

* ``run_spec`` runs one spec as ``groupBy(keys).agg(buffers)``: one partial
  aggregate per task (map-side combine, so a hot key costs one row per task
  in the shuffle) and one final aggregate.
* ``run_specs_fused`` runs many specs over the same input as a single
  ``GROUPING SETS`` aggregate: one scan and one shuffle for all of them;
  buffers with the same name are shared between specs.

Every buffer is a count, minimum, maximum or exact decimal sum (see
``functions.moments``), so partial results merge without error: a coarser
grouping can be re-aggregated from a finer one, or from stored parts.

Expressions are SQL text (see ``functions.expr``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.functions.expr import q, round_sql
from cirrus.functions.moments import FRACTIONAL, Moments, merged, prepared
from cirrus.session import ensure_checkpoint_dir

@dataclass(frozen=True)
class Stat:
    """One aggregate output.

    kind: avg | min | max | range | stddev_samp | stddev_pop | count | sum
    column: input column (None for count)
    alias: output name
    digits: decimals of the rounded output (fractional results only)
    """

    kind: str
    column: str | None
    alias: str
    digits: int = 2


@dataclass
class AggSpec:
    keys: tuple[str, ...]
    buffers: dict[str, str]  # name -> aggregate SQL
    # finish(aggregated): result from keys and buffers.
    finish: Callable[..., DataFrame]
    derived: dict[str, str] = field(default_factory=dict)  # name -> row-level SQL
    # For a grand total (no keys) of count-like buffers: in a grouping-sets
    # pass an empty input yields no row for the empty set, so the fused run
    # folds in a row of zeros (a plain global aggregate always has one row).
    counts_only: bool = False
    # ``finish`` reads the aggregate more than once (ranks do), so it is stored
    # in the checkpoint folder first.
    reread: bool = False


def raw_name(alias: str) -> str:
    return f"__raw_{alias}"


def is_fractional(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, FRACTIONAL)


# ---------------------------------------------------------------------------
# Buffers and values
# ---------------------------------------------------------------------------


def moments_of(df: DataFrame, column: str, derived: Mapping[str, str] | None = None) -> Moments:
    """Moments of ``column``, possibly a derived one."""
    if column in (derived or {}):
        return Moments(column, derived[column], df.selectExpr(derived[column]).schema[0].dataType)
    return Moments(column, q(column), df.schema[column].dataType)


_SIMPLE = {"min": "MIN", "max": "MAX", "sum": "SUM"}


def stat_buffers(s: Stat, m: Moments | None) -> tuple[dict[str, str], dict[str, str]]:
    """Aggregates and row-level columns that ``s`` needs."""
    if s.kind == "count":
        return {"__rows": "COUNT(1)"}, {}
    if s.kind == "avg":
        return m.mean_buffers(), m.mean_derived()
    if s.kind in ("stddev_samp", "stddev_pop"):
        return m.square_buffers(), m.square_derived()
    if s.kind == "range":
        return {f"__{k}__{m.name}": f"{_SIMPLE[k]}({m.x})" for k in ("min", "max")}, {}
    if s.kind in _SIMPLE:
        return {f"__{s.kind}__{m.name}": f"{_SIMPLE[s.kind]}({m.x})"}, {}
    raise ValueError(f"unknown stat kind {s.kind!r}")


def stat_value(s: Stat, m: Moments | None) -> str:
    if s.kind == "count":
        return q("__rows")
    if s.kind == "avg":
        return m.mean()
    if s.kind in ("stddev_samp", "stddev_pop"):
        return m.stddev(s.kind == "stddev_samp")
    if s.kind == "range":
        return f"({q(f'__max__{m.name}')} - {q(f'__min__{m.name}')})"
    return q(f"__{s.kind}__{m.name}")


def _is_frac_result(s: Stat, frac: bool) -> bool:
    return s.kind in ("avg", "stddev_samp", "stddev_pop") or (s.kind != "count" and frac)


def stats_spec(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Stat],
    keep_raw: Sequence[str] = (),
    derived: Mapping[str, str] | None = None,
    then: Callable[..., DataFrame] | None = None,
    reread: bool = False,
) -> AggSpec:
    """Spec producing ``keys + [s.alias ...] (+ raw_name(k) for k in keep_raw)``.

    Fractional results are rounded to ``s.digits``; integer ones are not.
    ``then`` post-processes the rounded frame (windows, HAVING, ordering).
    """
    own = dict(derived or {})
    buffers: dict[str, str] = {}
    made: dict[str, str] = dict(own)
    cols = [q(k) for k in keys]
    raws = []
    moments: dict[str, Moments] = {}
    for s in stats:
        m = None
        if s.column is not None:
            m = moments.setdefault(s.column, moments_of(df, s.column, own))
        needs, rows = stat_buffers(s, m)
        buffers.update(needs)
        made.update(rows)
        v = stat_value(s, m)
        cols.append(f"{round_sql(v, s.digits) if _is_frac_result(s, m is not None and m.fractional) else v} AS {q(s.alias)}")
        if s.alias in keep_raw:
            raws.append(f"{v} AS {q(raw_name(s.alias))}")

    spread = list({m.name: m for m in (moments[s.column] for s in stats if s.kind.startswith("stddev"))}.values())

    def finish(g: DataFrame) -> DataFrame:
        out = prepared(g, spread).selectExpr(*cols, *raws)
        return then(out) if then else out

    return AggSpec(tuple(keys), buffers, finish, made, reread=reread)


# ---------------------------------------------------------------------------
# Execution
# ---------------------------------------------------------------------------


def with_derived(df: DataFrame, derived: Mapping[str, str]) -> DataFrame:
    """``df`` plus the derived columns; an input column of the same name is
    replaced (its value is still what the derived expressions see)."""
    names = {n.lower() for n in derived}
    kept = [q(c) for c in df.columns if c.lower() not in names]
    return df.selectExpr(*kept, *[f"{t} AS {q(n)}" for n, t in derived.items()]) if derived else df


def _aggs(buffers: Mapping[str, str]):
    return [F.expr(f"{t} AS {q(n)}") for n, t in buffers.items()]


def _single_call(sql: str) -> bool:
    """True for ``NAME(...)`` where the first '(' closes at the very end."""
    head = sql.split("(", 1)[0]
    if not head or not head.replace("_", "").isalnum():
        return False
    depth = 0
    for i, ch in enumerate(sql):
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return i == len(sql) - 1
    return False


def run_spec(df: DataFrame, spec: AggSpec) -> DataFrame:
    """One spec as a plain ``groupBy().agg()`` (run at once if ``spec.reread``)."""
    src = with_derived(df, spec.derived)
    g = src.groupBy(*spec.keys).agg(*_aggs(spec.buffers))
    if spec.reread:
        ensure_checkpoint_dir(df.sparkSession)
        g = g.checkpoint(eager=True)
    return spec.finish(g)


@dataclass
class SetPlan:
    """Several specs as one GROUPING SETS aggregate: what to derive, the
    buffers by name, the keys of all sets, and the sets."""

    specs: dict[str, AggSpec]
    derived: dict[str, str] = field(default_factory=dict)
    buffers: dict[str, str] = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)
    sets: list[tuple[str, ...]] = field(default_factory=list)

    def gid_of(self, keys: tuple[str, ...]) -> int:
        """grouping_id: bit (n-1-i) is set when key i is NOT grouped in the set."""
        n = len(self.keys)
        return sum(1 << (n - 1 - i) for i, k in enumerate(self.keys) if k not in keys)

    def aggregate(self, df: DataFrame) -> DataFrame:
        """All sets over ``df`` in one pass: ``__gid``, keys and buffers.

        ``__gid`` tells the sets apart, so genuine NULL keys in the data are not
        confused with the NULLs of keys outside a set.  Each buffer is updated
        only for the sets whose specs use it (FILTER on the grouping id)."""
        users: dict[str, set[int]] = {}
        for spec in self.specs.values():
            for b in spec.buffers:
                users.setdefault(b, set()).add(self.gid_of(spec.keys))
        filtered = {
            b: (f"{t} FILTER (WHERE GROUPING_ID() IN ({', '.join(map(str, sorted(users[b])))}))"
                if _single_call(t) and len(users[b]) < len(self.sets) else t)
            for b, t in self.buffers.items()
        }
        src = with_derived(df, self.derived)
        return src.groupingSets([list(s) for s in self.sets], *self.keys).agg(
            F.expr("GROUPING_ID() AS __gid"), *_aggs(filtered)
        )

    def merge(self, parts: DataFrame) -> DataFrame:
        """Partial results of :meth:`aggregate` over any split of the rows,
        merged into those of all rows."""
        return parts.groupBy("__gid", *self.keys).agg(*[F.expr(f"{merged(b, t)} AS {q(b)}") for b, t in self.buffers.items()])

    def finish(self, agg: DataFrame) -> dict[str, DataFrame]:
        """Results by name."""
        out = {}
        for name, spec in self.specs.items():
            part = agg.where(f"__gid = {self.gid_of(spec.keys)}").selectExpr(*[q(c) for c in (*spec.keys, *spec.buffers)])
            if not spec.keys and spec.counts_only:
                cols = list(spec.buffers)
                zero = agg.sparkSession.range(1).selectExpr(*[f"CAST(0 AS BIGINT) AS {q(c)}" for c in cols])
                part = part.unionByName(zero).agg(*[F.expr(f"SUM({q(c)}) AS {q(c)}") for c in cols])
            out[name] = spec.finish(part)
        return out


def plan_sets(specs: Mapping[str, AggSpec]) -> SetPlan:
    """Specs that define a column or buffer of one name differently are refused."""
    plan = SetPlan(dict(specs))
    for name, spec in specs.items():
        for pool, new in ((plan.derived, spec.derived), (plan.buffers, spec.buffers)):
            for col, sql in new.items():
                if pool.setdefault(col, sql) != sql:
                    raise ValueError(f"spec {name!r} redefines {col!r} differently")
        plan.keys += [k for k in spec.keys if k not in plan.keys]
        if spec.keys not in plan.sets:
            plan.sets.append(spec.keys)
    return plan


def run_specs_fused(
    df: DataFrame, specs: Mapping[str, AggSpec], cut: bool = True
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run several specs over ``df`` in one GROUPING SETS aggregate.

    Returns the results by name and the shared aggregate (checkpointed: it
    holds one row per group of every set, i.e. as many rows as the results
    together).
    """
    plan = plan_sets(specs)
    agg = plan.aggregate(df)
    if cut:
        # Checkpointed into the session's checkpoint folder: the aggregate is
        # computed once, its lineage (the scan) is cut, and the results below
        # are planned against a small leaf.  Nothing is cached, so a later run
        # over the same path reads its files again.
        ensure_checkpoint_dir(df.sparkSession)
        agg = agg.checkpoint(eager=True)
    return plan.finish(agg), agg


def grouped_stats(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Stat],
    keep_raw: Sequence[str] = (),
) -> DataFrame:
    """``groupBy(keys).agg(stats)`` with rounded outputs (see ``stats_spec``)."""
    return run_spec(df, stats_spec(df, keys, stats, keep_raw))


def asc(*names: str):
    return [F.asc_nulls_last(n) for n in names]


def desc(*names: str):
    return [F.desc_nulls_last(n) for n in names]
