"""RANK() without a window over everything.

Rows are dealt to ranges of the ranked value.  The bounds of the ranges are
the values of a fixed sample of rows (the least by a hash of the row), and
every bound is a range of its own, so ties never cross a border and a value
that many rows share needs no sorting.  A row's rank is one more than the rows
in better ranges, from one count a range, plus those before it inside its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.functions.expr import q

MAX_RANGES = 256  # bounds taken; each row is compared with all of them
SPREAD = 64  # tasks for the rows of one bound or of the missing values


def _hash(columns: Sequence[str]) -> str:
    return f"xxhash64({', '.join(map(q, columns))})"


def _sample(g: DataFrame, value: str, ranges: int) -> Column:
    """Sorted distinct values of ``ranges`` rows, as a scalar subquery."""
    rows = g.where(f"{q(value)} IS NOT NULL").selectExpr(f"{q(value)} AS v", f"{_hash(g.columns)} AS h")
    few = rows.orderBy("h", "v").limit(ranges)
    return few.selectExpr("array_sort(array_distinct(collect_list(v)))").scalar()


def add_ranks(g: DataFrame, ranks: Sequence[tuple[str, bool, str]], ranges: int | None = None) -> DataFrame:
    """``g`` plus bigint ``RANK()`` columns, each ``(value column, descending,
    alias)``: gaps after ties, NULLs last either way, NaN as the greatest value.

    Lazy: bounds and counts are scalar subqueries.  They read ``g`` again, so
    ``g`` should be stored or checkpointed (``run_spec`` does so).  One shuffle
    for each value column, to as many tasks as there are ranges."""
    if ranges is None:
        ranges = min(MAX_RANGES, int(g.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = g
    for value in dict.fromkeys(v for v, _, _ in ranks):
        out = _ranked_by(out, g, value, [(d, a) for v, d, a in ranks if v == value], ranges)
    return out


def _ranked_by(out: DataFrame, g: DataFrame, value: str, ranks: list[tuple[bool, str]], ranges: int) -> DataFrame:
    v, kept = q(value), [q(c) for c in out.columns]
    sample = _sample(g, value, ranges)
    # Odd ranges are the bounds themselves, even ones lie between; NULL: no value.
    dealt = f"CASE WHEN {v} IS NOT NULL THEN 2 * size(filter(__b, b -> b < {v})) + int(exists(__b, b -> b = {v})) END AS __r"
    counted = g.where(f"{v} IS NOT NULL").select(v).withColumn("__b", sample).selectExpr(dealt)
    counts = counted.groupBy("__r").agg(F.expr("count(1) AS n")).selectExpr("collect_list(struct(__r AS r, n))").scalar()
    d = out.withColumns({"__b": sample, "__c": counts}).selectExpr(*kept, "__c", dealt)
    # Rows of one bound, or without a value, are all equal: no order inside.
    alone = "(__r IS NULL OR __r % 2 = 1)"
    d = d.selectExpr("*", f"IF({alone}, pmod({_hash(out.columns)}, {SPREAD}), 0) AS __s")
    made = []
    for descending, alias in ranks:
        sense, better = ("DESC", ">") if descending else ("ASC", "<")
        before = f"aggregate(filter(__c, c -> __r IS NULL OR c.r {better} __r), 0L, (s, c) -> s + c.n)"
        inside = f"IF({alone}, 1, RANK() OVER (PARTITION BY __r, __s ORDER BY {v} {sense}))"
        made.append(f"{before} + CAST({inside} AS BIGINT) AS {q(alias)}")
    return d.selectExpr(*kept, *made)
