"""Exact, mergeable moments: means, variances and covariances from decimal sums.

Floating-point sums depend, in their last bits, on how rows were split over
tasks.  Here every buffer is a sum of decimals (or a count, minimum or
maximum), so any split and any roll-up of partial results gives the same
bits; only the last step, on one row a group, is floating point.

A double is taken at its shortest decimal form.  Its first 18 places go into
one sum, what is left of a value below 1 into another with 36 places, so the
places kept follow from the value and nothing is cut before a mean.  Squares
and products are of the first 18 places, each split into six places and the
rest so that every product is exact.  NaN and infinities count as missing.
Sums of squares must stay below 1e26; an overflow is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cirrus.functions.expr import q

FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)
_HEAD, _TAIL, _WIDE = "DECIMAL(17, 6)", "DECIMAL(18, 18)", "DECIMAL(38, 18)"
# A pivot this narrow times a count this narrow is exact in 38 digits.
_PIVOT, _COUNT = "DECIMAL(11, 6)", "DECIMAL(14, 0)"


@dataclass(frozen=True)
class Moments:
    """Buffers and values of one column.

    name: canonical name of the column; x: its row-level SQL; dtype: its type.
    """

    name: str
    x: str
    dtype: T.DataType

    @property
    def fractional(self) -> bool:
        return isinstance(self.dtype, FRACTIONAL)

    def _c(self, kind: str) -> str:
        return f"__{kind}__{self.name}"

    # Row level -----------------------------------------------------------

    def _exact(self) -> str:
        if not self.fractional:
            return f"CAST({self.x} AS BIGINT)"
        if isinstance(self.dtype, T.DecimalType):
            return f"CAST({self.x} AS {_WIDE})"
        return f"CASE WHEN ({self.x} - {self.x}) = 0 THEN CAST({self.x} AS {_WIDE}) END"

    def _below(self) -> str:
        h = self._exact()
        if isinstance(self.dtype, T.DecimalType):
            rest = f"CAST({self.x} - {h} AS DECIMAL(38, 36))" if self.dtype.scale > 18 else "0"
            return f"CAST(COALESCE({rest}, 0) AS DECIMAL(38, 36))"
        x = f"CAST(CAST({self.x} AS STRING) AS DOUBLE)" if isinstance(self.dtype, T.FloatType) else self.x
        return (f"CASE WHEN ABS({x}) < 1 AND CAST({h} AS DOUBLE) <> {x} "
                f"THEN CAST({x} - CAST({h} AS DOUBLE) AS DECIMAL(38, 36)) ELSE CAST(0 AS DECIMAL(38, 36)) END")

    def mean_derived(self) -> dict[str, str]:
        """Row-level columns of the mean (integers need none)."""
        return {self._c("h"): self._exact(), self._c("l"): self._below()} if self.fractional else {}

    def square_derived(self) -> dict[str, str]:
        h = self._exact()
        if not self.fractional:
            return {self._c("a"): f"CAST({self.x} AS DECIMAL(18, 0))"}
        head = f"CAST({h} AS {_HEAD})"
        # Types are kept narrow enough that no difference loses a place.
        return {**self.mean_derived(), self._c("a"): head, self._c("b"): f"CAST(CAST({h} AS DECIMAL(29, 18)) - {head} AS {_TAIL})"}

    # Aggregates ----------------------------------------------------------

    def mean_buffers(self) -> dict[str, str]:
        if not self.fractional:
            return {self._c("sum"): f"SUM({self._exact()})", self._c("n"): f"COUNT({self.x})"}
        h, low = self._c("h"), self._c("l")
        return {self._c("sum"): f"SUM({q(h)})", self._c("low"): f"SUM({q(low)})", self._c("n"): f"COUNT({q(h)})"}

    def square_buffers(self) -> dict[str, str]:
        """Buffers of the variance: those of the mean, squares, least and greatest."""
        out = {**self.mean_buffers(), self._c("min"): f"MIN({self.x})", self._c("max"): f"MAX({self.x})"}
        return out | self._products(self)

    def _products(self, other: Moments) -> dict[str, str]:
        a, b = (q(m._c("a")) for m in (self, other))
        out = {self._pair("aa", other): f"SUM({a} * {b})"}
        # Cross terms and the rest, of sides that have places beyond the sixth.
        cross = [f"{q(self._c('b'))} * {b}"] if self.fractional else []
        cross += [f"{a} * {q(other._c('b'))}"] if other.fractional and other is not self else []
        for k, term in enumerate(cross):
            out[self._pair(f"ab{k}", other)] = f"SUM({term})"
        if self.fractional and other.fractional:
            out[self._pair("bb", other)] = f"SUM({q(self._c('b'))} * {q(other._c('b'))})"
        return out

    def product_buffers(self, other: Moments) -> dict[str, str]:
        return self._products(other)

    # Values from the buffers -----------------------------------------------

    @property
    def count(self) -> str:
        return q(self._c("n"))

    def mean(self) -> str:
        """NULL without a value."""
        total = f"CAST({q(self._c('sum'))} AS DOUBLE)"
        if self.fractional:
            total = f"({total} + CAST({q(self._c('low'))} AS DOUBLE))"
        return f"({total} / CAST(NULLIF({self.count}, 0) AS DOUBLE))"

    def pivot_sql(self) -> str:
        """The mean to six places; NULL beyond what is exact."""
        return f"TRY_CAST(ROUND(CAST({q(self._c('sum'))} AS DOUBLE) / NULLIF({self.count}, 0), 6) AS {_PIVOT})"

    def rest_sql(self) -> str:
        """What the sum exceeds the pivot times the count by, exactly."""
        times = f"TRY_CAST(TRY_CAST({self.count} AS {_COUNT}) * {q(self._c('pivot'))} AS DECIMAL(25, 6))"
        return f"CAST(TRY_CAST({q(self._c('sum'))} AS DECIMAL(37, 18)) - {times} AS DOUBLE)"

    def deviations_sql(self, y: Moments) -> str:
        """Sum of (x - mean x)(y - mean y) from the buffers, pivots and rests."""
        names = self._products(y)
        main, *others = names
        n, times = f"CAST({self.count} AS DOUBLE)", 2 if y is self else 1
        rest = [f"{times} * CAST({q(b)} AS DOUBLE)" if b.startswith("__ab") else f"CAST({q(b)} AS DOUBLE)" for b in others]
        rest_sum = f"({' + '.join(rest) or '0D'})"
        px, py, rx, ry = (q(m._c(k)) for k in ("pivot", "rest") for m in (self, y))
        exact = (f"CAST(TRY_CAST({q(main)} AS DECIMAL(37, 12)) - "
                 f"TRY_CAST({px} * {py} * TRY_CAST({self.count} AS {_COUNT}) AS DECIMAL(37, 12)) AS DOUBLE)")
        about = (f"({exact} + ({rest_sum} - CAST({px} AS DOUBLE) * {ry} - CAST({py} AS DOUBLE) * {rx}) "
                 f"- {rx} * {ry} / NULLIF({n}, 0D))")
        # Beyond 1e5 in the mean or 1e14 rows: the plain formula over the exact sums.
        plain = (f"(CAST({q(main)} AS DOUBLE) + {rest_sum} - CAST({q(self._c('sum'))} AS DOUBLE) * "
                 f"(CAST({q(y._c('sum'))} AS DOUBLE) / NULLIF({n}, 0D)))")
        return f"COALESCE({about}, {plain})"

    def deviations(self, other: Moments | None = None) -> str:
        """Sum of products of deviations; of squares without ``other``."""
        return q(self._pair("dev", other or self))

    def _pair(self, kind: str, y: Moments) -> str:
        return f"__{kind}__{self.name}" if y is self else f"__{kind}__{self.name}__{y.name}"

    def constant(self) -> str:
        return f"({q(self._c('min'))} = {q(self._c('max'))})"

    def squares(self) -> str:
        """Sum of squared deviations: exactly 0 for equal values, never negative."""
        return f"(CASE WHEN {self.constant()} THEN 0D ELSE GREATEST({self.deviations()}, 0D) END)"

    def stddev(self, sample: bool) -> str:
        """NULL without a value, or with one if ``sample``."""
        n = f"({self.count} - 1)" if sample else self.count
        return f"(CASE WHEN {n} > 0 THEN SQRT({self.squares()} / CAST({n} AS DOUBLE)) END)"


def prepared(g: DataFrame, squares: Sequence[Moments], pairs: Sequence[tuple[Moments, Moments]] = ()) -> DataFrame:
    """``g`` (buffers by group) plus the sums of deviations that ``stddev`` and
    ``correlation`` read, each step computed once."""
    if not squares:
        return g
    for step, sql in (("pivot", Moments.pivot_sql), ("rest", Moments.rest_sql)):
        g = g.selectExpr("*", *[f"{sql(m)} AS {q(m._c(step))}" for m in squares])
    both = [(m, m) for m in squares] + list(pairs)
    return g.selectExpr("*", *[f"{x.deviations_sql(y)} AS {x.deviations(y)}" for x, y in both])


def correlation(x: Moments, y: Moments) -> str:
    """Pearson correlation of two columns that are missing in the same rows:
    NULL without a value, NaN where one does not vary."""
    return (f"(CASE WHEN {x.count} = 0 THEN CAST(NULL AS DOUBLE) ELSE COALESCE({x.deviations(y)} / "
            f"NULLIF(SQRT({x.squares()}) * SQRT({y.squares()}), 0D), CAST('NaN' AS DOUBLE)) END)")


def merged(buffer: str, sql: str) -> str:
    """Aggregate that merges partial results of ``buffer``, computed by ``sql``."""
    head = sql.split("(", 1)[0].strip().upper()
    kind = {"SUM": "SUM", "COUNT": "SUM", "COUNT_IF": "SUM", "MIN": "MIN", "MAX": "MAX"}.get(head)
    if kind is None:
        raise ValueError(f"{buffer}: {sql} cannot be merged")
    return f"{kind}({q(buffer)})"
