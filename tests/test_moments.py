"""Exact moments: the same bits for any split and any roll-up; no cut of small values."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cirrus.functions.moments import Moments, correlation, merged, prepared
from cirrus.operators.aggregates import _aggs, with_derived
from cirrus.operators.ranking import rank_groups
from cirrus.functions.expr import q


def columns(df, *names):
    return [Moments(n, q(n), df.schema[n].dataType) for n in names]


def buffers_of(ms):
    x, y = ms
    return {**x.square_buffers(), **y.square_buffers(), **x.product_buffers(y)}


def finish(g, ms):
    x, y = ms
    g = prepared(g, ms, [(x, y)])
    return g.selectExpr("k", f"{x.mean()} AS m", f"{x.stddev(True)} AS s", f"{x.stddev(False)} AS p", f"{correlation(x, y)} AS c")


def partial(df, ms, *keys):
    derived = {k: v for m in ms for k, v in m.square_derived().items()}
    return with_derived(df, derived).groupBy(*keys).agg(*_aggs(buffers_of(ms)))


def rows_of(seed, kind):
    r = random.Random(seed)
    make = {
        "weather": lambda: round(r.gauss(15, 9), 2),
        "tiny": lambda: r.choice([1e-11, 3e-11, 2.5e-10]),
        "full": lambda: r.gauss(0, 1) / 3,
        "offset": lambda: 90_000 + round(r.random() / 1000, 6),
    }[kind]
    return [(i % 3, make(), r.randrange(100), i % 7) for i in range(600)] + [(9, 0.1, 1, 0)] * 40 + [(8, None, 5, 1), (7, 4.25, 2, 2)]


@pytest.mark.parametrize("kind", ["weather", "tiny", "full", "offset"])
def test_any_split_and_any_roll_up(spark, kind):
    rows = rows_of(1, kind)
    df = spark.createDataFrame(rows, "k int, x double, y long, part int")
    ms = columns(df, "x", "y")
    want = sorted(map(repr, finish(partial(df, ms, "k"), ms).collect()))
    for n in (1, 5, 13):
        assert sorted(map(repr, finish(partial(df.repartition(n, "part"), ms, "k"), ms).collect())) == want
    by_part = partial(df, ms, "k", "part")
    rolled = by_part.groupBy("k").agg(*[F.expr(f"{merged(b, t)} AS {q(b)}") for b, t in buffers_of(ms).items()])
    assert sorted(map(repr, finish(rolled, ms).collect())) == want


@pytest.mark.parametrize("kind", ["weather", "full", "offset"])
def test_values(spark, kind):
    rows = rows_of(2, kind)
    df = spark.createDataFrame(rows, "k int, x double, y long, part int")
    ms = columns(df, "x", "y")
    for row in finish(partial(df, ms, "k"), ms).collect():
        both = [(Fraction(repr(x)), Fraction(y)) for k, x, y, _ in rows if k == row["k"] and x is not None]
        x, y = [a for a, _ in both], [b for _, b in both]
        if not x:
            assert row["m"] is None and row["s"] is None and row["p"] is None
            continue
        assert row["m"] == pytest.approx(float(sum(x) / len(x)), rel=1e-15)
        var = statistics.pvariance(x)
        assert row["p"] == pytest.approx(math.sqrt(var), rel=1e-9)
        assert (row["s"] is None) == (len(x) == 1)
        if var and kind != "offset":
            mx, my = sum(x) / len(x), sum(y) / len(y)
            cov = sum((a - mx) * (b - my) for a, b in both) / len(x)
            assert row["c"] == pytest.approx(float(cov) / math.sqrt(var * statistics.pvariance(y)), rel=1e-9)
        if row["k"] in (7, 9):  # equal values do not vary, whatever their digits
            assert row["p"] == 0 and (row["c"] is None or math.isnan(row["c"]))


def test_small_means_are_told_apart(spark):
    df = spark.createDataFrame([("a", 1e-11), ("b", 3e-11), ("c", 0.0), ("d", 1e-25), ("e", 1e-25)], "k string, v double")
    got = {r["k"]: r["hottest_rank"] for r in rank_groups(df, ["k"], "v").collect()}
    assert got == {"b": 1, "a": 2, "d": 3, "e": 3, "c": 5}


def test_float_and_decimal_columns(spark):
    df = spark.createDataFrame([(1, "0.1"), (1, "0.2"), (1, None)], "k int, t string")
    df = df.selectExpr("k", "CAST(t AS FLOAT) AS f", "CAST(t AS DECIMAL(10, 4)) AS d")
    for name in ("f", "d"):
        m = Moments(name, q(name), df.schema[name].dataType)
        g = prepared(with_derived(df, m.square_derived()).groupBy("k").agg(*_aggs(m.square_buffers())), [m])
        assert g.selectExpr(m.mean(), m.stddev(False)).first()[0] == pytest.approx(0.15, abs=1e-12)


def test_only_mergeable_buffers():
    with pytest.raises(ValueError):
        merged("b", "STDDEV_POP(x)")
