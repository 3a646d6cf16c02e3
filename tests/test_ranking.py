"""Ranks are exact for every type, with ties, NaN and NULLs, and no task sorts everything."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirrus.operators.ranks import add_ranks
from cirrus.sources.local import local_frame

BIG = 9007199254740992


@pytest.mark.parametrize(
    ("kind", "values", "descending", "want"),
    [
        (T.LongType(), [None, BIG, BIG + 1, BIG + 2], True, {BIG + 2: 1, BIG + 1: 2, BIG: 3, None: 4}),
        (T.LongType(), [3, 3, 1, None], False, {1: 1, 3: 2, None: 4}),
        (T.StringType(), ["b", "a", "b", None], True, {"b": 1, "a": 3, None: 4}),
        (T.DoubleType(), [1.0, float("nan"), 2.0, None], True, {"nan": 1, 2.0: 2, 1.0: 3, None: 4}),
        (T.DoubleType(), [None, None], False, {None: 1}),
        (T.DoubleType(), [], False, {}),
    ],
)
def test_ranks(spark, kind, values, descending, want):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", kind)])
    df = local_frame(spark, list(enumerate(values)), schema).repartition(3)
    got = add_ranks(df, [("v", descending, "r")]).collect()
    assert {"nan" if r["v"] != r["v"] else r["v"]: r["r"] for r in got} == want


@pytest.mark.parametrize("kind", ["double", "bigint", "string", "decimal(20,3)"])
@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_ranks_equal_the_window(spark, kind, ranges):
    """Ties (one value in a third of the rows), NULLs and NaN, against RANK() over all rows."""
    r = random.Random(ranges)
    pool = ["NaN", "-0.0", "0.0", "Infinity", "1e-11", "3e-11"] if kind == "double" else []
    rows = [(i, r.choice(["5", None, str(r.randrange(60)), str(r.randrange(10**15)), *pool, "5"])) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, v string").withColumn("v", F.col("v").cast(kind)).repartition(5)
    ranked = add_ranks(df, [("v", True, "d"), ("v", False, "a")], ranges)
    for alias, order in (("d", F.col("v").desc_nulls_last()), ("a", F.col("v").asc_nulls_last())):
        want = df.withColumn("w", F.rank().over(Window.orderBy(order)))
        assert ranked.join(want, "id").where(f"{alias} <> w").count() == 0
    assert ranked.count() == 700


def test_no_window_over_everything(spark):
    df = spark.range(1000).selectExpr("id", "id % 17 AS v")
    plan = add_ranks(df, [("v", True, "r")])._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Window" in main and "hashpartitioning(__r" in main and "SinglePartition" not in main
