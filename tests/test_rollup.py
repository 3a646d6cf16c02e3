"""The stored roll-up: values equal a full recomputation, old rows are not read."""

import datetime as dt
import os

import pytest

from cirrus.operators.outliers import extremes, group_moments_spec, outliers_of_extremes, zscore_outliers
from cirrus.operators.aggregates import run_spec
from cirrus.plans import rollup
from cirrus.plans import weather as W
from cirrus.sources import committed
from cirrus.sources.derived import events_readings, orders_readings
from cirrus.sources.tables import append_or_create, replace_table
from cirrus.streaming.incremental import incremental_run

from conftest import SF01

AS_OF = dt.datetime(2024, 1, 31)


def values(results):
    return {n: [tuple(r) for r in df.collect()] for n, df in results.items()}


def same(got, want):
    for name in W.QUERIES:
        assert sorted(map(repr, got[name])) == sorted(map(repr, want[name])), name


def whole(df):
    queries = dict(W.QUERIES)
    queries["data_freshness_per_city"] = lambda r: W.data_freshness_per_city(r, AS_OF)
    return values({n: f(df) for n, f in queries.items()})


def unreadable(target, batch):
    for root, _, files in os.walk(f"{target}/{batch.folder}"):
        for f in files:
            os.remove(os.path.join(root, f))


@pytest.mark.parametrize("view", [events_readings, orders_readings])
def test_results_after_appends_without_old_rows(spark, tmp_dir, view):
    readings, store = os.path.join(tmp_dir, "readings"), os.path.join(tmp_dir, "rollup")
    df = view(spark, SF01)
    times = sorted(r[0] for r in df.select("recorded_at").collect())
    days = [times[len(times) * k // 10] for k in (3, 7)]
    cuts = [f"recorded_at <= TIMESTAMP_NTZ'{days[0]}'", f"recorded_at <= TIMESTAMP_NTZ'{days[1]}'", "true"]
    for n, cond in enumerate(cuts):
        incremental_run(spark, df.where(cond), readings)
        assert rollup.refresh(spark, readings, store) == 1
        assert rollup.refresh(spark, readings, store) == 0
        unreadable(readings, committed.batches(spark, readings)[n])
    want = whole(df)
    same(values(rollup.results(spark, readings, store, AS_OF)), want)
    assert rollup.compact(spark, store) == 3
    assert len(committed.batches(spark, store)) == 1 and rollup.refresh(spark, readings, store) == 0
    same(values(rollup.results(spark, readings, store, AS_OF)), want)


def test_a_dead_refresh_is_repeated(spark, tmp_dir, monkeypatch):
    readings, store = os.path.join(tmp_dir, "readings"), os.path.join(tmp_dir, "rollup")
    df = events_readings(spark, SF01).where("city <> 'Paris'")
    append_or_create(df.where("humidity < 60"), readings)
    append_or_create(df.where("humidity >= 60"), readings)
    real = committed._commit
    monkeypatch.setattr(committed, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        rollup.refresh(spark, readings, store)
    monkeypatch.setattr(committed, "_commit", real)
    with pytest.raises(ValueError, match="refresh"):
        rollup.results(spark, readings, store)
    assert rollup.refresh(spark, readings, store) == 2
    same(values(rollup.results(spark, readings, store, AS_OF)), whole(df))
    # A replaced table starts the roll-up anew.
    replace_table(df.where("city = 'Tokyo'"), readings)
    assert rollup.refresh(spark, readings, store) == 1
    assert {r["city"] for r in rollup.results(spark, readings, store, AS_OF)["avg_temperature_per_city"].collect()} == {"Tokyo"}


def test_extremes_settle_outliers_or_say_so(spark):
    # Group a: many equal outliers; b: a few; c: none.
    rows = [("a", 10.0 + i % 3, i) for i in range(400)] + [("a", 90.0, i) for i in range(12)]
    rows += [("b", 5.0 + i % 5, i) for i in range(100)] + [("b", -60.0 - i, i) for i in range(3)] + [("c", 1.0, 1), (None, 900.0, 1), ("b", None, 1)]
    df = spark.createDataFrame([(k, v, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i)) for k, v, i in rows], "k string, v double, t timestamp_ntz")
    moments = run_spec(df, group_moments_spec(df, ["k"], "v"))
    for limit in (3, 10, 14, 50):
        want = [tuple(r) for r in zscore_outliers(df, ["k"], "v", "t", 2.0, limit).collect()]
        settled = 0
        for keep in (2, 5, 13, 40):
            state = extremes(extremes(df.repartition(4), ["k"], "v", "t", keep), ["k"], "v", "t", keep)
            got = outliers_of_extremes(state, moments, ["k"], "v", "t", keep, 2.0, limit)
            if got is not None:
                settled += 1
                assert [tuple(r) for r in got.collect()] == want
            assert got is not None or keep < 13
        assert settled >= 2
