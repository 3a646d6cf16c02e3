"""Parquet export, the suite, the pipelines and the sample generator."""

import datetime as dt
import os

from cirrus import schema as S
from cirrus.plans import weather as W
from cirrus.plans.pipelines import analyse
from cirrus.plans.registry import FRESHNESS_AS_OF
from cirrus.plans.suite import run_suite
from cirrus.sinks.parquet_export import export, export_all, list_exports, read_export
from cirrus.sources.derived import events_readings
from cirrus.sources.sample import generate_readings
from conftest import SF001, SF01


def test_export_round_trip_and_manifest(spark, tmp_dir):
    r = events_readings(spark, SF001)
    res = W.avg_temperature_per_city(r)
    path = export(res, "avg_temperature_per_city", tmp_dir, "20260101_000000")
    assert path.endswith("query_name=avg_temperature_per_city/run_ts=20260101_000000")
    back = read_export(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, res.collect()))
    files = os.listdir(path)
    assert any(f.endswith(".snappy.parquet") for f in files)
    # The folder layout is a real partitioning: prune by query name.
    whole = spark.read.parquet(tmp_dir).where("query_name = 'avg_temperature_per_city'")
    assert whole.count() == 12
    m = list_exports(spark, tmp_dir).collect()
    assert [(x["query_name"], x["rows"]) for x in m] == [("avg_temperature_per_city", 12)]


def test_export_skips_empty_and_isolates_failures(spark, tmp_dir):
    r = events_readings(spark, SF001)
    good = W.feels_like_gap(r)
    empty = good.where("1 = 0")
    bad = good.selectExpr("assert_true(false) AS x")
    out = export_all({"good": good, "empty": empty, "bad": bad}, tmp_dir, "20260101_000001")
    assert set(out) == {"good", "bad"} and out["bad"] == "" and out["good"]
    assert not os.path.exists(os.path.join(tmp_dir, "query_name=empty"))
    assert [x["query_name"] for x in list_exports(spark, tmp_dir).collect()] == ["good"]


def test_list_exports_empty(spark, tmp_dir):
    assert list_exports(spark, tmp_dir).count() == 0


def test_fused_suite_equals_standalone_queries(spark):
    r = events_readings(spark, SF01)
    fused, shared = W.fused_queries(r, FRESHNESS_AS_OF)
    for name, fn in W.QUERIES.items():
        direct = fn(r, FRESHNESS_AS_OF) if name == "data_freshness_per_city" else fn(r)
        # Same rows; the order of rows tied on the sort keys is not defined.
        assert sorted(map(tuple, fused[name].collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_export_of_nothing(tmp_dir):
    from cirrus.sinks.parquet_export import export_all

    assert export_all({}, tmp_dir) == {}


def test_every_query_is_partition_independent(spark):
    r = events_readings(spark, SF01)
    r7 = r.repartition(7)
    for name, fn in W.QUERIES.items():
        a = sorted(map(tuple, fn(r).collect()), key=repr)
        b = sorted(map(tuple, fn(r7).collect()), key=repr)
        assert a == b, name


def test_fused_suite_reads_the_table_twice(spark):
    r = events_readings(spark, SF001)
    fused, _ = W.fused_queries(r, FRESHNESS_AS_OF)
    plan = fused["anomaly_detection"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    # Only the anomaly join scans the readings; the rest come from the shared aggregate.
    for name in ("avg_temperature_per_city", "humidity_trends", "continent_temperature_ranking"):
        p = fused[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in p, name


def test_suite_status_and_isolation(spark):
    r = events_readings(spark, SF001)
    results, status = run_suite(r, as_of=FRESHNESS_AS_OF)
    st = {x["query_name"]: (x["status"], x["row_count"]) for x in status.collect()}
    assert list(st) == list(W.QUERIES) and all(s == "ok" for s, _ in st.values())
    assert st["avg_temperature_per_city"][1] == 12
    queries = {"good": W.feels_like_gap, "bad": lambda d: d.selectExpr("assert_true(false) AS x")}
    results, status = run_suite(r, queries)
    st = {x["query_name"]: x["status"] for x in status.collect()}
    assert st == {"good": "ok", "bad": "failed"} and "bad" not in results


def test_analyse_pipeline_with_export(spark, tmp_dir):
    run = analyse(spark, events_readings(spark, SF001), export_dir=tmp_dir, run_ts="20260101_000002",
                  as_of=FRESHNESS_AS_OF)
    assert run.summary.first()["summary"] == "8/8 checks passed"
    assert len(run.exported) == 16 and all(run.exported.values())
    assert list_exports(spark, tmp_dir).count() == 16


def test_sample_generator(spark):
    base = dt.datetime(2026, 1, 10, 12, 0)
    df = generate_readings(spark, hours=48, base_time=base, seed=7)
    assert df.columns == S.READINGS_SCHEMA.fieldNames()
    rows = df.collect()
    assert len(rows) == 48 * 12
    assert {r["city"] for r in rows} == {c for c, _, _ in S.SAMPLE_CITIES}
    assert all(0 <= r["humidity"] <= 100 and 800 <= r["pressure"] <= 1100 and r["wind_speed"] >= 0 for r in rows)
    assert max(r["recorded_at"] for r in rows) == base
    assert min(r["recorded_at"] for r in rows) == base - dt.timedelta(hours=47)
    again = generate_readings(spark, hours=48, base_time=base, seed=7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_fused_analysis_report_equals_standalone(spark):
    from cirrus.operators.quality import quality_report
    from cirrus.sources.derived import dirty_readings
    from cirrus.sources.tables import conform

    for df in (events_readings(spark, SF01), dirty_readings(events_readings(spark, SF001))):
        run = analyse(spark, df, as_of=FRESHNESS_AS_OF)
        want = [tuple(r) for r in quality_report(conform(df)).collect()]
        assert [tuple(r) for r in run.report.collect()] == want
    empty = analyse(spark, events_readings(spark, SF001).where("1 = 0"), as_of=FRESHNESS_AS_OF)
    rep = {r["check_name"]: r["passed"] for r in empty.report.collect()}
    assert rep["not_empty"] is False and len(rep) == 8


def test_load_modes_feed_the_analysis(spark, tmp_dir):
    from cirrus.plans.pipelines import load_readings
    from cirrus.sources.tables import append_or_create

    base = dt.datetime(2026, 1, 10, 12, 0)
    sample = load_readings(spark, "sample", hours=24, base_time=base, seed=3)
    assert sample.count() == 24 * 12
    append_or_create(sample, os.path.join(tmp_dir, "stored"))
    stored = load_readings(spark, "parquet", path=os.path.join(tmp_dir, "stored"))
    run = analyse(spark, stored, as_of=base)
    st = {r["query_name"]: r["row_count"] for r in run.status.collect()}
    assert st["avg_temperature_per_city"] == 12 and st["hourly_weather_pattern"] == 24
    url = "jdbc:derby:memory:cirrus_modes;create=true"
    sample.write.format("jdbc").option("url", url).option("dbtable", "weather_data").mode("overwrite").save()
    assert load_readings(spark, "full", url=url).count() == 24 * 12
    inc = load_readings(spark, "incremental", url=url, target=os.path.join(tmp_dir, "inc"))
    assert inc.count() == 24 * 12


def test_command_line(spark, tmp_dir, capsys):
    from cirrus.__main__ import main

    assert main(["validate", "--sample", "--hours", "6"]) == 0
    out = capsys.readouterr().out
    assert "8/8 checks passed" in out
    assert main(["analyse", "--sample", "--hours", "6", "--rows", "2", "--as-of", "2026-01-01 00:00:00",
                 "--export", os.path.join(tmp_dir, "out")]) == 0
    out = capsys.readouterr().out
    assert "== temperature_volatility_by_city" in out and "exported " in out  # empty results are skipped
    assert main(["list-exports", os.path.join(tmp_dir, "out")]) == 0
    assert "avg_temperature_per_city" in capsys.readouterr().out


def test_fused_refuses_conflicting_buffers(spark):
    import pytest

    from cirrus.operators.aggregates import AggSpec, run_specs_fused

    r = events_readings(spark, SF001)
    a = AggSpec(("city",), {"__x": "MIN(temperature)"}, lambda g, small=False: g)
    b = AggSpec(("country",), {"__x": "MAX(temperature)"}, lambda g, small=False: g)
    with pytest.raises(ValueError, match="redefines"):
        run_specs_fused(r, {"a": a, "b": b}, cut=False)


def test_same_run_stamp_does_not_overwrite(spark, tmp_dir):
    import pytest

    res = W.feels_like_gap(events_readings(spark, SF001))
    export(res, "feels_like_gap", tmp_dir, "20260101_000009")
    with pytest.raises(Exception):
        export(res, "feels_like_gap", tmp_dir, "20260101_000009")
    assert [x["query_name"] for x in list_exports(spark, tmp_dir).collect()] == ["feels_like_gap"]
