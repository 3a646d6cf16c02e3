"""Quality checks: each check passing and failing, and the report."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from cirrus import schema as S
from cirrus.operators.quality import CHECKS, check, quality_report, report_summary
from cirrus.plans.pipelines import validate
from cirrus.sources.local import empty_frame, local_frame

T0 = dt.datetime(2026, 6, 1, 12, 0)
CITIES = ["Paris", "London", "Tokyo", "Lagos"]


def valid_rows():
    return [
        (c, "XX", 15.0 + i * 0.5, 14.0, 60, 1010, "clear sky", 3.5, 10000, T0 - dt.timedelta(hours=i))
        for c in CITIES
        for i in range(10)
    ]


def frame(spark, rows, schema=S.READINGS_SCHEMA):
    return local_frame(spark, rows, schema)


def with_change(rows, idx, **changes):
    names = S.READINGS_SCHEMA.fieldNames()
    out = [list(r) for r in rows]
    for k, v in changes.items():
        out[idx][names.index(k)] = v
    return [tuple(r) for r in out]


def result(df, name):
    return check(df, name).first().asDict()


def test_valid_frame_passes_all(spark):
    rep = quality_report(frame(spark, valid_rows())).collect()
    assert [r["check_name"] for r in rep] == CHECKS
    assert all(r["passed"] for r in rep)
    assert all(r["total_records"] == 40 for r in rep)
    s = report_summary(quality_report(frame(spark, valid_rows()))).first()
    assert s["passed"] and s["summary"] == "8/8 checks passed" and s["failed_checks"] == []


def test_messages_when_passing(spark):
    rep = {r["check_name"]: r["message"] for r in quality_report(frame(spark, valid_rows())).collect()}
    assert rep["not_empty"] == "40 records found"
    assert rep["temperature_range"] == "All temperatures in range [-80.0, 60.0]°C"
    assert rep["humidity_range"] == "All humidity values in range [0, 100]%"
    assert rep["pressure_range"] == "All pressures in range [800, 1100] hPa"


def test_empty_frame_without_columns(spark):
    df = spark.range(0).select()
    rep = {r["check_name"]: r for r in quality_report(df).collect()}
    assert not rep["not_empty"]["passed"] and rep["not_empty"]["message"] == "Dataset is empty"
    assert not rep["required_columns"]["passed"]
    assert rep["required_columns"]["message"].startswith("Missing columns: ['city', 'country'")
    assert rep["no_nulls"]["passed"]
    assert rep["temperature_range"]["message"] == "Column 'temperature' missing"
    assert rep["no_duplicates"]["message"] == "Required columns missing"


def test_empty_frame_with_schema(spark):
    rep = {r["check_name"]: r["passed"] for r in quality_report(empty_frame(spark, S.READINGS_SCHEMA)).collect()}
    assert rep["not_empty"] is False and rep["required_columns"] is True and rep["no_duplicates"] is True


def test_null_cells_are_counted(spark):
    rows = with_change(with_change(valid_rows(), 0, temperature=None), 1, city=None)
    r = result(frame(spark, rows), "no_nulls")
    assert not r["passed"] and r["failed_records"] == 2 and r["message"] == "2 null values found"


def test_nan_counts_as_null_not_out_of_range(spark):
    rows = with_change(valid_rows(), 0, temperature=float("nan"))
    assert result(frame(spark, rows), "no_nulls")["failed_records"] == 1
    assert result(frame(spark, rows), "temperature_range")["passed"]


@pytest.mark.parametrize(
    "name,column,bad,good_edges",
    [
        ("temperature_range", "temperature", [200.0, -100.0], [-80.0, 60.0]),
        ("humidity_range", "humidity", [150, -10], [0, 100]),
        ("wind_speed_range", "wind_speed", [-5.0], [0.0, 100.0]),
        ("pressure_range", "pressure", [500], [800, 1100]),
    ],
)
def test_range_checks(spark, name, column, bad, good_edges):
    rows = valid_rows()
    for i, v in enumerate(good_edges):
        rows = with_change(rows, i, **{column: v})
    assert result(frame(spark, rows), name)["passed"]
    for i, v in enumerate(bad):
        rows = with_change(rows, 10 + i, **{column: v})
    r = result(frame(spark, rows), name)
    assert not r["passed"] and r["failed_records"] == len(bad)
    assert r["message"].startswith(f"{len(bad)} ")


def test_duplicates_count_rows_beyond_first(spark):
    rows = valid_rows()
    rows = rows + [rows[0], rows[0], rows[5]]
    r = result(frame(spark, rows), "no_duplicates")
    assert not r["passed"] and r["failed_records"] == 3 and r["message"] == "3 duplicate records found"


def test_duplicates_treat_null_keys_as_equal(spark):
    rows = with_change(with_change(valid_rows(), 0, city=None), 1, city=None, recorded_at=T0)
    assert result(frame(spark, rows), "no_duplicates")["failed_records"] == 1


def test_missing_columns(spark):
    schema = T.StructType([T.StructField("city", T.StringType()), T.StructField("temperature", T.DoubleType())])
    df = local_frame(spark, [("Paris", 20.0)], schema)
    rep = {r["check_name"]: r for r in quality_report(df).collect()}
    assert rep["required_columns"]["message"] == (
        "Missing columns: ['country', 'humidity', 'pressure', 'wind_speed', 'recorded_at']"
    )
    assert rep["temperature_range"]["passed"]
    assert rep["humidity_range"]["message"] == "Column 'humidity' missing"
    assert not rep["no_duplicates"]["passed"]


def test_summary_lists_failed_checks_in_order(spark):
    rows = with_change(with_change(valid_rows(), 0, pressure=500), 1, temperature=99.0)
    report, summary = validate(frame(spark, rows))
    s = summary.first()
    assert not s["passed"] and s["summary"] == "6/8 checks passed"
    assert s["failed_checks"] == ["temperature_range", "pressure_range"]


def test_report_is_one_job_over_the_data(spark):
    plan = quality_report(frame(spark, valid_rows()))._jdf.queryExecution().optimizedPlan().toString()
    assert "ScalarSubquery" in plan or "scalar-subquery" in plan.lower()
