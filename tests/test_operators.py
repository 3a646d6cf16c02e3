"""Edge cases of the generic operators on small fixed frames."""

import datetime as dt
import math

import duckdb
import pytest

from cirrus import schema as S
from cirrus.functions.expr import round_sql
from cirrus.plans import weather as W
from cirrus.sources.derived import events_readings
from cirrus.sources.local import local_frame
from conftest import SF01

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


def readings(spark, rows):
    """rows: (city, temperature, humidity, wind, visibility, recorded_at[, description, feels_like])"""
    full = []
    for r in rows:
        city, t, h, w, v, ts = r[:6]
        desc = r[6] if len(r) > 6 else "clear sky"
        fl = r[7] if len(r) > 7 else t
        full.append((city, "XX", t, fl, h, 1000, desc, w, v, ts))
    return local_frame(spark, full, S.READINGS_SCHEMA)


def test_rounding_matches_binary_rounding(spark):
    values = [1.005, 0.285, 2.675, -0.004, -1.005, 0.125, 12.345, -2.5e-3, 1e-9, 1234.565]
    exprs = ", ".join(f"{round_sql(repr(v) + 'D', 2)} AS c{i}" for i, v in enumerate(values))
    got = spark.sql(f"SELECT {exprs}").first()
    want = duckdb.sql("SELECT " + ", ".join(f"ROUND({v!r}::DOUBLE, 2)" for v in values)).fetchall()[0]
    for g, w in zip(got, want):
        assert g == w and math.copysign(1, g) == math.copysign(1, w)


def test_means_do_not_depend_on_partitioning(spark):
    r = events_readings(spark, SF01)
    a = {tuple(x) for x in W.avg_temperature_per_city(r).collect()}
    b = {tuple(x) for x in W.avg_temperature_per_city(r.repartition(7)).collect()}
    assert a == b


def test_wind_band_boundaries_and_null(spark):
    rows = [("A", 10.0, 50, w, 5000, T0) for w in (1.49, 1.5, 5.5, 10.69, 10.7, None)]
    out = {(r["wind_category"], r["occurrences"]) for r in W.wind_speed_distribution(readings(spark, rows)).collect()}
    assert out == {("Calm", 1), ("Light Breeze", 1), ("Moderate", 2), ("Strong", 2)}


def test_shares_sum_to_100(spark):
    rows = [("A", 10.0, 50, 1.0, 5000, T0)] * 2 + [("A", 10.0, 50, 7.0, 5000, T0)]
    out = {r["wind_category"]: r["percentage"] for r in W.wind_speed_distribution(readings(spark, rows)).collect()}
    assert out == {"Calm": 66.67, "Moderate": 33.33}


def test_visibility_bands_having_and_unrounded_mean(spark):
    rows = [
        ("A", 1.0, 1, 1.0, 999, T0, "fog"),
        ("A", 1.0, 1, 1.0, 1000, T0, "rain"),
        ("A", 1.0, 1, 1.0, 3999, T0, "mist"),
        ("A", 1.0, 1, 1.0, 4000, T0, "cloud"),
        ("A", 1.0, 1, 1.0, 10000, T0, "clear sky"),
        ("A", 1.0, 1, 1.0, 9999, T0, "haze"),
        ("A", 1.0, 1, 1.0, 10000, T0, "haze"),
    ]
    out = {r["weather_description"]: (r["visibility_category"], r["avg_visibility"], r["min_visibility"])
           for r in W.visibility_impact(readings(spark, rows)).collect()}
    assert out == {
        "fog": ("Severe", 999.0, 999),
        "rain": ("Reduced", 1000.0, 1000),
        "mist": ("Reduced", 3999.0, 3999),
        "cloud": ("Clear", 4000.0, 4000),
        "haze": ("Clear", 9999.5, 9999),
    }


def test_freshness_hour_boundaries(spark):
    as_of = dt.datetime(2024, 3, 2, 12, 1)
    last = {"fresh": dt.datetime(2024, 3, 2, 6, 59), "delayed": dt.datetime(2024, 3, 2, 5, 59),
            "edge24": dt.datetime(2024, 3, 1, 12, 0), "stale": dt.datetime(2024, 3, 1, 11, 59),
            "crossed": dt.datetime(2024, 3, 2, 11, 59)}
    rows = [(c, 1.0, 1, 1.0, 1, ts) for c, ts in last.items()]
    out = {r["city"]: (r["hours_since_last_record"], r["freshness_status"])
           for r in W.data_freshness_per_city(readings(spark, rows), as_of).collect()}
    assert out == {"fresh": (6, "Fresh"), "delayed": (7, "Delayed"), "edge24": (24, "Delayed"),
                   "stale": (25, "Stale"), "crossed": (1, "Fresh")}


def test_correlation_edge_cases(spark):
    rows = [
        ("flat", 5.0, 10, 1.0, 1, T0), ("flat", 5.0, 20, 1.0, 1, T0),      # zero variance -> NaN
        ("one", 5.0, 10, 1.0, 1, T0),                                       # one pair -> NaN
        ("none", None, 10, 1.0, 1, T0), ("none", 4.0, None, 1.0, 1, T0),   # no complete pair -> NULL
        ("pos", 1.0, 1, 1.0, 1, T0), ("pos", 2.0, 2, 1.0, 1, T0), ("pos", 3.0, 3, 1.0, 1, T0),
    ]
    out = {r["city"]: r["temp_humidity_correlation"]
           for r in W.temperature_humidity_correlation(readings(spark, rows)).collect()}
    assert math.isnan(out["flat"]) and math.isnan(out["one"])
    assert out["none"] is None
    assert out["pos"] == 1.0


def test_rank_ties_share_rank_and_skip(spark):
    rows = [("A", 10.0, 1, 1.0, 1, T0), ("B", 10.0, 1, 1.0, 1, T0), ("C", 5.0, 1, 1.0, 1, T0)]
    out = {r["city"]: (r["hottest_rank"], r["coldest_rank"])
           for r in W.hottest_coldest_ranking(readings(spark, rows)).collect()}
    assert out == {"A": (1, 2), "B": (1, 2), "C": (3, 1)}


def test_monthly_change_uses_previous_present_month(spark):
    rows = [("A", 10.0, 1, 1.0, 1, dt.datetime(2024, 1, 5)), ("A", 13.0, 1, 1.0, 1, dt.datetime(2024, 4, 5))]
    out = [(r["month"], r["avg_temperature"], r["change_from_previous_month"])
           for r in W.monthly_temperature_trend(readings(spark, rows)).collect()]
    assert out == [(dt.datetime(2024, 1, 1), 10.0, None), (dt.datetime(2024, 4, 1), 13.0, 3.0)]


def test_continent_map_keeps_unaccented_spelling(spark):
    rows = [("São Paulo", 20.0, 1, 1.0, 1, T0), ("Toronto", 0.0, 1, 1.0, 1, T0), (None, 1.0, 1, 1.0, 1, T0)]
    out = {r["continent"]: (r["city_count"], r["total_readings"])
           for r in W.continent_temperature_ranking(readings(spark, rows)).collect()}
    assert out == {"Other": (1, 2), "Americas": (1, 1)}


def test_anomalies_zero_stddev_and_null_city(spark):
    rows = [("flat", 5.0, 1, 1.0, 1, T0 + dt.timedelta(hours=i)) for i in range(5)]
    rows += [("A", 10.0, 1, 1.0, 1, T0 + dt.timedelta(hours=i)) for i in range(20)]
    rows += [("A", 50.0, 1, 1.0, 1, T0), (None, 500.0, 1, 1.0, 1, T0)]
    out = W.anomaly_detection(readings(spark, rows)).collect()
    assert [(r["city"], r["temperature"], r["is_anomaly"]) for r in out] == [("A", 50.0, True)]


def test_anomaly_top_k_is_deterministic_on_ties(spark):
    base = [("A", 0.0, 1, 1.0, 1, T0 + dt.timedelta(hours=i)) for i in range(400)]
    spikes = [("A", 100.0, 1, 1.0, 1, T0 + dt.timedelta(days=30, hours=i)) for i in range(60)]
    out = W.anomaly_detection(readings(spark, base + spikes)).collect()
    assert len(out) == 50
    assert [r["recorded_at"] for r in out] == sorted(r["recorded_at"] for r in out)
    assert out[0]["recorded_at"] == T0 + dt.timedelta(days=30)


@pytest.mark.parametrize("name", sorted(W.QUERIES))
def test_empty_input_gives_empty_result(spark, name):
    df = W.QUERIES[name](readings(spark, []))
    assert df.collect() == []


def test_rollup_variants_equal_direct_grouping(spark):
    from cirrus.operators.ranking import mapped_rollup_rank, period_over_period
    from cirrus.sources.derived import orders_readings

    o = orders_readings(spark, SF01)
    direct = period_over_period(o, ["city"], "recorded_at", "month", "temperature")
    rolled = period_over_period(o, ["city"], "recorded_at", "month", "temperature", via_day="date")
    assert [tuple(r) for r in direct.collect()] == [tuple(r) for r in rolled.collect()]
    args = (o, "city", S.CONTINENT_OF_CITY, "Other", "temperature", "continent")
    a = mapped_rollup_rank(*args, distinct_alias="city_count")
    b = mapped_rollup_rank(*args, distinct_alias="city_count", via_keys=["city", "country"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_null_last_reading_is_fresh(spark):
    rows = [("ghost", 1.0, 1, 1.0, 1, None), ("live", 1.0, 1, 1.0, 1, T0)]
    out = {r["city"]: (r["hours_since_last_record"], r["freshness_status"])
           for r in W.data_freshness_per_city(readings(spark, rows), T0 + dt.timedelta(hours=30)).collect()}
    assert out == {"ghost": (None, "Fresh"), "live": (30, "Stale")}
