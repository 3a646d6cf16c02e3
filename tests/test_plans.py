"""Physical plans: pruning, pushdown, join strategy, map-side combine."""

from cirrus.operators.joins import size_checked_broadcast
from cirrus.plans import weather as W
from cirrus.sources.derived import events_readings
from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = plan(W.temperature_humidity_correlation(events_readings(spark, SF001)))
    # city, temperature and humidity derive from user_id, value and event_id only.
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in p


def test_aggregates_combine_map_side(spark):
    p = plan(W.avg_temperature_per_city(events_readings(spark, SF001)))
    assert "partial_sum" in p and "partial_max" in p and "stddev_samp(" not in p


def test_anomaly_broadcasts_only_the_moments(spark):
    p = plan(W.anomaly_detection(events_readings(spark, SF001)))
    assert "BroadcastHashJoin" in p and "BuildRight" in p
    assert "SortMergeJoin" not in p
    assert "TakeOrderedAndProject" in p


def test_size_check_falls_back_to_shuffled_join(spark):
    r = events_readings(spark, SF001)
    stats = r.groupBy("city").count()
    assert "ResolvedHint" in size_checked_broadcast(stats, 10_000)._jdf.queryExecution().analyzed().toString()
    big = size_checked_broadcast(stats, 50)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()


def test_readings_view_needs_no_join(spark):
    p = plan(events_readings(spark, SF001))
    assert "Join" not in p and "Exchange" not in p


def test_anomaly_join_without_broadcast_gives_same_rows(spark):
    from cirrus import schema as S
    from cirrus.operators.outliers import zscore_outliers

    r = events_readings(spark, SF001)
    a = zscore_outliers(r, [S.CITY], S.TEMPERATURE, S.RECORDED_AT, 2.0, 50)
    b = zscore_outliers(r, [S.CITY], S.TEMPERATURE, S.RECORDED_AT, 2.0, 50, max_broadcast_bytes=0)
    assert "BroadcastHashJoin" not in plan(b) or "BroadcastHashJoin" in plan(a)
    assert [tuple(x) for x in a.collect()] == [tuple(x) for x in b.collect()]


def test_hot_key_holding_most_rows(spark):
    """One city with most of the rows: same answers as without the skew."""
    r = events_readings(spark, SF001)
    hot = r.selectExpr("CASE WHEN humidity % 3 <> 0 THEN 'Paris' ELSE city END AS city",
                       *[c for c in r.columns if c != "city"])
    share = hot.where("city = 'Paris'").count() / hot.count()
    assert share > 1 / 3
    groups = W.avg_temperature_per_city(hot).collect()
    assert sum(x["record_count"] for x in groups) == hot.count()
    assert len(W.anomaly_detection(hot).collect()) <= 50
