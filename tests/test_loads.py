"""Tables at rest, incremental loading by high-water mark, JDBC loads."""

import datetime as dt
import glob
import os

import pytest

from cirrus import schema as S
from cirrus.sources.jdbc import jdbc_full_load, jdbc_incremental_load, with_retries
from cirrus.sources.local import empty_frame, local_frame
from cirrus.sources.tables import append_or_create, conform, read_readings, read_target, replace_table, run_sql
from cirrus.streaming.incremental import high_water_mark, incremental_load, incremental_run, newer_than

T0 = dt.datetime(2026, 6, 1, 12, 0)


def rows(city="Paris", n=5, start=T0, temp0=15.0):
    return [(city, "FR", temp0 + i, temp0, 60, 1010, "clear sky", 3.0, 10000, start - dt.timedelta(hours=i))
            for i in range(n)]


def frame(spark, data):
    return local_frame(spark, data, S.READINGS_SCHEMA)


def test_mark_is_none_for_missing_and_empty(spark, tmp_dir):
    target = os.path.join(tmp_dir, "readings")
    assert high_water_mark(spark, target) is None
    append_or_create(empty_frame(spark, S.READINGS_SCHEMA), target)
    assert high_water_mark(spark, target) is None


def test_create_then_append_keeps_rows(spark, tmp_dir):
    target = os.path.join(tmp_dir, "readings")
    assert append_or_create(frame(spark, rows()), target) == 5
    assert high_water_mark(spark, target) == T0
    later = rows("London", 1, T0 + dt.timedelta(hours=1))
    # Columns in another order are aligned by name, not position.
    shuffled = frame(spark, later).select(*reversed(S.READINGS_SCHEMA.fieldNames()))
    assert append_or_create(shuffled, target) == 1
    stored = read_readings(spark, target)
    assert stored.count() == 6
    assert high_water_mark(spark, target) == T0 + dt.timedelta(hours=1)
    assert stored.where("city = 'London'").first()["temperature"] == 15.0


def test_empty_append_is_a_no_op(spark, tmp_dir):
    target = os.path.join(tmp_dir, "readings")
    append_or_create(frame(spark, rows()), target)
    assert append_or_create(empty_frame(spark, S.READINGS_SCHEMA), target) == 0
    assert read_readings(spark, target).count() == 5


def test_incremental_run_moves_the_mark(spark, tmp_dir):
    target = os.path.join(tmp_dir, "readings")
    source = frame(spark, rows(n=5))
    assert incremental_run(spark, source, target).count() == 5        # first run: full load
    assert incremental_run(spark, source, target).count() == 5        # nothing newer
    newer = frame(spark, rows(n=5) + rows("Paris", 2, T0 + dt.timedelta(hours=2)))
    out = incremental_run(spark, newer, target)
    assert out.count() == 7
    assert high_water_mark(spark, target) == T0 + dt.timedelta(hours=2)


def test_incremental_run_with_nothing_anywhere(spark, tmp_dir):
    out = incremental_run(spark, empty_frame(spark, S.READINGS_SCHEMA), os.path.join(tmp_dir, "x"))
    assert out.count() == 0 and out.columns == S.READINGS_SCHEMA.fieldNames()


def test_mark_is_strict(spark):
    src = frame(spark, rows(n=3))
    assert incremental_load(src, T0 - dt.timedelta(hours=1)).count() == 1
    assert incremental_load(src, None).count() == 3


def test_lazy_mark_pushes_into_the_scan(spark, tmp_dir):
    target = os.path.join(tmp_dir, "src")
    append_or_create(frame(spark, rows(n=10)), target)
    src = read_readings(spark, target)
    stored = src.where(f"recorded_at <= TIMESTAMP_NTZ'{(T0 - dt.timedelta(hours=4)).isoformat(sep=' ')}'")
    out = newer_than(read_target(spark, target), stored)
    assert out.count() == 4
    assert "GreaterThan(recorded_at" in out._jdf.queryExecution().executedPlan().toString()


def test_replace_and_run_sql(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    append_or_create(frame(spark, rows(n=5)), target)
    assert replace_table(frame(spark, rows(n=2)), target) == 2
    from pyspark.sql import Observation

    obs = Observation("q")
    df = run_sql(spark, "SELECT city, COUNT(*) AS n FROM r GROUP BY city", {"r": read_readings(spark, target)}, obs)
    assert [tuple(r) for r in df.collect()] == [("Paris", 2)]
    assert obs.get["rows"] == 1


def test_conform_casts_and_normalises_nan(spark):
    df = spark.range(2).selectExpr("CAST(id AS INT) AS humidity", "CAST('NaN' AS DOUBLE) AS temperature", "'x' AS other")
    out = conform(df)
    assert dict(out.dtypes) == {"humidity": "bigint", "temperature": "double", "other": "string"}
    assert out.first()["temperature"] is None


def test_retries_reraise_the_last_error():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        return "ok"

    assert with_retries(flaky, 3, 0.0) == "ok"
    calls.clear()
    try:
        with_retries(lambda: (_ for _ in ()).throw(OSError("always")), 2, 0.0)
    except OSError as e:
        assert "always" in str(e)
    else:
        raise AssertionError("expected the error")


def test_jdbc_loads_over_embedded_derby(spark):
    url = "jdbc:derby:memory:cirrus_readings;create=true"
    data = rows(n=40) + rows("London", 40)
    frame(spark, data).write.format("jdbc").option("url", url).option("dbtable", "weather_data").mode(
        "overwrite"
    ).save()
    full = jdbc_full_load(spark, url, rows_per_partition=10, max_retries=1)
    assert full.rdd.getNumPartitions() > 1
    assert full.count() == 80
    assert dict(full.dtypes)["recorded_at"] == "timestamp_ntz"
    assert full.agg({"recorded_at": "max"}).first()[0] == T0
    mark = T0 - dt.timedelta(hours=3)
    inc = jdbc_incremental_load(spark, url, mark, rows_per_partition=10, max_retries=1)
    assert inc.count() == 6


def _history(spark):
    """Nulls, one crowded time, one crowded minute, and a sparse year."""
    times = [None] * 7 + [T0] * 120 + [T0 + dt.timedelta(seconds=i % 60, microseconds=i) for i in range(200)]
    times += [T0 - dt.timedelta(days=i) for i in range(1, 300)]
    data = [("O'Hare" if i % 3 else "Orly", "US", float(i), 0.0, 1, 1, "d", 1.0, 1, t) for i, t in enumerate(times)]
    return data


def test_slices_are_even_and_hold_every_row_once(spark):
    url = "jdbc:derby:memory:cirrus_slices;create=true"
    data = _history(spark)
    w = frame(spark, data).write.format("jdbc").option("url", url).option("createTableColumnTypes", "city VARCHAR(64)")
    w.option("dbtable", "weather_data").mode("overwrite").save()
    full = jdbc_full_load(spark, url, rows_per_partition=50, max_retries=1)
    sizes = [len(p) for p in full.select("temperature").rdd.glom().collect()]
    assert sum(sizes) == len(data) and max(sizes) <= 81 and len(sizes) >= len(data) // 50
    assert sorted(r[0] for r in full.select("temperature").collect()) == sorted(d[2] for d in data)
    assert full.where("recorded_at IS NULL").count() == 7
    for mark in (T0, T0 + dt.timedelta(seconds=3, microseconds=5), T0 + dt.timedelta(days=9)):
        newer = jdbc_incremental_load(spark, url, mark, rows_per_partition=50, max_retries=1)
        want = sorted(d[2] for d in data if d[-1] is not None and d[-1] > mark)
        assert sorted(r[0] for r in newer.select("temperature").collect()) == want


def test_jdbc_times_do_not_depend_on_the_session_zone(spark):
    url = "jdbc:derby:memory:cirrus_zone;create=true"
    frame(spark, rows(n=30)).write.format("jdbc").option("url", url).option("dbtable", "weather_data").mode("overwrite").save()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = jdbc_incremental_load(spark, url, T0 - dt.timedelta(hours=4), rows_per_partition=2, max_retries=1)
        assert sorted(r[0] for r in got.select("recorded_at").collect()) == [T0 - dt.timedelta(hours=h) for h in (3, 2, 1, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_incremental_run_from_jdbc(spark, tmp_dir):
    url = "jdbc:derby:memory:cirrus_inc;create=true"
    frame(spark, rows(n=5)).write.format("jdbc").option("url", url).option("dbtable", "weather_data").mode(
        "overwrite"
    ).save()
    target = os.path.join(tmp_dir, "readings")
    mark = high_water_mark(spark, target)
    src = jdbc_incremental_load(spark, url, mark, max_retries=1)
    assert incremental_run(spark, src, target).count() == 5
    frame(spark, rows("London", 2, T0 + dt.timedelta(hours=2))).write.format("jdbc").option("url", url).option(
        "dbtable", "weather_data"
    ).mode("append").save()
    mark = high_water_mark(spark, target)
    src = jdbc_incremental_load(spark, url, mark, max_retries=1)
    assert src.count() == 2
    assert incremental_run(spark, src, target).count() == 7
    assert high_water_mark(spark, target) == T0 + dt.timedelta(hours=2)


def test_day_partitioned_store_prunes_the_mark(spark, tmp_dir):
    target = os.path.join(tmp_dir, "by_day")
    first = frame(spark, rows(n=30))                        # spans two days
    assert incremental_run(spark, first, target, day_partition="event_date").count() == 30
    days = glob.glob(os.path.join(target, "data", "*", "__part=rows", "event_date=*"))
    assert sorted(os.path.basename(d) for d in days) == ["event_date=2026-05-31", "event_date=2026-06-01"]
    assert high_water_mark(spark, target, day_partition="event_date") == T0
    newer = frame(spark, rows(n=30) + rows("Paris", 3, T0 + dt.timedelta(hours=14)))   # into the next day
    out = incremental_run(spark, newer, target, day_partition="event_date")
    assert out.count() == 33
    assert high_water_mark(spark, target, day_partition="event_date") == T0 + dt.timedelta(hours=14)
    pruned = read_readings(spark, target).where("event_date = DATE'2026-06-02'").agg({"recorded_at": "max"})
    assert "PartitionFilters: [isnotnull(event_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_plain_folders_of_others(spark, tmp_dir):
    """A Parquet folder without a log is read, appended to and marked as it is."""
    target = os.path.join(tmp_dir, "plain")
    frame(spark, rows(n=30)).selectExpr("*", "to_date(recorded_at) AS event_date").write.partitionBy("event_date").parquet(target)
    assert high_water_mark(spark, target, day_partition="event_date") == T0
    assert append_or_create(frame(spark, rows()).where("false"), target, "event_date") == 0
    assert append_or_create(frame(spark, rows("London", 2)), target, "event_date") == 2
    assert read_readings(spark, target).count() == 32
    with pytest.raises(ValueError, match="not a committed table"):
        replace_table(frame(spark, rows()), target)
