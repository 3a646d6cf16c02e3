"""Results follow the data: no stale caches, true means, name clashes."""

from pyspark.sql import functions as F

from cirrus.plans import weather as W
from cirrus.plans.pipelines import analyse
from cirrus.plans.suite import run_suite
from cirrus.sources.derived import events_readings
from conftest import SF001


def cached(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_rows_added_by_another_writer_are_seen(spark, tmp_dir):
    r = events_readings(spark, SF001)
    path = f"{tmp_dir}/readings"
    r.where("city = 'Paris'").write.parquet(path)
    before = cached(spark)
    read = lambda: spark.read.parquet(path)
    assert W.hottest_coldest_ranking(read()).count() == 1
    results, _ = run_suite(read())
    assert results["avg_temperature_per_city"].count() == 1
    r.where("city = 'Tokyo'").write.mode("append").parquet(path)
    assert W.hottest_coldest_ranking(read()).count() == 2
    assert W.temperature_volatility_by_city(read()).count() == 2
    results, _ = run_suite(read())
    assert results["avg_temperature_per_city"].count() == 2
    analyse(spark, read())
    assert cached(spark) == before


def test_means_of_values_with_more_decimals(spark):
    r = events_readings(spark, SF001).limit(4).withColumn("city", F.lit("A")).withColumn("country", F.lit("B"))
    rows = [x.asDict() for x in r.collect()]
    for x, t in zip(rows, (0.004, 0.004, 0.004, 0.010)):
        x["temperature"] = t
    df = spark.createDataFrame([tuple(x[c] for c in r.columns) for x in rows], r.schema)
    assert W.avg_temperature_per_city(df).first()["avg_temperature"] == 0.01


def test_nan_and_infinity_count_as_missing_in_means(spark):
    r = events_readings(spark, SF001)
    odd = r.limit(2).withColumn("temperature", F.lit(float("nan"))).unionByName(
        r.limit(1).withColumn("temperature", F.lit(float("inf")))
    )
    want = {x["city"]: x["avg_temperature"] for x in W.avg_temperature_per_city(r).collect()}
    got = {x["city"]: x["avg_temperature"] for x in W.avg_temperature_per_city(r.unionByName(odd)).collect()}
    assert got == want


def test_columns_named_like_derived_ones(spark):
    r = events_readings(spark, SF001)
    clash = r.withColumns({c: F.lit("oops") for c in ("date", "month", "hour_of_day", "wind_category", "continent")})
    for q in (W.humidity_trends, W.monthly_temperature_trend, W.wind_speed_distribution, W.hourly_weather_pattern,
              W.continent_temperature_ranking, W.daily_temperature_range):
        assert sorted(map(tuple, q(clash).collect()), key=repr) == sorted(map(tuple, q(r).collect()), key=repr)
    a, _ = W.fused_queries(clash)
    b, _ = W.fused_queries(r)
    for name in ("humidity_trends", "monthly_temperature_trend", "continent_temperature_ranking"):
        assert sorted(map(tuple, a[name].collect()), key=repr) == sorted(map(tuple, b[name].collect()), key=repr)
