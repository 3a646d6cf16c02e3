"""Calendar results do not depend on the session time zone (naive timestamps)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from conftest import SF001, norm_rows

TIME_QUERIES = ["humidity_trends", "hourly_weather_pattern", "data_freshness_per_city",
                "monthly_temperature_trend", "freshness_per_user", "incremental_load"]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_results_ignore_session_zone(spark, duck, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        q, sql = queries(), oracle_sql()
        cur = duck.cursor()
        cur.execute("SET schema = 's001'")
        for name in TIME_QUERIES:
            df = q[name](spark, SF001)
            res = cur.execute(sql[name])
            ocols = [d[0] for d in res.description]
            assert norm_rows(df.columns, [tuple(r) for r in df.collect()]) == norm_rows(ocols, res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
