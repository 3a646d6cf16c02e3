"""Readings derived from the generic test tables.

The test tables (``events``, ``orders``) hold no weather data, so a readings
frame of the right shape is derived from them with integer arithmetic that
gives the same rows in any SQL engine.  The derivation is a single
projection + filter over the scan: the 12-city dimension is a literal array
looked up by index (no join, no shuffle), so it scales with the input.

View E comes from ``events`` (one month of real microsecond timestamps),
view O from ``orders`` (seven years, hour of day added), and the dirty view
plants nulls, out-of-range values and repeated keys for the quality checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cirrus.functions.expr import lit

# ---------------------------------------------------------------------------
# Fixed values of the derivation: the 12-entry city dimension
# (k, city, country, base temperature) in key order.
# ---------------------------------------------------------------------------
CITY_DIM = [
    (0, "Paris", "FR", 15),
    (1, "London", "GB", 12),
    (2, "New York", "US", 18),
    (3, "Tokyo", "JP", 22),
    (4, "Douala", "CM", 28),
    (5, "Berlin", "DE", 13),
    (6, "Lagos", "NG", 30),
    (7, "Sydney", "AU", 20),
    (8, "Nairobi", "KE", 24),
    (9, "São Paulo", "BR", 25),
    (10, "Dubai", "AE", 35),
    (11, "Mumbai", "IN", 32),
]


def _dim(field: int) -> str:
    values = ", ".join(lit(row[field]) for row in CITY_DIM)
    return f"try_element_at(array({values}), CAST(k + 1 AS INT))"


def _readings(src: DataFrame, id_sql: str, h_sql: str, descr_sql: str, ts_sql: str) -> DataFrame:
    n = len(CITY_DIM)
    base = src.selectExpr(
        f"PMOD({id_sql}, {n}) AS k", f"{h_sql} AS h", f"{descr_sql} AS descr", f"{ts_sql} AS recorded_at"
    )
    base_temp = f"CAST({_dim(3)} AS BIGINT)"
    return base.selectExpr(
        f"COALESCE({_dim(1)}, 'unknown') AS city",
        f"COALESCE({_dim(2)}, 'unknown') AS country",
        f"CAST({base_temp} * 100 + h % 1800 - 900 + CASE WHEN h % 97 = 0 THEN 2500 ELSE 0 END AS DOUBLE) / 100"
        " AS temperature",
        f"CAST({base_temp} * 100 + h % 1300 - 750 AS DOUBLE) / 100 AS feels_like",
        "CAST(20 + h % 81 AS BIGINT) AS humidity",
        "CAST(980 + h % 67 AS BIGINT) AS pressure",
        "descr AS weather_description",
        "CAST(h % 1531 AS DOUBLE) / 100 AS wind_speed",
        "CAST(FLOOR(CAST(400 + h % 14983 AS DOUBLE) * k / 6) AS BIGINT) AS visibility",
        "recorded_at",
    )


def readings_from_events(events: DataFrame) -> DataFrame:
    """View E: one reading per event (user -> city, value -> measurements)."""
    return _readings(
        events, "user_id", "CAST(ROUND(value * 100) AS BIGINT) * 7919 + event_id * 31", "event_type", "ts"
    )


def readings_from_orders(orders: DataFrame) -> DataFrame:
    """View O: one reading per order, at order date + (orderkey mod 24) hours."""
    return _readings(
        orders,
        "o_custkey",
        "CAST(ROUND(o_totalprice * 100) AS BIGINT) * 7 + o_orderkey * 31",
        "o_orderpriority",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) + MAKE_DT_INTERVAL(0, CAST(o_orderkey % 24 AS INT), 0, 0)",
    )


def dirty_readings(readings: DataFrame) -> DataFrame:
    """Readings with planted faults (nulls, out-of-range values, repeated
    keys) over the seven checked columns."""
    faulty = readings.selectExpr(
        "CASE WHEN humidity = 21 AND pressure % 5 = 0 THEN NULL ELSE city END AS city",
        "country",
        "CASE WHEN humidity = 22 THEN CAST(NULL AS DOUBLE) WHEN humidity = 23 THEN 200D "
        "WHEN humidity = 24 THEN -100D ELSE temperature END AS temperature",
        "CAST(CASE WHEN pressure = 981 THEN 150 WHEN pressure = 982 THEN -10 ELSE humidity END AS BIGINT) AS humidity",
        "CAST(CASE WHEN humidity = 25 THEN 500 ELSE pressure END AS BIGINT) AS pressure",
        "CASE WHEN humidity = 26 THEN -5D ELSE wind_speed END AS wind_speed",
        "recorded_at",
    )
    repeated = readings.where("humidity = 30").select(
        "city", "country", "temperature", "humidity", "pressure", "wind_speed", "recorded_at"
    )
    return faulty.unionByName(repeated)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"))


def orders_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_orders(load_table(spark, sf_dir, "orders"))
