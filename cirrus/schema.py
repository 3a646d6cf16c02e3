"""Readings schema and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the readings table.
CITY = "city"
COUNTRY = "country"
TEMPERATURE = "temperature"
FEELS_LIKE = "feels_like"
HUMIDITY = "humidity"
PRESSURE = "pressure"
DESCRIPTION = "weather_description"
WIND_SPEED = "wind_speed"
VISIBILITY = "visibility"
RECORDED_AT = "recorded_at"

READINGS_SCHEMA = T.StructType(
    [
        T.StructField(CITY, T.StringType(), True),
        T.StructField(COUNTRY, T.StringType(), True),
        T.StructField(TEMPERATURE, T.DoubleType(), True),
        T.StructField(FEELS_LIKE, T.DoubleType(), True),
        T.StructField(HUMIDITY, T.LongType(), True),
        T.StructField(PRESSURE, T.LongType(), True),
        T.StructField(DESCRIPTION, T.StringType(), True),
        T.StructField(WIND_SPEED, T.DoubleType(), True),
        T.StructField(VISIBILITY, T.LongType(), True),
        T.StructField(RECORDED_AT, T.TimestampNTZType(), True),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference behaviour for results to
# agree; they are data, stated as given.
# ---------------------------------------------------------------------------

# Columns the required-columns check looks for, in reporting order.
REQUIRED_COLUMNS = ["city", "country", "temperature", "humidity", "pressure", "wind_speed", "recorded_at"]
# Columns whose null cells the null check counts.
CRITICAL_COLUMNS = ["city", "temperature", "humidity", "recorded_at"]
# Inclusive valid ranges.
TEMP_MIN, TEMP_MAX = -80.0, 60.0
HUMIDITY_MIN, HUMIDITY_MAX = 0, 100
PRESSURE_MIN, PRESSURE_MAX = 800, 1100
WIND_SPEED_MIN, WIND_SPEED_MAX = 0.0, 100.0
# Key of the duplicate check.
DUPLICATE_KEY = ["city", "recorded_at"]

# Wind bands: (upper bound exclusive, label); the last label takes the rest.
WIND_BANDS = [(1.5, "Calm"), (5.5, "Light Breeze"), (10.7, "Moderate")]
WIND_ELSE = "Strong"

# Visibility bands on the group mean, and the HAVING bound.
VISIBILITY_BANDS = [(1000, "Severe"), (4000, "Reduced")]
VISIBILITY_ELSE = "Clear"
VISIBILITY_HAVING_BELOW = 10000

# Freshness thresholds in hours (strictly greater than).
FRESHNESS_STALE_HOURS = 24
FRESHNESS_DELAYED_HOURS = 6

# City -> continent map of the continent ranking.  "Sao Paulo" is spelled
# without the accent here while the data spells "São Paulo"; kept as is, so
# that city falls into "Other".
CONTINENT_OF_CITY = {
    "Paris": "Europe",
    "London": "Europe",
    "Berlin": "Europe",
    "New York": "Americas",
    "Toronto": "Americas",
    "Sao Paulo": "Americas",
    "Tokyo": "Asia",
    "Mumbai": "Asia",
    "Dubai": "Asia",
    "Lagos": "Africa",
    "Douala": "Africa",
    "Nairobi": "Africa",
    "Sydney": "Oceania",
}
CONTINENT_ELSE = "Other"

# Sample generator: base temperature and country of each tracked city, and
# the weather descriptions drawn from.
SAMPLE_CITIES = [
    ("Paris", "FR", 15),
    ("London", "GB", 12),
    ("New York", "US", 18),
    ("Tokyo", "JP", 22),
    ("Douala", "CM", 28),
    ("Berlin", "DE", 13),
    ("Lagos", "NG", 30),
    ("Sydney", "AU", 20),
    ("Nairobi", "KE", 24),
    ("São Paulo", "BR", 25),
    ("Dubai", "AE", 35),
    ("Mumbai", "IN", 32),
]
SAMPLE_DESCRIPTIONS = ["clear sky", "few clouds", "light rain", "overcast clouds", "moderate rain"]
SAMPLE_HOURS = 240
