"""Synthetic readings for development: tracked cities x hourly steps.

Generated by Spark itself: one ``range`` of steps x cities, the city
attributes looked up from a literal array by index (no join), seeded
Gaussian/uniform noise per column.  Rows are produced on the executors, so
any size can be generated without passing through the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus import schema as S
from cirrus.functions.expr import ntz, round_to


def generate_readings(
    spark: SparkSession,
    hours: int = S.SAMPLE_HOURS,
    base_time: dt.datetime | None = None,
    seed: int = 42,
    cities: list[tuple[str, str, int]] | None = None,
    descriptions: list[str] | None = None,
) -> DataFrame:
    """``hours`` hourly readings back from ``base_time`` for every city.

    Temperature ~ N(base, 3), feels-like ~ N(base - 1, 2) (2 decimals);
    humidity ~ N(65, 15) clipped to [0, 100], pressure ~ N(1013, 10) clipped
    to [800, 1100] (truncated to integers); wind ~ |N(5, 3)|; visibility ~
    N(10000, 2000); description uniform over ``descriptions``.
    """
    cities = cities or S.SAMPLE_CITIES
    descriptions = descriptions or S.SAMPLE_DESCRIPTIONS
    base_time = (base_time or dt.datetime.now()).replace(microsecond=0)
    n = len(cities)
    k = (F.col("id") % n).cast("int")
    step = (F.col("id") / n).cast("int")

    def attr(i: int):
        return F.element_at(F.array(*[F.lit(c[i]) for c in cities]), k + 1)

    def noise(mean: float, sd: float, s: int):
        return F.lit(mean) + F.randn(seed + s) * F.lit(sd)

    def clip(x, lo, hi):
        return F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi)))

    base = attr(2).cast("double")
    pick = (F.rand(seed + 6) * len(descriptions)).cast("int") + 1
    return spark.range(hours * n).select(
        attr(0).alias(S.CITY),
        attr(1).alias(S.COUNTRY),
        round_to(base + noise(0.0, 3.0, 0), 2).alias(S.TEMPERATURE),
        round_to(base + noise(-1.0, 2.0, 1), 2).alias(S.FEELS_LIKE),
        clip(noise(65.0, 15.0, 2), 0, 100).cast("bigint").alias(S.HUMIDITY),
        clip(noise(1013.0, 10.0, 3), 800, 1100).cast("bigint").alias(S.PRESSURE),
        F.element_at(F.array(*[F.lit(d) for d in descriptions]), pick).alias(S.DESCRIPTION),
        round_to(F.abs(noise(5.0, 3.0, 4)), 2).alias(S.WIND_SPEED),
        noise(10000.0, 2000.0, 5).cast("bigint").alias(S.VISIBILITY),
        (ntz(base_time) - F.make_dt_interval(F.lit(0), step, F.lit(0), F.lit(0))).alias(
            S.RECORDED_AT
        ),
    )
