from cirrus.functions.expr import (
    band,
    band_sql,
    day_start_sql,
    hour_index_sql,
    hour_of_day_sql,
    hours_crossed_sql,
    lookup,
    lookup_sql,
    month_start_sql,
    period_start_sql,
    q,
    round_sql,
    round_to,
)
from cirrus.functions.moments import Moments, correlation, merged

__all__ = [
    "Moments",
    "correlation",
    "merged",
    "band",
    "band_sql",
    "day_start_sql",
    "hour_index_sql",
    "hour_of_day_sql",
    "hours_crossed_sql",
    "lookup",
    "lookup_sql",
    "month_start_sql",
    "period_start_sql",
    "q",
    "round_sql",
    "round_to",
]
