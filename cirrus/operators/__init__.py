from cirrus.operators.aggregates import Stat, grouped_stats
from cirrus.operators.freshness import freshness
from cirrus.operators.outliers import grouped_correlation, zscore_outliers
from cirrus.operators.profiles import grouped_profile, hour_of_day_profile, paired_gap, period_profile
from cirrus.operators.quality import check, quality_report, report_summary
from cirrus.operators.ranking import mapped_rollup_rank, period_over_period, rank_groups, volatility_rank
from cirrus.operators.ranks import add_ranks
from cirrus.operators.shares import banded_share, category_share, grouped_band

__all__ = [
    "Stat",
    "add_ranks",
    "banded_share",
    "category_share",
    "check",
    "freshness",
    "grouped_band",
    "grouped_correlation",
    "grouped_profile",
    "grouped_stats",
    "hour_of_day_profile",
    "mapped_rollup_rank",
    "paired_gap",
    "period_over_period",
    "period_profile",
    "quality_report",
    "rank_groups",
    "report_summary",
    "volatility_rank",
    "zscore_outliers",
]
