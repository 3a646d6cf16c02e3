"""Print the physical plans of the key queries (for docs/PLANS.md).

Usage: python tools/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cirrus.operators.quality import quality_report  # noqa: E402
from cirrus.plans import weather as W  # noqa: E402
from cirrus.plans.registry import FRESHNESS_AS_OF  # noqa: E402
from cirrus.session import build_session  # noqa: E402
from cirrus.sources.derived import dirty_readings, events_readings  # noqa: E402


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)  # expression ids only add noise
    text = re.sub(r"file:[^\]]*", "file:...", text)
    return text


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    r = events_readings(spark, sf_dir)
    shown = {
        "Q1 avg_temperature_per_city (standalone)": W.avg_temperature_per_city(r),
        "Q5 weather_condition_frequency (standalone)": W.weather_condition_frequency(r),
        "Q8 anomaly_detection (standalone)": W.anomaly_detection(r),
        "Q16 temperature_volatility_by_city (standalone)": W.temperature_volatility_by_city(r),
        "Quality report (standalone)": quality_report(dirty_readings(r)),
    }
    fused, shared = W.fused_queries(r, FRESHNESS_AS_OF)
    print("# Physical plans\n")
    print("Generated by `tools/show_plans.py` (expression ids removed). Standalone queries")
    print("run one aggregate each; the fused suite computes all aggregate queries from one")
    print("checkpointed GROUPING SETS aggregate.\n")
    for title, df in shown.items():
        print(f"## {title}\n\n```\n{plan(df)}```\n")
    # The shared aggregate itself, as planned before checkpointing.
    specs = {n: b(r) for n, b in W._specs(FRESHNESS_AS_OF, fused=True).items()}
    from cirrus.operators.aggregates import run_specs_fused

    _, agg = run_specs_fused(r, specs, cut=False)
    print(f"## Fused suite: the shared GROUPING SETS aggregate\n\n```\n{plan(agg)}```\n")
    print(f"## Fused suite: Q2 finished from the checkpointed aggregate\n\n```\n{plan(fused['hottest_coldest_ranking'])}```\n")
    print(f"## Fused suite: Q8 (second scan)\n\n```\n{plan(fused['anomaly_detection'])}```\n")
    spark.stop()


if __name__ == "__main__":
    main()
