"""cirrus — readings analytics on Spark.

A readings table holds one row per (place, time) measurement.  The package
loads such tables (Parquet, JDBC, incremental by high-water mark), checks
their quality, answers a library of parameterised analytical questions and
writes results as Parquet.  Every operator is a ``DataFrame -> DataFrame``
function built from Spark's own relational operators and built-in functions;
nothing is computed on the driver beyond bounded, already-aggregated results.

Layout
------
``functions``  column expressions shared by the operators (rounding, exact
               means, guarded correlation, calendar buckets, bands)
``operators``  generic operators: profiles, shares, rankings, trends,
               outliers, freshness, quality checks
``plans``      the named weather queries, the suite and the pipelines
``sources``    readers (Parquet, JDBC, derived fixture views, sample data)
``streaming``  incremental (high-water-mark) loading and appending
``sinks``      Parquet export with a manifest
"""

from cirrus.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
