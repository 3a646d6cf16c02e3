import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cirrus.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .appName("cirrus-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cirrus-test-")


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for sf, name in ((SF001, "s001"), (SF01, "s01")):
        con.execute(f"CREATE SCHEMA {name}")
        for t in ("events", "orders"):
            con.execute(f"CREATE VIEW {name}.{t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def norm_rows(cols, rows):
    """Order-insensitive, column-order-insensitive comparable form."""
    import math

    def n(v):
        if isinstance(v, float) and math.isnan(v):
            return ("nan",)
        if hasattr(v, "isoformat"):
            return ("t", v.isoformat())
        return (type(v).__name__ if v is not None else "null", repr(v) if isinstance(v, float) else str(v))

    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(n(r[i]) for i in order) for r in rows)
