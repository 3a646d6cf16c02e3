"""Small frames built from a handful of driver-side values.

Used only for bounded bookkeeping (a suite's per-query status, a manifest
row).  They are produced as literal SQL (``inline(array(named_struct...))``)
so the JVM builds them directly: no Python worker is started to decode rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cirrus.functions.expr import lit, q


def _value(v, t: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {t.simpleString()})"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'"
    return f"CAST({lit(v)} AS {t.simpleString()})"


def local_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    fields = schema.fields
    structs = [
        "named_struct(" + ", ".join(f"{lit(f.name)}, {_value(v, f.dataType)}" for f, v in zip(fields, row)) + ")"
        for row in rows
    ]
    if not structs:
        return empty_frame(spark, schema)
    return spark.range(1).selectExpr(f"inline(array({', '.join(structs)}))")


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in schema.fields])
