"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.session import ensure_checkpoint_dir

# Largest side, by counted rows times the width of a row, that is broadcast;
# above it the join shuffles both sides, with AQE splitting skewed partitions.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_STRING_BYTES = 64


def row_bytes(df: DataFrame) -> int:
    """Bytes to allow for a row: 16 for each column, more for variable lengths."""
    wide = ("string", "binary", "array", "map", "struct")
    return sum(16 + (_STRING_BYTES if t.startswith(wide) else 0) for _, t in df.dtypes)


def size_checked_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``small`` marked for broadcast if it really is at most ``max_bytes``.

    ``small`` is usually an aggregate whose planner estimate is meaningless
    (Spark sizes an aggregate like its input).  It is computed once, into the
    checkpoint folder, and counted there.  Nothing stays cached.
    """
    ensure_checkpoint_dir(small.sparkSession)
    small = small.checkpoint(eager=True)
    return F.broadcast(small) if small.count() * row_bytes(small) <= max_bytes else small
