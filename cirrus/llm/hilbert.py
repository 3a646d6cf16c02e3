"""Sharding along a Hilbert curve (DataFrame functions only).

Several metadata columns are quantised to cells, the cells are numbered along
a Hilbert curve, rows are sorted by that number, and the sorted run is cut
into shards of equal row counts.  Rows that are near in every column stay
near in the files, so minima and maxima prune on each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirrus.llm.common import cut, ranked

SHARDS = 8
BITS = 8
DIMENSIONS = ("lang", "source", "size")
_PREFIX = 6  # bytes of a string, after what all values share, that place it


def curve_index(cells: Column, dims: int, bits: int) -> Column:
    """Number along the Hilbert curve of an array of ``dims`` cells below 2**bits.

    The cells are turned into their transposed index level by level from the
    highest bit, then Gray-decoded; the bits of all dimensions are interleaved.
    """

    def level(x: Column, q: Column) -> Column:
        """Undo the turns and reflections of the level with bit ``q``."""
        low = q - 1

        def turn(x: Column, i: Column) -> Column:
            x0, xi = F.get(x, F.lit(0)), F.get(x, i)
            swap = x0.bitwiseXOR(xi).bitwiseAND(low)
            flipped = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
            swapped = F.transform(x, lambda v, j: F.when((j == 0) | (j == i), v.bitwiseXOR(swap)).otherwise(v))
            return F.when(xi.bitwiseAND(q) != 0, flipped).otherwise(swapped)

        return F.aggregate(F.sequence(F.lit(0), F.lit(dims - 1)), x, turn)

    def take_in(x: Column, i: Column) -> Column:
        return F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v))

    def number(x: Column) -> Column:
        last = F.get(x, F.lit(dims - 1))
        mask = F.aggregate(
            levels, F.lit(0).cast("long"), lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a)
        )
        return _interleave(x, mask, dims, bits)

    levels = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])
    gray = F.aggregate(levels, cells, level)
    if dims > 1:
        gray = F.aggregate(F.sequence(F.lit(1), F.lit(dims - 1)), gray, take_in)
    return F.get(F.transform(F.array(gray), number), F.lit(0))


def _interleave(x: Column, mask: Column, dims: int, bits: int) -> Column:
    """Bits of all cells (each xor ``mask``), highest level first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for d in range(dims):
            one = F.shiftright(F.get(x, F.lit(d)).bitwiseXOR(mask), b).bitwiseAND(F.lit(1).cast("long"))
            out = out + F.shiftleft(one, b * dims + dims - 1 - d)
    return out


def _code(value: Column, shared: int) -> Column:
    """Number of a string's first bytes after the ``shared`` characters."""
    raw = F.rpad(F.hex(F.substring(F.encode(F.substring(value, shared + 1, _PREFIX), "UTF-8"), 1, _PREFIX)), 2 * _PREFIX, "0")
    return F.conv(raw, 16, 10).cast("double")


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def cells(df: DataFrame, dimensions: Sequence[str], bits: int) -> Column:
    """Array of cells: 0 for null, else 1 to 2**bits - 1 in the column's order.

    Numbers are placed by their signed logarithm, strings by the bytes that
    follow the prefix which all of them share, other types by their string.
    The ranges come from one aggregate (minimum and maximum of each column).
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    use = {}
    for c in dimensions:
        number = isinstance(kinds[c], T.NumericType)
        use[c] = (number, F.col(c).cast("double") if number else F.col(c).cast("string"))
        if number:
            use[c] = (True, F.when(F.isnan(use[c][1]), F.lit(None)).otherwise(use[c][1]))
    ends = df.agg(*[g(v).alias(f"{n}{i}") for i, (_, v) in enumerate(use.values()) for n, g in (("a", F.min), ("b", F.max))]).first()
    out = []
    for i, (number, v) in enumerate(use.values()):
        a, b = ends[f"a{i}"], ends[f"b{i}"]
        if a is None:
            out.append(F.lit(0).cast("long"))
            continue
        shared = 0 if number else _shared_prefix(a, b)

        def place(x: Column, number=number, shared=shared) -> Column:
            return F.signum(x) * F.log1p(F.least(F.abs(x), F.lit(1e300))) if number else _code(x, shared)

        low, high = place(F.lit(a)), place(F.lit(b))
        top = (1 << bits) - 2
        cell = F.when(high > low, F.floor((place(v) - low) / (high - low) * top)).otherwise(F.lit(0))
        cell = F.least(F.greatest(cell.cast("long"), F.lit(0).cast("long")), F.lit(top).cast("long")) + 1
        out.append(F.coalesce(F.when(v.isNotNull(), cell), F.lit(0).cast("long")))
    return F.array(*out)


def shard(
    rows: DataFrame, dimensions: Sequence[str], ties: Sequence[Column], shards: int = SHARDS, bits: int = BITS,
    wide: bool = False,
) -> DataFrame:
    """``rows`` plus curve, shard (0 to shards - 1) and slot (0, 1, ... in its shard).

    Rows are ranked by curve number, then ``ties``; rank r of n goes to shard
    floor(r * shards / n), so counts differ by one at most.  ``ties`` should
    end in something that tells rows apart; rows equal in all of it are
    interchangeable.  Columns of these names that exist are replaced.
    """
    rows = rows.drop("curve", "shard", "slot")
    at = curve_index(cells(rows, dimensions, bits), len(dimensions), bits)
    rows = ranked(rows.withColumn("curve", at), [F.col("curve"), *ties], rank="__r", wide=wide)
    n = rows.count()
    home = F.expr(f"(__r * {shards}L) div {max(n, 1)}L")
    first = F.expr(f"(((__r * {shards}L) div {max(n, 1)}L) * {n}L + {shards - 1}L) div {shards}L")
    return rows.withColumn("shard", home.cast("int")).withColumn("slot", (F.col("__r") - first).cast("long")).drop("__r")


def sharded_sizes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve of every
    document.  Texts are read once and never shuffled.  Size is the text's
    UTF-8 bytes plus 1 (null: 1); the dimensions are lang, source and size."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", "lang", "source", (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    ties = [F.xxhash64("doc_id", "text_crc32").asc(), F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc()]
    return shard(cut(rows), DIMENSIONS, ties, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All rows and columns of ``docs`` with their shard, slot and curve number."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.withColumn("__size", (F.length(raw) + 1).cast("long"))
    ties = [F.xxhash64("doc_id").asc(), F.col("doc_id").asc_nulls_first(), F.crc32(raw).asc()]
    return shard(rows, ["lang", "source", "__size"], ties, shards, wide=True).drop("__size")
