"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Each document of a source is expected ``rate = target / source size`` times.
Expected copies are prefix-summed in a fixed order within the source, one
random offset is added, and the document is emitted once for every integer
the running sum crosses.  Documents are ordered by size, so the words taken
differ from the target by less than the source's longest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut, ranked, words

WEIGHTS = (1, 2, 3)  # by the source's rank in code point order, repeating
MAX_COPIES = 3
SEED = "mix-1"


def text_size(text: Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.size(words(text)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """Targets by source from ``sizes`` (source, source_size; one row each).

    The sum of all sizes is shared by weight.  A target stops at ``most``
    times its source's size and the excess is shared again among the others:
    target = min(most * size, level * weight) for one common level.  With the
    sources sorted by most * size / weight, every source before some place is
    capped, and the level follows from prefix sums over that order.
    """
    s = cut(sizes.select(F.col("source").alias("source"), F.col("source_size").cast("long").alias("source_size")))
    s = ranked(s, [F.col("source").asc_nulls_last()], rank="__k")
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__k") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", most * F.col("source_size")).withColumn("__ratio", F.col("cap") / F.col("weight"))
    s = ranked(
        s.drop("__k"),
        [F.col("__ratio").asc(), F.col("source").asc_nulls_first()],
        rank="__k",
        totals={"__cap_before": F.col("cap"), "__weight_before": F.col("weight").cast("long")},
    )
    s = cut(s.drop("__k"))
    whole = s.agg(F.sum("source_size").alias("__all"), F.sum("weight").alias("__weights"))
    s = s.crossJoin(F.broadcast(whole))  # one row
    s = s.withColumn("__num", F.col("__all") - F.col("__cap_before")).withColumn(
        "__den", F.col("__weights") - F.col("__weight_before")
    )
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    free = exact("__num") * exact("weight") <= exact("cap") * exact("__den")
    # The first source that is not capped gives the level, as an exact fraction.
    level = s.where(free).agg(F.min_by(F.struct("__num", "__den"), F.struct("__ratio", F.coalesce("source", F.lit("")))).alias("__level"))
    s = s.drop("__num", "__den").crossJoin(F.broadcast(level))  # one row
    share = F.col("weight") * F.col("__level")["__num"] / F.col("__level")["__den"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(share.cast("double"), F.col("cap").cast("double")))
    return s.select("source", "source_size", target.alias("target"))


def random_offset(source: Column) -> Column:
    """One offset in [0, 1) for each source, from its name."""
    name = F.concat_ws(":", F.lit(SEED), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, size: Column, wide: bool = False) -> DataFrame:
    """``docs`` plus size, source_size, target and copies (0 to 3).

    ``docs`` needs doc_id and source; ``size`` is an expression over it.
    Columns of these names that exist are replaced.  Order within a source:
    size, then a hash of the id, then the id; so results don't depend on
    partitioning, and rows that agree in all three are interchangeable.  A
    null source is a source; null ids come first.  ``wide`` says that rows
    carry texts.
    """
    d = docs.withColumn("size", size)
    sizes = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("__rate", rate).withColumn("__offset", random_offset(F.col("source")))
    d = d.drop("source_size", "target", "copies")
    order = [
        F.col("source").asc_nulls_last(),
        F.col("size").asc(),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).asc(),
        F.col("doc_id").asc_nulls_first(),
    ]
    d = ranked(d, order, ["source"], "__k", wide=wide, per_group=targets)
    before = F.floor(F.col("__k") * F.col("__rate") + F.col("__offset"))
    after = F.floor((F.col("__k") + 1) * F.col("__rate") + F.col("__offset"))
    return d.withColumn("copies", (after - before).cast("long")).drop("__k", "__rate", "__offset")


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (copies times size) and copies
    of every document.  Texts are read once and never shuffled."""
    rows = cut(docs.select("doc_id", "source", text_size(F.col("text")).alias("size")))
    return mix(rows, F.col("size")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix, each repeated as often as it was taken, with the
    columns of ``docs`` as they were.

    Null texts, and texts without words, have size 0 and may be taken; repeated
    rows count each on their own; an empty table gives no rows."""
    hidden = {c: f"__in_{c}" for c in docs.columns if c.lower() in ("size", "source_size", "target", "copies")}
    out = mix(docs.withColumnsRenamed(hidden), text_size(F.col("text")), wide=True).where(F.col("copies") > 0)
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*[F.col(hidden.get(c, c)).alias(c) for c in docs.columns])
