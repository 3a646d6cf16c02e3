"""Token counts from flat, unindexed token files.

A flat file is a run of token ids in which an end-of-document id follows each
document.  It is stored as rows of equal blocks (file, block, tokens), which
know nothing of documents.  A scan looks for the separator in each block with
one vectorised comparison; prefix scans over the block summaries then stitch
the documents that cross block boundaries and number them.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cirrus.llm.common import cut, id_text
from cirrus.session import ensure_checkpoint_dir

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256  # the free id after the vocabulary
BLOCK = 1 << 16  # tokens a block
CHUNK = 1 << 10  # blocks whose summaries are scanned together
# Fixed value: the split pattern that belongs to these merge ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(spark: SparkSession, path: str = RANKS) -> dict[bytes, int]:
    """Merge ranks from a vocabulary file (a bounded file of some 50,000 lines)."""
    rows = spark.read.text(path if "://" in path else f"file://{path}").where("value <> ''").collect()
    return {base64.b64decode(a): int(b) for a, b in (r["value"].split() for r in rows)}


def write_flat(docs: DataFrame, path: str, ranks: dict[bytes, int], end: int = END, block: int = BLOCK) -> None:
    """Tokenise ``docs`` (doc_id, text) into flat files at ``path``.

    Each task writes one file: its rows' tokens in order, ``end`` after each
    text (null: an empty text).  Two kinds of rows: blocks (file, block,
    tokens as little-endian integers) and names (file, first, ids), the ids of
    the documents in order, without any offset.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    width = "<u2" if end < 1 << 16 else "<u4"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        coder = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        held: list[np.ndarray] = []
        n = blocks = docs_done = 0
        file = None

        def row(b=None, tokens=None, first=None, ids=None):
            return {"file": file, "block": b, "tokens": tokens, "first": first, "ids": ids}

        for b in batches:
            out = []
            if len(b):
                file = int(b["file"].iat[0])
                out.append(row(first=docs_done, ids=b["doc_id"].tolist()))
                docs_done += len(b)
            for t in b["text"]:
                held.append(np.array([*coder.encode_ordinary(t or ""), end], dtype=width))
                n += len(held[-1])
                if n >= block:
                    flat = np.concatenate(held)
                    whole = len(flat) // block
                    for k in range(whole):
                        out.append(row(blocks + k, flat[k * block : (k + 1) * block].tobytes()))
                    blocks += whole
                    held, n = [flat[whole * block :]], len(flat) - whole * block
                if len(out) >= 64:
                    yield pd.DataFrame(out, columns=["file", "block", "tokens", "first", "ids"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["file", "block", "tokens", "first", "ids"])
        if n:
            yield pd.DataFrame([row(blocks, np.concatenate(held).tobytes())], columns=["file", "block", "tokens", "first", "ids"])

    rows = docs.select(id_text(), "text", F.spark_partition_id().alias("file"))
    packed = rows.mapInPandas(pack, "file int, block int, tokens binary, first long, ids array<string>")
    packed.write.option("compression", "zstd").parquet(path)


def scan(blocks: DataFrame, end: int = END, width: str = "<u2") -> DataFrame:
    """One row for each block: n tokens, n_end separators, first (tokens before
    the first), last (place after the last) and inner (lengths of the documents
    between them)."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for file, block, raw in zip(b["file"], b["block"], b["tokens"]):
                ids = np.frombuffer(raw, dtype=width)
                at = np.flatnonzero(ids == end)
                some = len(at) > 0
                inner = (np.diff(at) - 1).tolist()
                out.append((file, block, len(ids), len(at), at[0] if some else None, at[-1] + 1 if some else None, inner))
            yield pd.DataFrame(out, columns=["file", "block", "n", "n_end", "first", "last", "inner"])

    return blocks.select("file", "block", "tokens").mapInPandas(
        search, "file int, block int, n long, n_end long, first long, last long, inner array<long>"
    )


def stitch(summary: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """file, ordinal, n_tokens and closed of every document, from block summaries.

    Two-level prefix scans: within chunks of blocks, then over the chunks of a
    file, so that no window holds all blocks of a large file.  What crosses
    blocks is the number of separators so far, the number of tokens so far and
    the place after the last separator.  A run after the last separator of a
    file is a document that isn't closed.
    """
    s = summary.withColumn("__chunk", F.floor(F.col("block") / chunk))
    inside = Window.partitionBy("file", "__chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("__n", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    s = s.withColumn("__ends", F.coalesce(F.sum("n_end").over(inside), F.lit(0)))
    s = s.withColumn("__after", F.max(F.col("__n") + F.col("last")).over(inside))
    chunks = s.groupBy("file", "__chunk").agg(
        F.sum("n").alias("__cn"), F.sum("n_end").alias("__ce"), F.max(F.col("__n") + F.col("last")).alias("__ca")
    )
    over = Window.partitionBy("file").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("__pn", F.coalesce(F.sum("__cn").over(over), F.lit(0)))
    chunks = chunks.select(
        "file",
        "__chunk",
        "__pn",
        F.coalesce(F.sum("__ce").over(over), F.lit(0)).alias("__pe"),
        F.coalesce(F.max(F.col("__pn") + F.col("__ca")).over(over), F.lit(0)).alias("__pa"),
        F.lead("__chunk").over(Window.partitionBy("file").orderBy("__chunk")).isNull().alias("__last_chunk"),
    )
    s = s.join(chunks, ["file", "__chunk"])
    start = F.col("__pn") + F.col("__n")  # tokens of the file before this block
    after = F.coalesce(F.col("__pn") + F.col("__after"), F.col("__pa"))  # where the open document began
    carried = start - after
    base = F.col("__pe") + F.col("__ends")
    is_last = F.col("__last_chunk") & F.lead("block").over(Window.partitionBy("file", "__chunk").orderBy("block")).isNull()
    tail = F.col("n") - F.coalesce("last", F.lit(0)) + F.when(F.col("n_end") == 0, carried).otherwise(F.lit(0))
    s = s.select("file", "n_end", "inner", (carried + F.col("first")).alias("head"), base.alias("base"), tail.alias("tail"), is_last.alias("is_last"))
    closed = s.where("n_end > 0").select(
        "file", "base", F.posexplode(F.concat(F.array("head"), "inner")).alias("k", "n_tokens")
    )
    closed = closed.select("file", (F.col("base") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    open_ = s.where("is_last and tail > 0").select(
        "file", (F.col("base") + F.col("n_end")).alias("ordinal"), F.col("tail").alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(open_)


def token_counts(docs: DataFrame, ranks_path: str = RANKS, path: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every document, counted in its flat file.

    The files are written to ``path`` or a new folder below the shared
    checkpoint folder, read back and scanned; documents are matched to their
    names by file and ordinal.  A null or empty text has no tokens; repeated
    rows and null ids each keep a row.  Ids may be of any type that survives a
    cast to text and back.
    """
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/flat-{uuid.uuid4().hex}"
    write_flat(docs, path, load_ranks(spark, ranks_path))
    kind = docs.schema["doc_id"].dataType
    flat = spark.read.schema("file int, block int, tokens binary, first long, ids array<string>").parquet(path)
    names = flat.where("ids is not null").select("file", "first", F.posexplode("ids").alias("k", "doc_id"))
    names = names.select("file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    counted = stitch(cut(scan(flat.where("tokens is not null"))))
    return names.join(counted, ["file", "ordinal"]).select(F.col("doc_id").cast(kind).alias("doc_id"), "n_tokens")
