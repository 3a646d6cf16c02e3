"""Stored tables with atomic, repeatable writes.

A table is a folder: ``data/__batch=<name>`` for each batch of rows and
``_commits/<number>.json``, one small entry for each batch, in order.  Rows are
written to a new folder first and count only once their entry is there, so a
run that dies half-way leaves a folder that no reader sees.  A batch has an id:
committing an id again changes nothing, so a run can be repeated.  An entry
that replaces starts the table anew; the folders before it stay until
``vacuum``, so a failed replacement leaves the old rows readable.

Entries are put in place by a rename after their number was claimed by an
exclusive create, so two writers never share one.
"""

from __future__ import annotations

import json
import logging
import threading
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

ONLY = "rows"  # name of the part of a batch that has just one


@dataclass(frozen=True)
class Batch:
    number: int
    batch_id: str
    folder: str
    rows: int
    replaces: bool
    schema: dict[str, str]  # by part, as JSON
    info: dict[str, str]  # what the writer noted


_ENTRY = ("number int, batch_id string, folder string, rows long, replaces boolean, schema map<string,string>, "
          "info map<string,string>")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path_of = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path_of(folder))] if fs.exists(path_of(folder)) else []


def is_committed_table(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has a commit log (perhaps without an entry yet)."""
    fs, path_of = _fs(spark, path)
    return fs.exists(path_of(f"{path}/_commits"))


def batches(spark: SparkSession, path: str) -> list[Batch]:
    """The batches that make up the table now: those since the last
    replacement, in order, the first of each id.

    One small file a batch, read by Spark and collected (a listing, no rows)."""
    if not any(n.endswith(".json") for n in _names(spark, f"{path}/_commits")):
        return []
    out: dict[str, Batch] = {}
    for r in spark.read.schema(_ENTRY).json(f"{path}/_commits/*.json").orderBy("number").collect():
        if r["replaces"] and r["batch_id"] not in out:
            out = {}
        out.setdefault(r["batch_id"], Batch(**{**r.asDict(), "info": r["info"] or {}}))
    return list(out.values())


# A local file system looks for a file and creates it in two steps, between which another writer's thread may claim it.
_CLAIMS = threading.Lock()


def _commit(spark: SparkSession, path: str, entry: dict) -> None:
    log_folder = f"{path}/_commits"
    fs, path_of = _fs(spark, path)
    fs.mkdirs(path_of(log_folder))
    with _CLAIMS:
        number = max((int(n.split(".")[0]) for n in _names(spark, log_folder) if n[0].isdigit()), default=0) + 1
        while not fs.createNewFile(path_of(f"{log_folder}/{number:010d}.claim")):
            number += 1
    draft = path_of(f"{log_folder}/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"number": number, **entry}).encode()))
    out.close()
    if not fs.rename(draft, path_of(f"{log_folder}/{number:010d}.json")):
        raise OSError(f"could not commit batch {entry['batch_id']} to {path}")


def commit_parts(
    spark: SparkSession,
    path: str,
    batch_id: str,
    parts: Mapping[str, DataFrame],
    replaces: bool = False,
    partition_by: str | None = None,
    info: Mapping[str, str] | None = None,
    greatest: str | None = None,
) -> int:
    """Write the ``parts`` of a batch and commit them together.

    Returns the rows written.  0, and nothing written, if the table has the id
    already; 0, and nothing kept, if all parts turn out empty (unless the batch
    replaces: then it empties the table).  The greatest value of the column
    ``greatest`` is observed while writing and noted in the entry."""
    path = path.rstrip("/")
    if any(b.batch_id == batch_id for b in batches(spark, path)):
        log.info("batch %s of %s is committed already", batch_id, path)
        return 0
    folder = f"data/__batch=b{uuid.uuid4().hex}"
    rows, schema, noted = 0, {}, dict(info or {})
    for name, df in parts.items():
        obs = Observation()
        seen = [F.count(F.lit(1)).alias("rows")]
        if greatest:
            seen.append(F.max(greatest).cast("string").alias("greatest"))
        w = df.observe(obs, *seen).write
        (w.partitionBy(partition_by) if partition_by else w).parquet(f"{path}/{folder}/__part={name}")
        got = obs.get
        rows += int(got.get("rows", 0))
        if got.get("greatest") is not None:
            noted[f"greatest:{greatest}"] = got["greatest"]
        schema[name] = df.schema.json()
    if rows == 0 and not replaces:
        fs, path_of = _fs(spark, path)
        fs.delete(path_of(f"{path}/{folder}"), True)
        return 0
    entry = {"batch_id": batch_id, "folder": folder, "rows": rows, "replaces": replaces, "schema": schema, "info": noted}
    _commit(spark, path, entry)
    return rows


def append(
    df: DataFrame, path: str, batch_id: str | None = None, partition_by: str | None = None, greatest: str | None = None
) -> int:
    """Append the rows as one batch; without an id, each call is a new batch.

    Columns go by name; a table's columns are those of its first batch, and
    other ones are refused.  Appending nothing writes nothing, creates nothing
    and returns 0."""
    spark = df.sparkSession
    stored = batches(spark, path)
    if stored:
        columns = T.StructType.fromJson(json.loads(stored[0].schema[ONLY])).names
        missing, extra = set(columns) - set(df.columns), set(df.columns) - set(columns)
        if missing or extra:
            raise ValueError(f"schema mismatch appending to {path}: missing {sorted(missing)}, extra {sorted(extra)}")
        df = df.select(*columns)
    return commit_parts(spark, path, batch_id or uuid.uuid4().hex, {ONLY: df}, partition_by=partition_by, greatest=greatest)


def replace(df: DataFrame, path: str, batch_id: str | None = None, greatest: str | None = None) -> int:
    """Make ``df``, which may read the table itself, its only rows.

    Readers see the old rows until the new ones are complete; if writing
    fails, they keep seeing them."""
    spark = df.sparkSession
    return commit_parts(spark, path, batch_id or uuid.uuid4().hex, {ONLY: df}, replaces=True, greatest=greatest)


def greatest_of(some: list[Batch], column: str) -> str | None:
    """Greatest value of a column that was noted for every batch with a value."""
    return max((b.info[f"greatest:{column}"] for b in some if f"greatest:{column}" in b.info), default=None)


def read_batches(spark: SparkSession, path: str, some: list[Batch], part: str = ONLY) -> DataFrame | None:
    """Rows of the given batches only; None if there are none."""
    if not some:
        return None
    path = path.rstrip("/")
    schema = T.StructType.fromJson(json.loads(some[0].schema[part]))
    # Folders are named like partitions, so that batches may be partitioned further.
    folders = [f"{path}/{b.folder}/__part={part}" for b in some]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read(spark: SparkSession, path: str, part: str = ONLY) -> DataFrame | None:
    """The committed rows; None if nothing was ever committed."""
    return read_batches(spark, path, batches(spark, path), part)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete folders that no current batch uses; how many.

    Only while nobody writes to the table or reads rows from before a
    replacement: a folder whose entry is still to come goes as well."""
    fs, path_of = _fs(spark, path)
    used = {b.folder for b in batches(spark, path)}
    gone = [n for n in _names(spark, f"{path}/data") if f"data/{n}" not in used]
    for n in gone:
        fs.delete(path_of(f"{path}/data/{n}"), True)
    return len(gone)
