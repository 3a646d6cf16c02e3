"""Periodic runs: stretches of a sequence that repeat with a small period.

A run is a stretch of words with smallest period q (words q apart are equal)
of at least ``max(6, 4 q)`` words that no neighbouring word extends.

Words q apart that are equal give *matches*; the run of period q from ``s`` to
``e`` is the interval of matches from ``s + q`` to ``e``, at least 3 q long.
Documents are exploded into overlapping tiles, one set for each octave of
periods, P to 2 P.  Boundaries stand 2 P apart, so every run of the octave is
crossed by one that is followed by at least P + 1 matches.  A tile is solved on
its own: windows after its boundaries that occur one period before (by a
rolling hash, so the rest costs a few vector operations) are measured by two
Z-functions, forward and backward from the boundary, which give the matches of
every period of the octave in time linear in the tile.  The pieces, intervals
of matches by document and period, are shuffled by document and period and
stitched where they meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import BROADCAST_BYTES, cut, text_key, words
from cirrus.llm.merkle import crc32_duck

LEAST_WORDS = 6  # shortest run
LEAST_PERIODS = 4  # of a run
TILE_WORDS = 2048  # words that a tile adds at least; the margins come on top
BATCH_WORDS = 1 << 20  # words that a worker handles at once


def _z(s: list[int]) -> list[int]:
    """Longest common prefix of ``s`` with each of its suffixes."""
    n, left, right = len(s), 0, 0
    z = [0] * n
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primes_of(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] if q > 1 else out


def _candidates(x: np.ndarray, at: np.ndarray, room: np.ndarray, octave: int) -> np.ndarray:
    """Which boundaries ``at`` are followed by words that also stand one period
    of the octave before them, at most ``room`` words back (by a hash: a few
    may not be, none is missed)."""
    step, span = 1 << octave, _span(octave)
    mix = np.uint64(0x9E3779B97F4A7C15)
    # The words of a window weighted by powers, from one prefix sum.
    power = np.cumprod(np.full(len(x), mix), dtype=np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * power, dtype=np.uint64)))
    window = (total[span:] - total[:-span]) * power[::-1][: len(x) - span + 1]
    back = at[:, None] - np.arange(step, 2 * step)
    same = (window[np.maximum(back, 0)] == window[at][:, None]) & (at[:, None] - back <= room[:, None])
    return same.any(axis=1)


def _span(octave: int) -> int:
    """Matches after the first boundary inside a run, at least."""
    return 4 if octave == 0 else (1 << octave) + 1


def _measure(x: np.ndarray, c: int, octave: int) -> Iterator[tuple[int, int, int]]:
    """(period, first, past) of the matches round boundary ``c`` of one tile,
    for the primitive periods (no multiple of a shorter one) of the octave."""
    step, span = 1 << octave, _span(octave)
    low = max(0, c - 4 * step)
    near, b = x[low : c + span + 2 * step].tolist(), c - low
    head, whence = near[b:], max(0, b - 2 * step + 1)
    # None equals no word, so no match runs past the pattern.
    z = _z([*head, None, *near[whence:]])
    tail = near[max(0, b - 2 * step) : b][::-1]
    y = _z([*tail, None, *near[:b][::-1]])
    behind = len(tail) + 1
    for q in range(step, min(2 * step - 1, b) + 1):
        ahead = z[len(head) + 1 + b - q - whence]
        if ahead >= span and not any(y[behind + q // p] >= q - q // p for p in _primes_of(q)):
            yield q, c - (y[behind + q] if q < b else 0), c + ahead


def solve_tiles(x: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray, octave: int) -> list[tuple]:
    """Pieces (tile, period, first, past) of tiles of one octave that lie one
    after the other in ``x``: intervals of matches, numbered from each tile's
    start, round its boundaries from ``first`` to before ``last``."""
    step, span = 1 << octave, _span(octave)
    starts = ends[:-1]
    # Boundaries with a whole window after them.
    n = np.maximum(0, -(-(np.minimum(last, np.diff(ends) - span + 1) - first) // (2 * step)))
    tile = np.repeat(np.arange(len(n)), n)
    place = first[tile] + 2 * step * (np.arange(len(tile)) - np.repeat(np.cumsum(n) - n, n))
    if not len(tile):
        return []
    found = _candidates(x, starts[tile] + place, place, octave)
    out: list[tuple] = []
    open_at: dict[int, int] = {}  # period -> place in ``out`` of this tile's last piece
    before = -1
    for t, c in zip(tile[found].tolist(), place[found].tolist()):
        if t != before:
            open_at, before = {}, t
        for q, s, e in _measure(x[ends[t] : ends[t + 1]], c, octave):
            k = open_at.get(q)
            if k is not None and s <= out[k][3]:
                out[k] = (t, q, out[k][2], max(e, out[k][3]))
            else:
                open_at[q] = len(out)
                out.append((t, q, s, e))
    return out


def tiles(docs: DataFrame, symbols: Column, keys: list[str], least: int = TILE_WORDS) -> DataFrame:
    """One row for each tile: ``keys``, octave, offset (place of the tile's
    first symbol), first (of its boundaries, from the offset) and symbols.

    Octaves go up to the longest period that fits a document LEAST_PERIODS times."""
    steps = "shiftleft(2L, octave)"
    core = f"greatest({least}L, 4 * {steps}) div {steps} * {steps}"
    # A tile holds 4 P symbols before its first boundary and 3 P + 4 after its last one.
    piece = f"""transform(sequence(0L, (size(symbols) - 1) div ({core})), t -> named_struct(
        'offset', greatest(0L, t * {core} - 2 * {steps}),
        'first', t * {core} - greatest(0L, t * {core} - 2 * {steps}),
        'last', (t + 1) * {core} - greatest(0L, t * {core} - 2 * {steps}),
        'symbols', slice(symbols, cast(greatest(0L, t * {core} - 2 * {steps}) + 1 as int), cast({core} + 3 * {steps} + 8 as int))))"""
    # Outer explodes, since from inner ones a filter on the array's size is
    # derived, which would be pushed to the scan and split the text anew there.
    octave = f"""CASE WHEN size(symbols) >= {LEAST_WORDS} THEN
        sequence(0, length(bin(size(symbols) div {LEAST_PERIODS})) - 1) ELSE array() END"""
    octaves = docs.select(*keys, symbols.alias("symbols"))
    octaves = octaves.select(*keys, "symbols", F.explode_outer(F.expr(octave)).alias("octave")).where("octave IS NOT NULL")
    rows = octaves.select(*keys, "octave", F.explode_outer(F.expr(piece)).alias("tile"))
    return rows.select(*keys, "octave", "tile.*")


def pieces(tiled: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, period, first and past of every piece of every tile."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tiled.select(*keys).schema)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Tiles of an octave together, about BATCH_WORDS words at a time.
            lengths = whole.column("symbols").value_lengths().to_numpy(zero_copy_only=False)
            octaves = whole.column("octave").to_numpy(zero_copy_only=False)
            for octave in np.unique(octaves):
                rows = np.flatnonzero(octaves == octave)
                part = np.cumsum(lengths[rows]) // BATCH_WORDS
                for some in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
                    b = whole.take(pa.array(some))
                    at = {n: b.column(n).to_numpy(zero_copy_only=False) for n in ("offset", "first", "last")}
                    x = b.column("symbols").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    ends = np.concatenate(([0], np.cumsum(lengths[some], dtype=np.int64)))
                    got = solve_tiles(x, ends, at["first"], at["last"], int(octave))
                    if got:
                        made = np.array(got, dtype=np.int64)
                        made[:, 2:] += at["offset"][made[:, 0]][:, None]
                        picked = b.take(pa.array(made[:, 0]))
                        yield pa.RecordBatch.from_arrays(
                            [picked.column(k) for k in keys] + [pa.array(made[:, j]) for j in (1, 2, 3)],
                            names=[*keys, "period", "first", "past"],
                        )

    return tiled.mapInArrow(solve, f"{kinds}, period long, first long, past long")


def runs(docs: DataFrame, symbols: Column, keys: list[str], least: int = TILE_WORDS) -> DataFrame:
    """Runs of every document: ``keys``, start, length and period.

    Pieces of one document and period are stitched where they meet; rows that
    repeat in ``keys`` and symbols give the same pieces and thus count once."""
    by = [*keys, "period"]
    order = Window.partitionBy(*by).orderBy("first", "past")
    found = pieces(tiles(docs, symbols, keys, least), keys)
    reach = F.max("past").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("first") <= reach, 0).otherwise(1)
    stitched = found.withColumn("__new", fresh).withColumn("__n", F.sum("__new").over(order))
    whole = stitched.groupBy(*by, "__n").agg(F.min("first").alias("first"), F.max("past").alias("past"))
    out = whole.select(
        *keys,
        (F.col("first") - F.col("period")).alias("start"),
        (F.col("past") - F.col("first") + F.col("period")).alias("length"),
        "period",
    )
    return out.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period")))


def planted(docs: DataFrame, to: str = "__w") -> DataFrame:
    """``docs`` and the words of ``text``; where crc32 of the id is a multiple
    of 10, the words from a certain place on repeat with a certain period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # A null id is never a multiple.
    return docs.withColumn("__o", words(F.col("text"))).withColumn("__h", F.coalesce(h, F.lit(1).cast("long"))).withColumn(
        to,
        F.expr("""
        CASE WHEN __h % 10 <> 0 OR size(__o) = 0 THEN __o ELSE
          transform(__o, (w, i) -> CASE WHEN i < (__h div 10) % size(__o) THEN w ELSE
            __o[cast((__h div 10) % size(__o) + (i - (__h div 10) % size(__o))
              % (1 + (size(__o) - (__h div 10) % size(__o)) div (3 + (__h div 10) % 8)) as int)] END) END""")
    ).drop("__o", "__h")


def run_lists(docs: DataFrame, text_words: str, keys: list[str], least: int = TILE_WORDS) -> DataFrame:
    """``keys`` and ``runs``, all runs of a document by start, then period (a
    document of n words has fewer than n); only documents that have any."""
    symbols = F.transform(F.col(text_words), lambda w: F.xxhash64(w))
    got = runs(docs, symbols, keys, least)
    return got.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def periodic_documents(docs: DataFrame, least: int = TILE_WORDS) -> DataFrame:
    """Runs of every whole text of ``documents``, with the greatest one and the
    text without the repeats.

    Null, empty and blank texts have no words: no runs, four nulls, digests of
    the empty text.  A null id is kept and never altered.  Repeated rows each
    give a row; equal ids with different texts stay apart.  Columns other than
    doc_id and text are left alone; an empty table gives no rows.
    """
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    found = cut(run_lists(planted(texts), "__w", ["doc_id", "text_key"], least))
    found = found.withColumnsRenamed({"doc_id": "__id", "text_key": "__k"})
    # Broadcast only at a measured size; beyond it the texts are shuffled.
    size = found.agg(F.sum(80 + 24 * F.size("runs"))).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found
    same = texts["doc_id"].eqNullSafe(found["__id"]) & (texts["text_key"] == found["__k"])
    return described(planted(texts.join(found, same, "left")))


def described(rows: DataFrame, text_words: str = "__w") -> DataFrame:
    """The result columns from doc_id, the words and ``runs`` (null: none)."""
    runs_of = F.coalesce(F.col("runs"), F.expr("CAST(array() AS array<struct<start:bigint,period:bigint,length:bigint>>)"))
    d = rows.withColumn("runs", runs_of).withColumn(
        # Exact: a run beats the one before it only if its exponent is greater.
        "__top",
        F.expr("aggregate(runs, get(runs, 0), (a, x) -> CASE WHEN x.length * a.period > a.length * x.period THEN x ELSE a END)"),
    )
    # Words of a run after its first period are dropped: what lies between such stretches stays.
    gaps = F.expr("""
        aggregate(
          array_sort(transform(runs, r -> named_struct('a', r.start + r.period, 'b', r.start + r.length))),
          named_struct('past', 0L, 'kept', CAST(array() AS array<struct<a:bigint,b:bigint>>)),
          (s, d) -> named_struct('past', greatest(s.past, d.b),
            'kept', IF(d.a > s.past, concat(s.kept, array(named_struct('a', s.past, 'b', d.a))), s.kept)))""")
    kept = f"""flatten(transform(
        concat(__gaps.kept, array(named_struct('a', __gaps.past, 'b', CAST(size({text_words}) AS bigint)))),
        k -> slice({text_words}, CAST(k.a + 1 AS int), CAST(k.b - k.a AS int))))"""
    d = d.withColumn("__gaps", gaps)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    collapsed = F.when(F.size("runs") == 0, F.concat_ws(" ", F.col(text_words))).otherwise(F.concat_ws(" ", F.expr(kept)))
    return d.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("__top.start").alias("start"),
        F.col("__top.length").alias("length"),
        F.col("__top.period").alias("period"),
        F.expr("1000 * __top.length div __top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"),
        F.sha2(collapsed, 256).alias("collapsed_sha256"),
    )


_H = crc32_duck("doc_id::VARCHAR")

ORACLE_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce({_H}, 1)::BIGINT AS h,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS o
  FROM documents),
places AS (SELECT *, len(o) AS n, (h // 10) % greatest(len(o), 1) AS a, 3 + (h // 10) % 8 AS parts FROM split),
docs AS (
  SELECT id, doc_id, n, CASE WHEN h % 10 <> 0 OR n = 0 THEN o
    ELSE list_transform(range(n), lambda i: o[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % (1 + (n - a) // parts) + 1 END]) END AS w
  FROM places),
words AS (SELECT id, n, unnest(range(n)) AS i, unnest(w) AS word FROM docs),
-- Five equal words in a row, q apart: the longest stretches of matches follow from them.
grams AS (
  SELECT id, n, i, word AS a, lead(word, 1) OVER (PARTITION BY id ORDER BY i) AS b, lead(word, 2) OVER (PARTITION BY id ORDER BY i) AS c,
         lead(word, 3) OVER (PARTITION BY id ORDER BY i) AS d, lead(word, 4) OVER (PARTITION BY id ORDER BY i) AS e
  FROM words),
equal AS (
  SELECT y.id, y.i, y.i - x.i AS q
  FROM grams x JOIN grams y ON x.id = y.id AND x.a = y.a AND x.b = y.b AND x.c = y.c AND x.d = y.d AND x.e = y.e
    AND x.i < y.i AND y.i - x.i <= y.n // 4),
islands AS (SELECT id, q, i, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT id, q, min(i) - q AS start, max(i) + 5 - min(i) + q AS length FROM islands GROUP BY id, q, island
  HAVING max(i) + 5 - min(i) + q >= greatest(6, 4 * q)),
-- A stretch whose smallest period is shorter is that period's stretch.
runs AS (SELECT id, start, length, min(q) AS period FROM stretches GROUP BY id, start, length),
found AS (
  SELECT id, count(*) AS n_runs, list({{'s': start, 'l': length, 'p': period}} ORDER BY start, period) AS r,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY id),
best AS (
  SELECT *, list_reduce(r, lambda x, y: CASE WHEN y.l * x.p > x.l * y.p THEN y ELSE x END) AS top FROM found),
dropped AS (
  SELECT DISTINCT id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (id, i) GROUP BY id)
SELECT d.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.top.s AS start, b.top.l AS length, b.top.p AS period,
       1000 * b.top.l // b.top.p AS exponent_milli, sha256(coalesce(b.lines, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN best b USING (id) LEFT JOIN kept k USING (id)
"""
