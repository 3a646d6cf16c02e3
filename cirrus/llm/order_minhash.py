"""Near-duplicates by Order MinHash and banded alignment.

The k-mers of a text (runs of three words) are labelled with how often they
occurred before, so that repeated k-mers differ.  For each of several hash
functions the two least labelled k-mers are kept in the order of the text;
texts agree in a sketch if they share both k-mers in that order, which favours
small edit distances over mere overlap.  Short texts have too few k-mers for
that, so they also get their rarest labelled word pairs as keys, so many that
two similar ones always share one.  Texts that share a sketch with very many
others get them as well.
Candidates are verified by a banded alignment of their words: similarity =
1 - edits / words of the longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import BROADCAST_BYTES, Step, cut, id_text, sized, text_key

K = 3  # words of a k-mer
SKETCHES = 64  # hash functions
KEPT = 2  # k-mers of a sketch
SIMILARITY = 0.8
SHORT = 30  # pairs whose longer text has at most so many words are found by exact keys
SMALL = 16  # buckets of at most so many texts are paired out
MIDDLE = 2048  # texts compared with each other at once; buckets over twice that are split by exact keys; sets the cost, never the result
HOT = 65_536  # word pairs that are known to repeat; sets the cost, never the result
BITS = 1024  # of a text's parity signature, from which the least number of edits follows
WIDE = 8192  # of the signatures of long texts, where buckets are compared; sets the cost, never the result
_WORD = r"[^\x20\x09-\x0D]+"
_CELLS = 1 << 16  # hashes held at once while a text is sketched
_FIRST_BAND = 256  # an alignment starts with this band, if the limit is larger
_MASK_BYTES = 128 * 1024 * 1024  # an alignment's bit vectors; beyond it works row by row


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit number for each word, the same in every text."""
    import xxhash

    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.array([known[w] for w in words], dtype=np.uint64)


def kmers(h: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hashes of the k-mers of a text by its word hashes; a text of
    fewer words, but not none, has one."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)] + np.uint64(i + 1))
    return out


def occurrences(h: np.ndarray) -> np.ndarray:
    """How often each value occurred before its place."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    out = np.empty(len(s), dtype=np.uint64)
    out[order] = (np.arange(len(s)) - first).astype(np.uint64)
    return out


def sketch(h: np.ndarray, sketches: int = SKETCHES, kept: int = KEPT, k: int = K) -> np.ndarray:
    """One number for each hash function from a text's word hashes; none for a
    text without words."""
    h = kmers(h, k)
    if len(h) == 0:
        return np.zeros(0, dtype=np.int64)
    labelled = _mix(h + occurrences(h) * np.uint64(0xD1B54A32D192ED03))
    seeds = _mix(np.arange(1, sketches + 1, dtype=np.uint64))
    out = np.empty(sketches, dtype=np.uint64)
    step = max(1, _CELLS // len(h))
    for a in range(0, sketches, step):
        # The labels are mixed already, so a product by an odd number orders them anew.
        y = labelled[None, :] * (seeds[a : a + step, None] | np.uint64(1))
        row = np.arange(len(y))
        at = np.empty((len(y), min(kept, len(h))), dtype=np.int64)
        for j in range(at.shape[1]):
            at[:, j] = y.argmin(axis=1)
            y[row, at[:, j]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        at.sort(axis=1)  # the order of the text
        v = seeds[a : a + step]
        for j in range(at.shape[1]):
            v = _mix(v * np.uint64(0x9E3779B97F4A7C15) + h[at[:, j]])
        out[a : a + step] = v
    return out.view(np.int64)


def _limit(longest: int, least: float = SIMILARITY) -> int:
    """Edits that a pair may have."""
    return int((1 - least) * longest + 1e-9)


def parity(h: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Signature of a text by its word hashes: bits, each flipped by every
    word (labelled with how often it occurred before) that falls on it."""
    at = _mix(h + occurrences(h) * np.uint64(0x8CB92BA72F3D8DD7)) if len(h) else h
    odd = np.bincount((at % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def width(n: int) -> int:
    """Bits of the signature of a text of n words: 4 to 8 a word, a power of two from ``BITS`` to ``WIDE``."""
    return min(WIDE, max(BITS, 1 << (4 * n - 1).bit_length()))


def folded(bits: np.ndarray, n: int) -> np.ndarray:
    """The signature of n numbers that the same text has, from one of as many or more."""
    return np.bitwise_xor.reduce(bits.reshape(-1, n), axis=0)


def labelled_pairs(h: np.ndarray, most: int | None = SHORT) -> np.ndarray:
    """The word pairs of a text of 4 to ``most`` words (None: any number),
    labelled with how often they occurred before, by its word hashes; none for
    other texts."""
    if len(h) < 4 or most and len(h) > most:
        return np.zeros(0, dtype=np.int64)
    h = kmers(h, 2)
    return _mix(h + occurrences(h) * np.uint64(0xA24BAED4963EE407)).view(np.int64)


@lru_cache(10_000)
def pairs_needed(n: int, most: int | None = SHORT) -> int:
    """How many of its labelled pairs, in an order that all texts share, a text
    of n words needs as keys to share one with every similar text of at most
    ``most`` words (None: of any length).

    With e edits, texts of n and l >= n words share at least l - 1 - 2 e of
    their pairs, and any set of n - 1 - (l - 1 - 2 e) + 1 pairs holds one of them."""
    longest = most or int(n / SIMILARITY) + 1
    return max(n - l + 2 * _limit(l) + 1 for l in range(n, longest + 1) if l - n <= _limit(l))


def short_keys(h: np.ndarray, hot: dict[int, int] | None = None, most: int = SHORT) -> np.ndarray:
    """Keys of a text of at most ``most`` words: its first labelled pairs, those
    outside ``hot`` first, then by how often hot ones occur, then by hash."""
    g = labelled_pairs(h, most)
    return rarest(g, len(h), hot or {}, most)


def rarest(g: np.ndarray, n: int, hot: dict[int, int], most: int | None = SHORT) -> np.ndarray:
    """:func:`short_keys` from the labelled pairs of a text of n words."""
    if len(g) == 0:
        return g
    often = np.array([hot.get(x, 0) for x in g.tolist()], dtype=np.int64)
    return g[np.lexsort((g, often))[: pairs_needed(n, most)]]


def _bits(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Edit distance if it is at most ``band``, by bit vectors of the band.

    Bit p of column j stands for row j - band + p of the table, so the band
    moves down with the columns.  ``up`` and ``down`` are the rows where the
    table rises or falls by one from the row above.  The distance is followed
    along the diagonal that ends in the last cell, where it never falls, so a
    pair that passes the band is left at once.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > band:
        return None
    rows, columns = a.tolist(), b.tolist()
    top = 1 << (2 * band)
    full = 2 * top - 1
    goal = 1 << (band + n - m)
    masks: dict[int, tuple[int, int]] = {}  # places of a word in the band, and the column they are for
    for i, w in enumerate(rows[:band]):
        masks[w] = (masks.get(w, (0, 1))[0] | 1 << (band + i), 1)
    up, down, e = full ^ ((1 << band) - 1), 0, n - m
    for j, w in enumerate(columns, 1):
        if j + band <= n:
            enters = rows[j + band - 1]
            mask, since = masks.get(enters, (0, j))
            masks[enters] = (mask >> (j - since) | top, j)
        mask, since = masks.get(w, (0, j))
        equal = mask >> (j - since)
        level = ((((equal & up) + up) ^ up) | equal | down) & full
        if not level & goal:
            e += 1
            if e > band:
                return None
        right = full & (down | ~(level | up))
        left = level & up
        level >>= 1
        up = full & (left | ~(level | right))
        down = level & right
    return e


def _by_row(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """As :func:`_bits`, one row of the band at a time, for very long texts."""
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return None
    d = np.arange(-band, band + 1)
    big = n + m + 1
    cost = np.where((d >= 0) & (d <= m), d, big)
    for i in range(1, n + 1):
        col = i + d
        inside = (col >= 1) & (col <= m)
        other = np.ones(len(d), dtype=np.int64)
        other[inside] = a[i - 1] != b[col[inside] - 1]
        new = np.minimum(cost + other, np.r_[cost[1:] + 1, big])
        new = np.where(inside, new, big)
        if i <= band:
            new[band - i] = i
        new = np.minimum.accumulate(new - d) + d
        new = np.where((col >= 0) & (col <= m), new, big)
        if new.min() > band:
            return None
        cost = new
    e = int(cost[m - n + band])
    return e if e <= band else None


def similar(a: list[str], b: list[str], least: float = SIMILARITY) -> float | None:
    """:func:`aligned` for two lists of words."""
    ids: dict[str, int] = {}
    return aligned(*(np.array([ids.setdefault(w, len(ids)) for w in x], dtype=np.int64) for x in (a, b)), least)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float | None:
    """1 - edits / longer length of two runs of numbered words if it is at
    least ``least``, else None.

    Exact: cheap bounds (length, shared words) only reject pairs that cannot
    reach it; the band grows until it holds the distance or the limit.
    """
    longest = max(len(a), len(b))
    if longest == 0:
        return 1.0
    limit = _limit(longest, least)
    if abs(len(a) - len(b)) > limit:
        return None
    names, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ids[: len(a)], ids[len(a) :]
    shared = np.minimum(np.bincount(x, minlength=len(names)), np.bincount(y, minlength=len(names))).sum()
    if longest - shared > limit:  # each edit mends at most one missing word
        return None
    k = min(len(x), len(y))
    same = x[:k] == y[:k]
    head = k if same.all() else int(np.argmin(same))
    x, y = x[head:], y[head:]
    k = min(len(x), len(y))
    if k:
        same = x[::-1][:k] == y[::-1][:k]
        tail = k if same.all() else int(np.argmin(same))
        x, y = x[: len(x) - tail], y[: len(y) - tail]
    if len(x) == 0 or len(y) == 0:
        e = max(len(x), len(y))
        return 1 - e / longest if e <= limit else None
    band = min(limit, _FIRST_BAND)
    while True:
        run = _bits if len(names) * (band + 1) // 4 <= _MASK_BYTES else _by_row
        e = run(x, y, band)
        if e is not None:
            return 1 - e / longest
        if band >= limit:
            return None
        band = min(limit, 8 * band)


def sketched(docs: DataFrame) -> DataFrame:
    """key of the text, doc_id, its words, its sketches (an array; empty without
    words), its labelled word pairs (empty unless short) and its signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        word = re.compile(_WORD)
        for b in batches:
            hashed = [word_hashes(word.findall(t)) for t in b["text"]]
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "key": b["key"], "size": [len(h) for h in hashed],
                "sketches": [np.unique(sketch(h)) for h in hashed], "pairs": [labelled_pairs(h) for h in hashed],
                "bits": [parity(h) for h in hashed],
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(id_text(), text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    out = rows.mapInPandas(run, "doc_id string, key binary, size int, sketches array<long>, pairs array<long>, bits array<long>")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def chosen(rows: DataFrame, most: int | None = SHORT) -> DataFrame:
    """rows with keys instead of their labelled pairs: the rarest, see :func:`rarest`."""

    def often(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:  # what a batch holds once is hardly frequent
            g, n = np.unique(np.concatenate(b["pairs"].to_list()), return_counts=True)
            yield pd.DataFrame({"g": g[n > 1], "n": n[n > 1]})

    together = rows.select("pairs").coalesce(rows.count() // 2000 + 1)
    counts = together.mapInPandas(often, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    counts = counts.orderBy(F.desc("n"), "g").limit(HOT)
    hot = {r["g"]: r["n"] for r in counts.collect()}

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["keys"] = [rarest(np.asarray(g), n, hot, most) for g, n in zip(b["pairs"], b["size"])]
            yield b[["key", "size", "keys"]]

    return rows.select("key", "size", "pairs").mapInPandas(choose, "key binary, size int, keys array<long>")


def exploded(rows: DataFrame) -> DataFrame:
    """One row for each of a text's keys, s."""
    return rows.select(*[c for c in rows.columns if c != "keys"], F.explode("keys").alias("s"))


def buckets(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """key, size, s of every text that shares a key s with at most ``SMALL`` - 1
    others; and for every text in larger buckets its key, size, signature, the
    keys of those buckets and its degree there, the sum of their sizes."""
    short = chosen(nodes.where(F.size("pairs") > 0))
    rows = nodes.select("key", "size", F.col("sketches").alias("keys")).unionByName(short)
    n = F.count(F.lit(1)).over(Window.partitionBy("s"))
    shared = cut(exploded(rows).withColumn("n", n).where("n > 1"))
    large = shared.where(F.col("n") > SMALL).groupBy("key").agg(F.sum("n").alias("degree"), F.collect_list("s").alias("keys"))
    large = large.join(nodes.select("key", "size", "bits"), "key").select("key", "size", "bits", "degree", "keys")
    return shared.where(F.col("n") <= SMALL).select("key", "size", "s"), cut(large)


def _limit_of(size_a: Column, size_b: Column) -> Column:
    """:func:`_limit` of a pair's longer text."""
    return F.floor((1 - SIMILARITY) * F.greatest(size_a, size_b) + 1e-9)


def _edits_at_least(a: Column, size_a: Column, b: Column, size_b: Column) -> Column:
    """Of two texts by their signatures and lengths.

    A word put for another changes two labelled words, one put in or left out
    changes one; each changed word flips one bit, so differing bits <= 2 edits -
    difference of the lengths."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, n: t + n)
    return F.ceil((differ + F.abs(size_a - size_b)) / 2)


def _may(x: Column, y: Column) -> Column:
    """Whether x and y (size, bits) may be similar: false only if they are not."""
    limit = _limit_of(x["size"], y["size"])
    near = F.abs(x["size"] - y["size"]) <= limit
    return near & (_edits_at_least(x["bits"], x["size"], y["bits"], y["size"]) <= limit)


def candidates(small: DataFrame, large: DataFrame) -> DataFrame:
    """Pairs (a, b, first) of keys to verify, from :func:`buckets`; those that
    are not first need it only where the first ones leave them in two classes.

    A small bucket is paired out.  In a larger one each member is paired with
    the least and the greatest key, which are the same for the many buckets of
    a group, and with the member of the greatest degree: the original of a
    group is in the large buckets of all its sketches, each copy in some.  The
    pairs that this leaves in two classes are those of :func:`remaining`.
    """
    pair = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    few = small.groupBy("s").agg(F.collect_list(F.struct("key", "size")).alias("all"))
    few = few.select("all", F.posexplode("all").alias("i", "x"))
    few = few.select("x", F.explode(F.slice("all", F.col("i") + 2, F.lit(SMALL))).alias("y"))
    few = few.where(F.abs(F.col("x.size") - F.col("y.size")) <= _limit_of(F.col("x.size"), F.col("y.size")))
    few = few.select(F.col("x.key").alias("x"), F.col("y.key").alias("y")).select(*pair, F.lit(True).alias("first"))

    of, hub = Window.partitionBy("s"), F.struct("key", "size", "bits")
    top = F.max(F.struct("degree", *("key", "size", "bits"))).over(of)
    met = exploded(large).select(
        hub.alias("own"), F.array(F.min(hub).over(of), F.max(hub).over(of), top.dropFields("degree")).alias("hubs")
    )
    x = F.col("own")
    met = met.select("own", F.filter("hubs", lambda y: (y["key"] != x["key"]) & _may(x, y)).alias("hubs"))
    met = met.select(x["key"].alias("x"), F.transform("hubs", lambda y: F.struct(
        _edits_at_least(x["bits"], x["size"], y["bits"], y["size"]).alias("edits"), y["key"].alias("y")
    )).alias("hubs"))
    # A group shares hubs over many buckets, so a text's hubs are merged before they are paired with it.
    met = met.groupBy("x").agg(F.array_distinct(F.flatten(F.collect_set("hubs"))).alias("hubs"))
    met = met.select("x", F.array_min("hubs").alias("best"), F.explode("hubs").alias("h")).select(
        "x", "h.y", (F.col("h.y") == F.col("best.y")).alias("first")
    )
    return few.unionByName(met.select(*pair, "first")).groupBy("a", "b").agg(F.max("first").alias("first"))


def unsettled(rows: DataFrame) -> DataFrame:
    """rows (key, label, s, ...) of the keys s whose texts are in two classes or more, with their count n."""
    of = Window.partitionBy("s")
    counts = {"n": F.count(F.lit(1)).over(of), "lo": F.min("label").over(of), "hi": F.max("label").over(of)}
    return rows.withColumns(counts).where("lo <> hi").drop("lo", "hi")


def needed(rows: DataFrame) -> DataFrame:
    """rows (key, label, s, n, ...) of :func:`unsettled` without the keys that another one covers.

    If the texts of a key all have the same largest key, they are all among
    that key's texts, where each pair of them is compared anyway.  A covering
    key is never left out itself: it is the largest of the texts it covers."""
    rows = rows.withColumn("top", F.max(F.struct("n", "s")).over(Window.partitionBy("key"))["s"])
    of = Window.partitionBy("s")
    rows = rows.withColumns({"lo": F.min("top").over(of), "hi": F.max("top").over(of)})
    return rows.where("lo <> hi OR lo = s").drop("top", "lo", "hi")


def remaining(docs: DataFrame, nodes: DataFrame, large: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, label_a, label_b, edits) for every pair of texts in different classes that
    share a large bucket, except pairs that cannot be similar; edits: at least so many.

    Buckets of up to twice ``MIDDLE`` texts are compared by signature.  Larger ones
    are split by the exact keys of short texts, here at any length: of all
    texts in them, similar ones share one of their rarest labelled word pairs,
    so those that share none are left out without having been compared.
    Here long texts get signatures of up to ``WIDE`` bits: in the first ones many of
    their words fall on the same bit, which hides edits.
    """
    x = large.drop("degree").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    x = unsettled(exploded(x)).groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("size", "bits", "label")),
        F.collect_list(F.when(F.col("n") <= 2 * MIDDLE, F.col("s"))).alias("keys"), F.max(F.col("n") > 2 * MIDDLE).alias("wide"),
    )
    x = cut(x)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        word = re.compile(_WORD)
        for b in batches:
            hashed = [word_hashes(word.findall(t)) for t in b["text"]]
            yield pd.DataFrame({
                "key": b["key"], "size": b["size"], "bits": [parity(h, width(len(h))) for h in hashed],
                "pairs": [labelled_pairs(h if w else h[:0], None) for h, w in zip(hashed, b["wide"])],
            })

    asked = F.col("wide") | (4 * F.col("size") > BITS)
    texts = texts_of(docs, nodes, x.where(asked).select("key", "size", "wide"))
    texts = cut(texts.mapInPandas(read, "key binary, size int, bits array<long>, pairs array<long>"))
    keys = chosen(texts.where(F.size("pairs") > 0), None).select("key", "keys")
    rows = x.select("key", "label", "keys").unionByName(x.select("key", "label").join(keys, "key"))
    # Signatures are joined to what is left, so that they are not shuffled with every key.
    rows = cut(needed(unsettled(exploded(rows))))
    signed = x.where(~asked).select("key", "size", "bits").unionByName(texts.select("key", "size", "bits"))
    return compared(rows.join(sized(signed, 128 + WIDE // 8), "key"))


def compared(rows: DataFrame) -> DataFrame:
    """(a, b, label_a, label_b, edits) of all pairs in different classes that share a
    key s and may be similar, from :func:`unsettled` rows.

    A bucket is dealt into parts of about ``MIDDLE`` texts, and any two parts
    are compared as one group, so that no group holds more than two parts.  A
    pair is given once, by the least key that its texts share."""
    rows = rows.withColumn("keys", F.collect_set("s").over(Window.partitionBy("key")))
    parts = F.ceil(F.col("n") / MIDDLE).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
    group = ["s", "i", "j"]
    rows = rows.select(
        "s", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "part", "key", "label", "size", "bits", "keys"
    ).repartition(*group).sortWithinPartitions(*group)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last group of a batch may go on in the next
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            starts = np.flatnonzero((b[group] != b[group].shift()).any(axis=1))
            yield _close(b.iloc[: starts[-1]], starts)
            held = b.iloc[starts[-1] :].reset_index(drop=True)
        if held is not None:
            yield _close(held, np.zeros(1, dtype=np.int64))

    return rows.mapInPandas(compare, "a binary, b binary, label_a binary, label_b binary, edits int")


def _close(b: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """:func:`compared` for whole groups, which begin at ``starts``."""
    out: dict[str, list] = {"a": [], "b": [], "label_a": [], "label_b": [], "edits": []}
    if len(b):
        key, size = b["key"].to_numpy(), b["size"].to_numpy(dtype=np.int64)
        wide = [x.view(np.uint64) for x in b["bits"]]
        bits = np.stack([folded(x, BITS // 64) for x in wide])
        names, label = np.unique(b["label"], return_inverse=True)
        part, mixed = b["part"].to_numpy(), (b["i"] != b["j"]).to_numpy()
        own, keys = b["s"].to_list(), b["keys"].to_list()
        ends = [*starts[starts < len(b)][1:], len(b)]
        for start, end in zip(starts, ends):
            order = start + np.argsort(size[start:end], kind="stable")  # by size, so that those too long for x are left at once
            last = np.searchsorted(size[order], size[order] / SIMILARITY + 1, side="right")
            sets: dict[int, set[int]] = {}  # keys of the group's texts that come near another
            for at, x in enumerate(order):
                y = order[at + 1 : last[at]]
                longest, differ = np.maximum(size[x], size[y]), np.abs(size[x] - size[y])
                limit = ((1 - SIMILARITY) * longest + 1e-9).astype(np.int64)
                ok = (label[y] != label[x]) & (differ <= limit)
                if mixed[x]:
                    ok &= part[y] != part[x]
                y, limit, differ = y[ok], limit[ok], differ[ok]
                edits = (np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64) + differ + 1) // 2
                near = edits <= limit
                for z, e, most, apart in zip(*(v[near].tolist() for v in (y, edits, limit, differ))):
                    n = min(len(wide[x]), len(wide[z]))
                    if n > bits.shape[1]:  # both have wider ones
                        e = (int(np.bitwise_count(folded(wide[x], n) ^ folded(wide[z], n)).sum()) + apart + 1) // 2
                    if e > most:
                        continue
                    for k in (x, z):
                        if k not in sets:
                            sets[k] = set(keys[k].tolist())
                    if min(sets[x] & sets[z]) != own[x]:
                        continue
                    i, j = (x, z) if key[x] < key[z] else (z, x)
                    out["a"].append(key[i])
                    out["b"].append(key[j])
                    out["label_a"].append(names[label[i]])
                    out["label_b"].append(names[label[j]])
                    out["edits"].append(e)
    return pd.DataFrame(out)


def texts_of(docs: DataFrame, nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """keys, distinct ones and what columns they have, with their texts."""
    asked = cut(keys.join(nodes.select("key", "rep"), "key").withColumnsRenamed({"key": "__k", "rep": "__rep"}))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = rows.join(sized(asked, 64), (F.col("key") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__rep")))
    return texts.select("text", *keys.columns).dropDuplicates(["key"])


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b), already cut, whose texts align at ``least`` or more.

    Only texts that are in a pair are read.  Their words are broadcast if they
    are small, else shuffled, once for each side."""
    asked = cut(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    texts = texts_of(docs, nodes, asked)
    size = asked.join(nodes.select("key", "size"), "key").agg(F.sum(8 * F.col("size") + 64)).first()[0] or 0

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        word = re.compile(_WORD)
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "w": [word_hashes(word.findall(t)).tobytes() for t in b["text"]]})

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sides = ((np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)) for x, y in zip(b["w_a"], b["w_b"]))
            yield b.loc[[aligned(x, y, least) is not None for x, y in sides], ["a", "b"]]

    # A text is parsed once, however many pairs it is in.
    numbered = texts.mapInPandas(number, "key binary, w binary")
    if size <= BROADCAST_BYTES:
        numbered, pairs = F.broadcast(numbered), pairs.repartition(pairs.count() // 1000 + 1)
    both = pairs.join(numbered.toDF("a", "w_a"), "a").join(numbered.toDF("b", "w_b"), "b")
    return both.select("a", "b", "w_a", "w_b").mapInPandas(align, "a binary, b binary")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """key and label (the least key of its component) of every key linked to another.

    Each round every key moves to its least neighbour, if that is less, and the
    links are contracted to the keys moved to: links inside what has become one
    key are gone, equal links merge, and a key is only ever followed downwards.
    The least key of a component never moves, so it is the one that is left.
    Keys are hashes, so that a round removes a share of them.  Each round is cut.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    links = Step(links.distinct())
    labels = Step(links.rows.select(F.explode(F.array("a", "b")).alias("key")).distinct().withColumn("label", F.col("key")))
    for _ in range(rounds):
        if links.rows.isEmpty():
            links.drop()
            return labels.rows
        # As a < b, only links in which a key is the greater one can move it.
        step = Step(links.rows.groupBy("b").agg(F.min("a").alias("to")))
        moves = sized(step.rows, 64)
        moved = labels.rows.join(moves.withColumnRenamed("b", "label"), "label", "left")
        labels.put(moved.select("key", F.coalesce("to", "label").alias("label")))
        ends = links.rows.join(moves.withColumnRenamed("to", "to_b"), "b")
        ends = ends.join(moves.toDF("a", "to_a"), "a", "left").withColumn("to_a", F.coalesce("to_a", "a"))
        ends = ends.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        links.put(ends.where("a <> b").distinct())
        step.drop()
    raise RuntimeError("components did not settle")


def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) with their classes label_a, label_b, where these differ."""
    for k in ("a", "b"):
        of = labels.select(F.col("key").alias(k), F.col("label").alias(f"label_{k}"))
        pairs = pairs.join(of, k, "left").withColumn(f"label_{k}", F.coalesce(f"label_{k}", k))
    return pairs.where("label_a <> label_b").select("a", "b", "label_a", "label_b")


def merged(links: DataFrame) -> DataFrame:
    """label and to, the class that each linked class becomes, from links label_a, label_b of classes."""
    return components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).toDF("label", "to")


def relabelled(labels: DataFrame, moves: DataFrame) -> DataFrame:
    """labels after the classes have become others by :func:`merged`; a text that was alone is its own class."""
    moves = sized(moves, 64)
    alone = moves.withColumnRenamed("label", "key").join(labels, "key", "left_anti").toDF("key", "label")
    moved = labels.join(moves, "label", "left").select("key", F.coalesce("to", "label").alias("label"))
    return cut(moved.unionByName(alone))


def linked(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """:func:`components` of the similar texts that share a key.

    Hubs link most of a large bucket; each pair that they leave in two classes
    is then verified, unless a bound or its exact keys rule it out."""
    small, large = buckets(nodes)
    tested = cut(candidates(small, large))
    labels = components(cut(verified(docs, nodes, tested.where("first").select("a", "b"))))
    # The others are needed only between classes that the first ones have left.
    tested, rest = tested.select("a", "b"), cut(labelled(tested.where("not first").select("a", "b"), labels))
    found = cut(verified(docs, nodes, rest.select("a", "b")))
    if not found.isEmpty():
        labels = relabelled(labels, merged(labelled(found, labels)))
    left = cut(remaining(docs, nodes, large, labels))
    # Again each text's most alike one first, and the others where that leaves two classes.
    ends = left.select("a", "b", "edits").union(left.select("b", "a", "edits"))
    best = ends.groupBy("a").agg(F.min(F.struct("edits", "b")).alias("best")).select("a", "best.b")
    best = cut(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = cut(verified(docs, nodes, best))
    rest = left.drop("edits").join(tested.unionByName(best), ["a", "b"], "left_anti")
    if not found.isEmpty():
        moves = merged(labelled(found, labels))
        labels = relabelled(labels, moves)
        for k in ("label_a", "label_b"):
            rest = rest.join(sized(moves.toDF(k, "to"), 64), k, "left").withColumn(k, F.coalesce("to", k)).drop("to")
    rest = cut(rest.where("label_a <> label_b").select("a", "b"))
    found = cut(verified(docs, nodes, rest))
    return labels if found.isEmpty() else relabelled(labels, merged(labelled(found, labels)))


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key) of all documents, and for every distinct text its
    class: key, rep (least id of the text's rows) and class_id (least rep)."""
    nodes = sketched(docs).groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("size", "sketches", "pairs", "bits")), F.min("doc_id").alias("rep")
    )
    nodes = cut(nodes)
    labels = linked(docs, nodes)
    named = nodes.select("key", "rep").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = cut(named)
    ids = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return rows, cut(named.join(ids, "label").select("key", "rep", "class_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and kept of every document.

    class_id is the least id in the document's class, kept marks the row with
    that id.  Texts that are equal are one class, null counts as the empty
    text.  Null ids: such rows take part, and class_id is null only if no row
    of the class has an id.  Repeated rows are answered alike.
    """
    rows, named = classes(docs)
    out = rows.join(named.withColumnRenamed("key", "__k"), F.col("key") == F.col("__k"))
    return out.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` from each class: that of the least id.

    The join is on text and id, over which copies spread evenly; rows that
    share both are left once."""
    _, named = classes(docs)
    keep = cut(named.where(F.col("rep").eqNullSafe(F.col("class_id"))).select(F.col("key").alias("__k"), F.col("rep").alias("__rep")))
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    out = keyed.join(keep, (F.col("__key") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__rep")))
    return out.dropDuplicates(["__key", "doc_id"]).select(*[F.col(c) for c in docs.columns])
