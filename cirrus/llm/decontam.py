"""Benchmark decontamination over a distributed positional inverted index
(DataFrame functions only).

Every window of ten words of a test item is searched by its rarest terms, by
their count in all documents.  Postings (term, text, position) are kept of
those terms.  Shifting a posting by the term's place in the item gives the
alignment of item and text; a window's posting lists are intersected on that
alignment.  What remains is compared word for word (exact phrases) or by the
spread of the shifted positions (proximity).

Texts are keyed by 128 bits of their content, so the postings of copies
collapse while they are aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut, sized, text_key

WINDOW = 10
RAREST = 2  # terms of a window whose lists are intersected
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms(text: Column) -> Column:
    """Words (runs of ASCII letters, digits and all beyond ASCII) with A-Z lower-cased.

    lower() does just that in a text of ASCII only; it would change other capitals,
    which stay, also ones newer than the tables of regular expressions."""
    t = F.coalesce(text, F.lit(""))
    ascii_lower = F.when(t.rlike(r"[^\x00-\x7F]"), F.translate(t, _UPPER, _UPPER.lower())).otherwise(F.lower(t))
    return F.filter(F.split(ascii_lower, _GAP), lambda w: w != "")


def indexed(docs: DataFrame) -> DataFrame:
    """key and terms of every whole text."""
    return docs.select(text_key(F.col("text")).alias("key"), terms(F.col("text")).alias("__w"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item (its id as text; null: ''), test (a key of its words) and words of
    every item that has words."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), terms(F.col("text")).alias("words"))
    key = F.unhex(F.md5(F.concat_ws(" ", "words").cast("binary")))
    return b.where(F.size("words") > 0).select("item", key.alias("test"), "words")


def tests_of(items: DataFrame, texts: DataFrame, size: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """One row for each distinct test: test, words, length (of its windows) and
    wins, its windows (s, the start; at, the rarest places in it).

    A test with fewer than ``size`` words is one window.  Windows with a term
    that no text has cannot occur and are left out.
    """
    tests = items.select("test", "words").dropDuplicates(["test"])
    vocab = cut(tests.select(F.explode("words").alias("t")).distinct())
    seen = (
        texts.select(F.explode("__w").alias("term"))
        .join(sized(vocab, 64), F.col("term") == F.col("t"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = tests.select("test", F.posexplode("words").alias("p", "term"))
    counted = places.join(sized(cut(seen), 72), "term", "left").groupBy("test")
    counted = counted.agg(F.sort_array(F.collect_list(F.struct("p", F.coalesce("n", F.lit(0)).alias("n")))).alias("c"))  # one item
    d = tests.join(counted, "test").withColumn("length", F.least(F.lit(size), F.size("words")))

    def window(s: Column) -> Column:
        inside = F.slice(F.col("c"), s + 1, F.col("length"))
        by_count = F.sort_array(F.transform(inside, lambda x: F.struct(x["n"].alias("n"), x["p"].alias("p"))))
        first = F.slice(by_count, 1, rarest)
        return F.struct(s.alias("s"), F.get(by_count, F.lit(0))["n"].alias("least"), F.transform(first, lambda x: x["p"]).alias("at"))

    wins = F.filter(F.transform(F.sequence(F.lit(0), F.size("words") - F.col("length")), window), lambda x: x["least"] > 0)
    return d.select("test", "words", "length", wins.alias("wins")).where(F.size("wins") > 0)


def shifted_postings(texts: DataFrame, tests: DataFrame) -> DataFrame:
    """test, key, shift, p: the postings of the anchors, each less its place p."""
    at = tests.select("test", "words", F.explode(F.array_distinct(F.flatten(F.transform("wins", lambda x: x["at"])))).alias("p"))
    at = cut(at.select("test", "p", F.get("words", F.col("p")).alias("t")))
    postings = texts.select("key", F.posexplode("__w").alias("pos", "term"))
    found = postings.join(sized(at, 112), F.col("term") == F.col("t"))
    return found.select("test", "key", (F.col("pos") - F.col("p")).alias("shift"), "p")


def phrases(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, rarest: int = RAREST
) -> tuple[DataFrame, DataFrame]:
    """Exact occurrences (test, key, start, length) of every test window in the
    texts of ``docs``, and the items (item, test, words)."""
    items = cut(items_of(benchmark))
    texts = indexed(docs)
    tests = cut(tests_of(items, texts, size, rarest))
    lists = shifted_postings(texts, tests).groupBy("test", "key", "shift").agg(F.collect_set("p").alias("ps"))
    ps = F.col("ps")
    both = F.filter("wins", lambda x: F.size(F.array_except(x["at"], ps)) == 0)
    met = lists.join(sized(tests, 4096), "test").select("test", "key", "shift", "words", "length", both.alias("wins"))
    met = met.where(F.size("wins") > 0).withColumn("wins", F.transform("wins", lambda x: x["s"]))
    met = cut(met.groupBy("key").agg(F.collect_list(F.struct("test", "shift", "words", "length", "wins")).alias("met")))
    # Texts without a candidate are dropped in the scan, by a narrow list of keys.
    asked = sized(met.select(F.col("key").alias("__k")), 32)
    there = docs.select(text_key(F.col("text")).alias("key"), "text").join(asked, F.col("key") == F.col("__k"), "left_semi")
    there = there.join(met, "key")
    there = there.select("key", terms(F.col("text")).alias("__w"), F.explode("met").alias("m"))
    w, m = F.col("__w"), F.col("m")

    def same(s: Column) -> Column:
        begin = m["shift"] + s
        return (begin >= 0) & (F.slice(w, F.greatest(begin, F.lit(0)) + 1, m["length"]) == F.slice(m["words"], s + 1, m["length"]))

    out = there.select("key", m["test"].alias("test"), m["length"].alias("length"), m["shift"].alias("shift"), F.explode(F.filter(m["wins"], same)).alias("s"))
    out = out.select("test", "key", (F.col("shift") + F.col("s")).alias("start"), "length")
    return cut(out.distinct()), items


def proximity(docs: DataFrame, benchmark: DataFrame, slack: int = 5, size: int = WINDOW, rarest: int = 3) -> DataFrame:
    """test, key, s, shift: windows (start s) whose rarest terms all occur with
    shifts at most ``slack`` apart, so words may be added, dropped or swapped
    between them.  One row for each lowest shift.

    Shifts are dealt to two overlapping rows of buckets of twice the slack, so
    that any such place lies within one.
    """
    texts = indexed(docs)
    tests = cut(tests_of(cut(items_of(benchmark)), texts, size, rarest))
    step = slack + 1
    b = F.floor(F.col("shift") / step)
    p = shifted_postings(texts, tests).withColumn("bucket", F.explode(F.array(b, b - 1)))
    grouped = p.groupBy("test", "key", "bucket").agg(F.collect_set(F.struct("shift", "p")).alias("near"))
    d = grouped.join(sized(tests, 4096), "test").select("key", "test", "near", F.explode("wins").alias("win"))
    near, at = F.col("near"), F.col("win")["at"]

    def complete(x: Column) -> Column:
        close = F.filter(near, lambda y: (y["shift"] >= x["shift"]) & (y["shift"] <= x["shift"] + slack))
        return F.array_contains(at, x["p"]) & (F.size(F.array_except(at, F.transform(close, lambda y: y["p"]))) == 0)

    lows = F.array_distinct(F.transform(F.filter(near, complete), lambda x: x["shift"]))
    return d.select("test", "key", F.col("win")["s"].alias("s"), F.explode(lows).alias("shift")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key, n_hit and items of every text with an exact occurrence: the words
    inside one, and the sorted ids of the items it comes from."""
    found, items = phrases(docs, benchmark)
    spans = found.select("key", "start", "length").distinct().groupBy("key")
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("s"))  # within one text
    # Words from the furthest end so far to each end.
    walk = F.aggregate(
        "s",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["start"] + x["length"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(a["end"], x["start"]))).alias("n"),
        ),
    )
    spans = spans.select("key", walk["n"].alias("n_hit"))
    of_key = found.select("key", "test").distinct().join(items.select("test", "item"), "test").select("key", "item").distinct()
    return spans.join(of_key.groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")), "key")


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    Null and empty texts have no words; an empty benchmark hits nothing;
    repeated rows are answered alike.
    """
    hit = cut(contamination(docs, benchmark)).withColumnRenamed("key", "__k")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(terms(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(sized(hit, 512), F.col("key") == F.col("__k"), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` without any word inside an occurrence of a test window."""
    hit = cut(contamination(docs, benchmark).select(F.col("key").alias("__k")))
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    return keyed.join(sized(hit, 32), F.col("__key") == F.col("__k"), "left_anti").select(*docs.columns)


def _oracle() -> str:
    """The result in DuckDB: every window of every text, of each length that an
    item's windows have, looked up among the items' windows."""
    letters = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    split = f"list_filter(string_split_regex({letters}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    leads = ", ".join(f"lead(word, {k}) OVER (PARTITION BY id ORDER BY i) AS w{k}" for k in range(1, WINDOW))
    grams = "\n  UNION ALL ".join(
        f"SELECT id, i, {n} AS n, word{''.join(f" || ' ' || w{k}" for k in range(1, n))} AS gram FROM {{0}}" for n in range(1, WINDOW + 1)
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {split} AS w FROM documents),
items AS (SELECT row_number() OVER () AS id, coalesce(item_id::VARCHAR, '') AS item, {split} AS w FROM benchmark),
doc_words AS (SELECT id, unnest(range(len(w))) AS i, unnest(w) AS word FROM docs),
item_words AS (SELECT id, unnest(range(len(w))) AS i, unnest(w) AS word FROM items),
doc_ahead AS (SELECT *, {leads} FROM doc_words),
item_ahead AS (SELECT *, {leads} FROM item_words),
item_grams AS ({grams.replace("{0}", "item_ahead")}),
windows AS (
  SELECT DISTINCT t.item, g.n, g.gram FROM item_grams g JOIN items t USING (id)
  WHERE g.n = least(len(t.w), {WINDOW}) AND g.gram IS NOT NULL),
doc_grams AS ({grams.replace("{0}", "doc_ahead")}),
found AS (
  SELECT d.id, d.i, d.n, w.item FROM doc_grams d JOIN windows w ON w.n = d.n AND w.gram = d.gram),
hit AS (SELECT id, count(*) AS n_hit FROM (SELECT DISTINCT id, unnest(range(i, i + n)) AS i FROM found) GROUP BY id),
which AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(k.n_items, 0) AS n_items,
       sha256(coalesce(k.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (id) LEFT JOIN which k USING (id)
"""


ORACLE_SQL = _oracle()
