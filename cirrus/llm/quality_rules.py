"""Quality rules by distribution divergence (DataFrame functions only).

A document's histogram of character classes and its histogram of common words
are compared with those of its language by Jensen-Shannon distance.  Both
comparisons have a minimum length, below which they give no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut, words

# Frequent function words by language code.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch".split(),
    "en": "the of and to in a is that it was for on are with as at be this from by".split(),
    "es": "de la que el en y a los se del las un por con una para es lo como al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par au pas il elle".split(),
}
N_COMMON = 20
SYMBOLS = "#*$%&|<>"
MIN_CHARS = 200  # code points a text needs for its character classes to count
MIN_WORDS = 80  # words it needs for its common words to count
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.34
_SHIFT = 31


def _left(text: Column, keep: str) -> Column:
    """Code points that are in the class ``keep``."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def _sum(array: Column, kind: str) -> Column:
    return F.aggregate(array, F.lit(0).cast(kind), lambda a, x: a + x)


def _js(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""

    def term(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0) + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)

    return F.sqrt(F.greatest(F.lit(0.0), _sum(F.zip_with(p, q, term), "double") / 2))


def _shares(counts: Column) -> Column:
    total = _sum(counts, "long")
    return F.when(total > 0, F.transform(counts, lambda c: c / total))


def repeated_window_words(df: DataFrame, word_array: str, alias: str) -> DataFrame:
    """Add the number of words inside 3-word windows found twice or more.

    Windows are packed as (32-bit hash, position) and sorted as primitive
    longs; only windows that share a hash are then compared as text, so the
    result is exact whatever the hash does.  O(n log n) for a text.
    """
    w = F.col(word_array)
    packed = F.transform(
        w,
        lambda x, i: F.shiftleft(F.hash(x, F.get(w, i + 1), F.get(w, i + 2)).cast("long"), _SHIFT) + i,
    )
    n_windows = F.greatest(F.size(w) - 2, F.lit(0))
    df = df.withColumn("__packed", F.sort_array(F.slice(packed, 1, n_windows)))
    s = F.col("__packed")

    def shares_hash(x: Column, i: Column) -> Column:
        h = F.shiftright(x, _SHIFT)
        return (h == F.shiftright(F.get(s, i - 1), _SHIFT)) | (h == F.shiftright(F.get(s, i + 1), _SHIFT))

    at = F.transform(F.filter(s, shares_hash), lambda x: x.bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int"))
    df = df.withColumn(
        "__named",
        F.sort_array(F.transform(at, lambda p: F.struct(F.concat_ws(" ", F.slice(w, p + 1, 3)).alias("g"), p.alias("p")))),
    )
    m = F.col("__named")
    again = F.filter(m, lambda x, i: (x["g"] == F.get(m, i - 1)["g"]) | (x["g"] == F.get(m, i + 1)["g"]))
    df = df.withColumn("__starts", F.sort_array(F.transform(again, lambda x: x["p"])))
    st = F.col("__starts")
    covered = F.transform(st, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(st, i + 1) - p, F.lit(3))).cast("long"))
    return df.withColumn(alias, _sum(covered, "long")).drop("__packed", "__named", "__starts")


def features(docs: DataFrame) -> DataFrame:
    """Counts of every whole text: the base counts and the two histograms.

    Returns doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_chars, classes (upper case, digits, white space, listed
    symbols, other punctuation, the rest) and common (the common words of
    ``lang`` and the rest; null where the language has no list).  A null text
    counts as empty.
    """
    t = F.col("__t")
    d = docs.select("doc_id", F.col("lang").alias("lang"), F.coalesce("text", F.lit("")).alias("__t"))
    d = d.withColumn("__w", words(t)).withColumn(
        "__l", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    w, lines = F.col("__w"), F.col("__l")
    d = repeated_window_words(d, "__w", "n_repeat_words")
    lists = F.when(F.lit(False), F.array(F.lit("")))
    for code, known in sorted(COMMON_WORDS.items()):
        lists = lists.when(F.col("lang") == code, F.array(*[F.lit(x) for x in known]))
    longest = max(len(x) for known in COMMON_WORDS.values() for x in known)
    d = d.withColumn("__list", lists)
    found = F.transform(
        F.filter(w, lambda x: F.length(x) <= longest + 1),
        lambda x: F.array_position(F.col("__list"), F.rtrim(F.lower(x), F.lit(".,;:!?"))).cast("int"),
    )
    d = d.withColumn("__found", F.filter(found, lambda k: k > 0))
    per_word = [F.size("__found") - F.size(F.array_remove("__found", k)) for k in range(1, N_COMMON + 1)]
    d = d.select(
        "doc_id",
        "lang",
        F.size(w).cast("long").alias("n_words"),
        _left(t, r"\x00-\x08\x0E-\x1F\x21-\x{10FFFF}").alias("word_chars"),
        _left(t, r"#*$%&|<>").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.length(t).cast("long").alias("n_chars"),
        _left(t, r"\p{Lu}").alias("__upper"),
        _left(t, r"\p{Nd}").alias("__digit"),
        _left(t, r"\p{Punct}").alias("__punct"),
        F.when(F.col("__list").isNotNull(), F.array(*per_word)).alias("__common"),
    )
    n = {c: F.col(c) for c in ("n_chars", "word_chars", "n_symbols", "__upper", "__digit", "__punct")}
    gap = n["n_chars"] - n["word_chars"]
    punct = F.greatest(n["__punct"] - n["n_symbols"], F.lit(0))
    rest = n["n_chars"] - n["__upper"] - n["__digit"] - gap - n["n_symbols"] - punct
    classes = F.array(n["__upper"], n["__digit"], gap, n["n_symbols"], punct, F.greatest(rest, F.lit(0)))
    words_of = F.transform("__common", lambda c: c.cast("long"))
    common = F.concat(words_of, F.array(F.col("n_words") - _sum(words_of, "long")))
    return d.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        classes.alias("classes"), common.alias("common"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(feats: DataFrame) -> DataFrame:
    """One row for each language that has a word list: the mean shares over
    all documents of that language that pass the base rules and both minimum
    lengths.  At most ``len(COMMON_WORDS)`` rows."""
    use = ~base_failed() & (F.col("n_chars") >= MIN_CHARS) & (F.col("n_words") >= MIN_WORDS)
    f = feats.where(use & F.col("common").isNotNull()).select(
        "lang", _shares(F.col("classes")).alias("p"), _shares(F.col("common")).alias("q")
    )
    mean = lambda c, n: F.array(*[F.avg(F.get(c, F.lit(i))) for i in range(n)])
    return f.groupBy(F.col("lang").alias("__ref")).agg(
        mean("p", 6).alias("ref_classes"), mean("q", N_COMMON + 1).alias("ref_common")
    )


def judge(feats: DataFrame, refs: DataFrame) -> DataFrame:
    """Base rules and divergence verdicts.

    ``class_distance`` and ``word_distance`` are null where the text is below
    the minimum length or its language (unknown, null) has no reference; a null
    distance never rejects.  ``kept`` is false if a base rule fails or a
    distance exceeds its limit.
    """
    f = feats.join(F.broadcast(refs), F.col("lang") == F.col("__ref"), "left")  # refs: a row for each listed language
    p, q = _shares(F.col("classes")), _shares(F.col("common"))
    f = f.withColumn(
        "class_distance", F.when(F.col("n_chars") >= MIN_CHARS, _js(p, F.col("ref_classes")))
    ).withColumn("word_distance", F.when(F.col("n_words") >= MIN_WORDS, _js(q, F.col("ref_common"))))
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (
        F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE
    )
    return f.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~far)


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each document: base counts, distances, verdict.

    The references come from all of ``docs``; the counts are cut between the
    two steps (a few hundred bytes a document, no text), so texts are read
    once.  Nulls: a null text has no words and fails the base rule; a null or
    unlisted language gives no distances.  Repeated rows are judged alike.
    """
    feats = cut(features(docs))
    return judge(feats, references(feats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "class_distance", "word_distance",
    )
