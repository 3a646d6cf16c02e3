"""Small cases with a defined result: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns; and brute force on few documents."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cirrus.llm import decontam, gam, hilbert, lm_score, mixing, order_minhash, pii, quality_rules, token_scan, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = {"size": "x", "score": "x", "shard": "x", "key": "x", "copies": "x", "rank": "x", "label": "x"}


@pytest.fixture
def docs_of(spark):
    """Frame of documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, extra=None):
        rows = [(*r, "en", "src0")[:4] if len(r) == 2 else r for r in rows]
        data = [(i, t, lang, src, len(t or "")) for i, t, lang, src in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({c: F.lit(v) for c, v in (extra or {}).items()}).repartition(3)

    return make


def text(seed, n, vocab=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocab)}" for _ in range(n))


@pytest.fixture
def odd(docs_of):
    """Null, empty, blank, repeated, long and tied rows, with clashing columns."""
    long = text(1, 20_000, 5_000)
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, text(2, 60)), (4, text(2, 60)), (None, text(3, 60)), (5, long),
            (6, text(2, 60)), (7, "a\n\na\nb"), (8, text(2, 60), None, None)]
    rows = [r if len(r) == 4 else (*r, "en", "s") for r in rows]
    return docs_of(rows, CLASH)


@pytest.fixture
def none(odd):
    return odd.where("false")


@pytest.fixture
def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(1, 9)] + [(None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def benchmark(spark):
    rows = [(1, text(2, 60)[:200]), (2, "a b"), (None, "b"), (3, None), (4, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(labels, benchmark):
    return {
        "quality_rules": quality_rules.quality_rules,
        "gam": lambda d: gam.quality_scores(d, labels),
        "lm": lambda d: lm_score.lm_scores(d, labels),
        "tokens": token_scan.token_counts,
        "mix": mixing.mixed_sizes,
        "near": order_minhash.near_duplicates,
        "pii": pii.personal_data,
        "decontam": lambda d: decontam.contaminated_documents(d, benchmark),
        "toxicity": lambda d: toxicity.toxicity_scores(d, labels),
        "shards": hilbert.sharded_sizes,
    }


@pytest.mark.parametrize("name", list(operators(None, None)))
def test_every_row_is_answered(odd, none, labels, benchmark, name):
    run = operators(labels, benchmark)[name]
    got = run(odd).toPandas()
    assert collections.Counter(map(str, got["doc_id"].astype("Int64"))) == collections.Counter(
        map(str, odd.toPandas()["doc_id"].astype("Int64"))
    )
    empty = run(none)
    assert empty.count() == 0 and empty.columns == list(got.columns)


@pytest.mark.parametrize("name", ["gam", "lm", "decontam", "toxicity"])
def test_empty_side_tables(odd, labels, benchmark, name):
    run = operators(labels.where("false"), benchmark.where("false"))[name]
    got = run(odd).toPandas()
    assert len(got) == 10
    if name == "gam":
        assert (got["score"] == 0.5).all()
    if name == "decontam":
        assert not got["contaminated"].any()


def base_counts(t):
    w = WORD.findall(t or "")
    tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    n = collections.Counter(tri)
    inside = {k + j for k, x in enumerate(tri) if n[x] > 1 for j in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside)


def test_quality_rule_counts(docs_of):
    texts = ["a b c a b c", "x x x x", "é#* 𝒳 <b>\n a \n a \n\n a", "", None, "a b", text(5, 300, 12), "one"]
    got = quality_rules.quality_rules(docs_of(list(enumerate(texts)))).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        row = got.loc[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == base_counts(t)
        n, *_, rep = base_counts(t)
        assert row.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (row.kept and row.base_failed)


def test_divergence_rejects_only_odd_texts(docs_of):
    r = random.Random(3)
    common = quality_rules.COMMON_WORDS["en"]
    plain = [" ".join(r.choice(common) if r.random() < 0.4 else f"word{chr(97 + r.randrange(26))}{r.randrange(900)}" for _ in range(200)) for _ in range(40)]
    shout = " ".join(f"BUY{r.randrange(9000)}NOW!!" for _ in range(200))
    got = quality_rules.quality_rules(docs_of([*enumerate(plain), (99, shout)])).toPandas().set_index("doc_id")
    assert got.kept.drop(99).all() and not got.kept[99]
    short = quality_rules.quality_rules(docs_of([(1, "AB CD")])).first()
    assert short["class_distance"] is None and short["word_distance"] is None


def test_gam_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    acc = ((model.score(x) > 0.5) == y).mean()
    assert acc > 0.9 and (0, 1) in {tuple(sorted(p[:2])) for p in model.pairs}
    assert len(gam.fit(x[:0], y[:0]).score(x)) == 4000 and (gam.fit(x[:5], np.ones(5)).score(x) > 0.8).all()


def lm_brute_force(texts, targets, order):
    """Mean losses (target, background) of every text, by counting in dictionaries."""
    vocabulary = len({c for t in texts for c in t})
    out = [[] for _ in texts]
    for chosen in (targets, range(len(texts))):
        counts = collections.Counter()
        for i in chosen:
            padded = ["", "", ""] + list(texts[i])
            for j in range(3, len(padded)):
                for n in range(order):
                    counts[(tuple(padded[j - n : j]), padded[j])] += 1
        seen, kinds = collections.Counter(), collections.Counter()
        for (h, _), n in counts.items():
            seen[h] += n
            kinds[h] += 1

        def p(h, w):
            lower = p(h[1:], w) if h else 1 / vocabulary
            k = max(1, kinds[h])
            return (counts[h, w] + k * lower) / (seen[h] + k)

        for i, t in enumerate(texts):
            padded = ["", "", ""] + list(t)
            each = [-np.log(p(tuple(padded[j - order + 1 : j]), padded[j])) for j in range(3, len(padded))]
            out[i].append(np.mean(each) if each else None)
    return out


@pytest.mark.parametrize(("order", "bits"), [(4, 20), (4, 3), (2, 1), (3, 6)])
def test_lm_scores_against_brute_force(docs_of, spark, order, bits):
    r = random.Random(order)
    letters = "abcde \u00e7\u4e2d\U0001f600\x00"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(30)] + ["", "z", "\U0010ffff" * 9]
    good = [i for i in range(len(texts)) if i % 3 == 1 and zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, int(i % 3 == 1), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in lm_score.lm_scores(docs_of(list(enumerate(texts))), labels, order, bits).collect()}
    for i, (target, background) in enumerate(lm_brute_force(texts, good, order)):
        assert got[i].n_tokens == len(texts[i])
        if texts[i]:
            assert abs(got[i].target_loss - target) < 1e-9 and abs(got[i].background_loss - background) < 1e-9
            assert got[i].score == got[i].target_loss - got[i].background_loss
        else:
            assert got[i].target_loss is None and got[i].score is None


def test_lm_pieces_meet_at_their_borders():
    texts = ["", "abcdefghij", "k", "", "lmnop"]
    want = [g for t in texts for g in lm_grams(t)]
    for size in (1, 2, 3, 4, 100):
        got = []
        for symbols, place, owner in lm_score.pieces(texts, 3, size):
            ctx, following = lm_score.grams(symbols, place, 4)
            got += zip(owner.tolist(), ctx.tolist(), following.tolist())
            summed = collections.Counter(zip(ctx.tolist(), following.tolist()))
            told = [dict(zip(zip(c.tolist(), f.tolist()), n.tolist())) for c, f, n in lm_score.tally(symbols, place, 4)]
            assert sum((collections.Counter(x) for x in told), collections.Counter()) == summed
        assert [g[1:] for g in got] == want and [g[0] for g in got] == [1] * 10 + [2] + [4] * 5


def lm_grams(text):
    padded = [0, 0, 0] + [ord(c) + 1 for c in text]
    return [(padded[j - 3] << 42 | padded[j - 2] << 21 | padded[j - 1], padded[j]) for j in range(3, len(padded))]


def test_lm_halves_a_piece_of_many_symbols():
    text = "".join(chr(0x10000 + i) for i in range(60_000))
    (symbols, place, _), = lm_score.pieces([text], 3)
    told = list(lm_score.tally(symbols, place, 4))
    assert len(told) > 1
    assert sorted(g for c, f, _ in told for g in zip(c.tolist(), f.tolist())) == sorted(lm_grams(text))


def test_lm_prefers_texts_like_the_target(docs_of, spark):
    rows = [(i, ("abc abd " if i % 2 else "xyz zyx ") * 20) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = lm_score.lm_scores(docs_of(rows), labels).toPandas()
    assert got[got.doc_id % 2 == 1].score.max() < 0 < got[got.doc_id % 2 == 0].score.min()


@pytest.mark.parametrize("seed", range(3))
def test_scan_and_stitch(spark, seed):
    r = random.Random(seed)
    end, block = 9, 7
    want, rows = [], []
    for file in range(3):
        lengths = [r.choice([0, 1, 2, 5, 6, 7, 8, 30]) for _ in range(r.randrange(0, 25))]
        flat = [t for n in lengths for t in [*[1] * n, end]]
        if r.random() < 0.5:
            flat += [1] * 3
            want.append((file, len(lengths), 3, False))
        want += [(file, i, n, True) for i, n in enumerate(lengths)]
        flat = np.array(flat, dtype="<u2")
        rows += [(file, k, flat[k * block : (k + 1) * block].tobytes()) for k in range(-(-len(flat) // block))]
    blocks = spark.createDataFrame(rows, "file int, block int, tokens binary").repartition(4)
    got = token_scan.stitch(token_scan.scan(blocks, end), chunk=2).select("file", "ordinal", "n_tokens", "closed").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_token_counts_against_the_tokenizer(spark, docs_of):
    import tiktoken

    texts = ["", None, "Hello wörld 123", text(1, 500), "a" * 3000]
    coder = tiktoken.Encoding("t", pat_str=token_scan.PATTERN, mergeable_ranks=token_scan.load_ranks(spark), special_tokens={})
    got = {r["doc_id"]: r["n_tokens"] for r in token_scan.token_counts(docs_of(list(enumerate(texts)))).collect()}
    assert got == {i: len(coder.encode_ordinary(t or "")) for i, t in enumerate(texts)}


def water_fill(sizes, weights, most=3):
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free} if free else {}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in sizes}
        capped |= over


def test_mixing_targets_and_copies(docs_of):
    r = random.Random(7)
    rows = [(i, text(i, r.choice([0, 3, 10, 40])), "en", r.choice(["a", "b", "b", "b", "b", "c", "d", None])) for i in range(400)]
    got = mixing.mixed_sizes(docs_of(rows)).toPandas()
    docs = {i: s for i, _, _, s in rows}
    size = {i: len(WORD.findall(t)) for i, t, _, _ in rows}
    names = sorted({s for s in docs.values() if s is not None}) + [None]
    sizes = {s: sum(size[i] for i in docs if docs[i] == s) for s in names}
    want = water_fill(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)})
    taken = collections.Counter()
    for row in got.itertuples():
        s = docs[row.doc_id]
        assert row.size == size[row.doc_id] and row.source_size == sizes[s]
        assert row.target == pytest.approx(want[s]) and 0 <= row.taken <= 3 * row.size
        taken[s] += row.taken
    for s in names:
        assert abs(taken[s] - want[s]) <= max(size[i] for i in docs if docs[i] == s)
    again = mixing.mixed_sizes(docs_of(rows).repartition(9)).toPandas()
    assert sorted(map(tuple, again.values)) == sorted(map(tuple, got.values))


def test_mixed_documents_repeat_whole_rows(docs_of):
    rows = [(i, text(i, 20), "en", "ab"[i % 2]) for i in range(60)]
    d = docs_of(rows, CLASH)
    out = mixing.mixed_documents(d)
    assert out.columns == d.columns
    n = collections.Counter(r["doc_id"] for r in out.collect())
    assert max(n.values()) <= 3 and n == {r["doc_id"]: r["copies"] for r in mixing.mixed_sizes(d).collect() if r["copies"]}


def edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), max_size=40), st.integers(0, 12))
def test_alignment_is_exact(a, b, band):
    x, y = (np.array([ord(c) for c in z], dtype=np.int64) for z in (a, b))
    e = edits(a, b)
    for run in (order_minhash._bits, order_minhash._by_row):
        assert run(x, y, band) == (e if e <= band else None)
    longest = max(len(a), len(b), 1)
    want = 1 - e / longest
    got = order_minhash.similar(a, b)
    assert (got is None) == (want < 0.8 - 1e-9) and (got is None or abs(got - want) < 1e-9)


def changed(words, n, r):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"z{r.randrange(10**6)}"
    return out


def test_near_duplicates_against_brute_force(docs_of):
    r = random.Random(11)
    base = [text(100 + i, r.randrange(20, 120)).split() for i in range(12)]
    passage = text(999, 55).split()
    texts = []
    for w in base:
        texts.append(w)
        texts += [changed(w, max(1, len(w) // 25), r) for _ in range(4)]
        texts.append([*w[:30], *passage, *text(r.random(), 60).split()])
    texts += [base[0], base[0], ["hi"], ["hi"], ["ho"], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {x["doc_id"]: x["class_id"] for x in order_minhash.near_duplicates(docs_of(rows)).collect()}
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 1 - edits(texts[i], texts[j]) / max(len(texts[i]), len(texts[j]), 1) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert got == {i: root(i) for i in range(len(texts))}


@pytest.mark.parametrize(("n", "edits_each"), [(60, 8), (200, 27)])
def test_original_joins_copies_that_are_not_alike(docs_of, n, edits_each):
    """Copies are at 0.8 of the original but not of each other."""
    r = random.Random(n)
    original = text(7, n, 4000).split()
    rows = [(300, " ".join(original))]
    for i in range(300):
        copy = list(original)
        for k in r.sample(range(n), edits_each):
            copy[k] = f"z{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = order_minhash.near_duplicates(docs_of(rows)).collect()
    assert {x["class_id"] for x in got} == {0}


def crowd(r, n=700):
    """Texts that share a passage, so that they share sketches, and a few that
    are each like one of them."""
    passage = text(3, 60, 5000).split()
    rows = [[*passage, *text(1000 + i, 60, 5000).split()] for i in range(n)]
    rows += [changed(rows[i], 10, r) for i in (100, 200, 300)]
    return rows


@pytest.mark.parametrize("middle", [512, 64])
def test_links_in_crowded_buckets_that_no_hub_touches(spark, docs_of, monkeypatch, middle):
    monkeypatch.setattr(order_minhash, "MIDDLE", middle, raising=False)
    rows = crowd(random.Random(2))
    docs = docs_of([(i, " ".join(t)) for i, t in enumerate(rows)])
    nodes = order_minhash.sketched(docs).withColumn("rep", F.col("doc_id"))
    key = {r["doc_id"]: bytes(r["key"]) for r in nodes.collect()}
    small, large = order_minhash.buckets(nodes)
    want = {tuple(sorted((key[i], key[700 + k]))) for k, i in enumerate((100, 200, 300))}
    # They may share a small bucket too, so the large ones are asked alone.
    met = {(bytes(r["a"]), bytes(r["b"])) for r in order_minhash.candidates(small.limit(0), large).collect()}
    none = spark.createDataFrame([], "key binary, label binary")
    left = {(bytes(r["a"]), bytes(r["b"])): r["edits"] for r in order_minhash.remaining(docs, nodes, large, none).collect()}
    assert want - met and want <= set(left) and all(left[p] <= 10 for p in want)
    labels = spark.createDataFrame([(p[1], p[0]) for p in want], "key binary, label binary")
    again = order_minhash.remaining(docs, nodes, large, labels).collect()
    assert not want & {(bytes(r["a"]), bytes(r["b"])) for r in again}


@pytest.mark.parametrize("middle", [512, 7])
def test_groups_are_compared_whole(spark, monkeypatch, middle):
    """All pairs of a bucket that the bound allows, however its parts and batches fall."""
    monkeypatch.setattr(order_minhash, "MIDDLE", middle, raising=False)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        r = random.Random(4)
        words = text(9, 40, 900).split()
        texts = [changed(words, r.randrange(12), r) for _ in range(60)]
        hashed = [order_minhash.word_hashes(t) for t in texts]
        bits = [order_minhash.parity(h) for h in hashed]
        rows = [(bytes([i]), len(h), b.tolist(), bytes([i // 2]), i % 3 // 2, 40 - 20 * (i % 3 // 2)) for i, (h, b) in enumerate(zip(hashed, bits))]
        got = order_minhash.compared(spark.createDataFrame(rows, "key binary, size int, bits array<long>, label binary, s long, n long"))
        want = {}
        for i in range(60):
            for j in range(i + 1, 60):
                e = (sum(int(x).bit_count() for x in (bits[i] ^ bits[j]).view(np.uint64)) + abs(len(texts[i]) - len(texts[j])) + 1) // 2
                if i // 2 != j // 2 and i % 3 // 2 == j % 3 // 2 and e <= 8:
                    want[bytes([i]), bytes([j])] = e
        got = [((bytes(x["a"]), bytes(x["b"])), x["edits"]) for x in got.collect()]
        assert len(got) == len(dict(got)) and dict(got) == want and 100 < len(want) < 1000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_covered_keys_are_left_out(spark):
    """No pair is lost with the keys whose texts all share another one."""
    r = random.Random(5)
    for _ in range(4):
        nested = {s: set(range(s, 30)) for s in range(12)}  # as of texts that share a passage
        rows = nested | {s: set(r.sample(range(36), r.randrange(2, 6))) for s in range(12, 30)}
        table = [(bytes([t]), bytes([t]), s, len(m)) for s, m in rows.items() for t in m]
        got = {}
        for x in order_minhash.needed(spark.createDataFrame(table, "key binary, label binary, s long, n long")).collect():
            got.setdefault(x["s"], set()).add(x["key"][0])
        pairs = [{(a, b) for m in y.values() for a in m for b in m if a < b} for y in (rows, got)]
        assert pairs[0] == pairs[1] and all(got[s] == rows[s] for s in got)
    alone = [(t, t, s, n) for t, _, s, n in table if s < 12]
    left = order_minhash.needed(spark.createDataFrame(alone, "key binary, label binary, s long, n long"))
    assert {x["s"] for x in left.collect()} == {0}


def test_comparison_of_texts_that_share_a_passage(spark, docs_of, monkeypatch):
    """Few rows for each text, and each pair once, however long the passage."""
    monkeypatch.setattr(order_minhash, "MIDDLE", 64)
    passage = text(3, 150, 5000).split()
    rows = [[*passage, *text(1000 + i, 50, 5000).split()] for i in range(200)]
    rows += [changed(rows[i], 10, random.Random(i)) for i in (50, 100)]
    docs = docs_of([(i, " ".join(t)) for i, t in enumerate(rows)])
    nodes = order_minhash.sketched(docs).withColumn("rep", F.col("doc_id"))
    given, compared = [], order_minhash.compared
    monkeypatch.setattr(order_minhash, "compared", lambda x: (given.append(x.count()), compared(x))[1])
    none = spark.createDataFrame([], "key binary, label binary")
    left = order_minhash.remaining(docs, nodes, order_minhash.buckets(nodes)[1], none).select("a", "b").collect()
    assert len(left) == len(set(left)) >= 2 and given[0] < 5 * len(rows)


def test_long_texts_that_share_a_passage_are_not_aligned(spark, docs_of):
    """Three quarters of their words are common: only copies of one are left to align."""
    passage = text(3, 600, 5000).split()
    rows = [[*passage, *text(1000 + i, 200, 5000).split()] for i in range(60)]
    rows += [changed(rows[i], 40, random.Random(i)) for i in (10, 20)] + [rows[30][:-100]]
    docs = docs_of([(i, " ".join(t)) for i, t in enumerate(rows)])
    nodes = order_minhash.sketched(docs).withColumn("rep", F.col("doc_id"))
    key = {r["doc_id"]: bytes(r["key"]) for r in nodes.collect()}
    none = spark.createDataFrame([], "key binary, label binary")
    left = order_minhash.remaining(docs, nodes, order_minhash.buckets(nodes)[1], none).collect()
    want = {tuple(sorted((key[i], key[j]))) for i, j in ((10, 60), (20, 61), (30, 62))}
    got = {(bytes(r["a"]), bytes(r["b"])) for r in left}
    assert want <= got and len(got) < 10
    assert all(r["edits"] <= 100 for r in left if (bytes(r["a"]), bytes(r["b"])) in want)


def test_signatures_of_unlike_width():
    r = random.Random(8)
    for n in (0, 5, 128, 129, 500, 3000):
        h = order_minhash.word_hashes(text(n, n, 300).split())
        wide = order_minhash.parity(h, order_minhash.WIDE)
        for bits in (1024, 2048, 8192):
            assert (order_minhash.folded(wide, bits // 64) == order_minhash.parity(h, bits)).all()
        assert len(order_minhash.parity(h, order_minhash.width(n))) * 64 == order_minhash.width(n)
        if n:
            a = text(n, n, 300).split()
            b = edited(a, n // 6 + 1, r)
            x, y = (order_minhash.parity(order_minhash.word_hashes(t), order_minhash.WIDE).view(np.uint64) for t in (a, b))
            ids = {w: i for i, w in enumerate({*a, *b})}
            e = order_minhash._bits(*(np.array([ids[w] for w in t], dtype=np.int64) for t in (a, b)), n)
            assert int(np.bitwise_count(x ^ y).sum()) + abs(len(a) - len(b)) <= 2 * e
    assert [order_minhash.width(n) for n in (0, 256, 257, 1025, 10**6)] == [1024, 1024, 2048, 8192, 8192]


@pytest.mark.parametrize("n", [4, 5, 9, 31, 60, 200])
def test_similar_texts_of_any_length_share_an_exact_key(n):
    r = random.Random(n)
    for _ in range(60):
        a = text(r.random(), n, 50).split()
        b = edited(a, r.randrange(1, n // 4 + 2), r)
        if order_minhash.similar(a, b) is not None and a != b:
            g = [order_minhash.labelled_pairs(order_minhash.word_hashes(x), None) for x in (a, b)]
            hot = {x: 20 + x % 7 for x in g[0].tolist() if x % 3}
            keys = (set(order_minhash.rarest(p, len(x), hot, None)) for p, x in zip(g, (a, b)))
            assert set.intersection(*keys)


def edited(words, n, r):
    out = list(words)
    for _ in range(n):
        k, what = r.randrange(len(out)), r.randrange(3)
        out[k : k + 1] = [[f"z{r.randrange(10**6)}"], [], [out[k], f"z{r.randrange(10**6)}"]][what]
    return out


def shares(a, b):
    a, b = order_minhash.word_hashes(a), order_minhash.word_hashes(b)
    return bool({*order_minhash.sketch(a), *order_minhash.short_keys(a)} & {*order_minhash.sketch(b), *order_minhash.short_keys(b)})


@pytest.mark.parametrize("share", [0.1, 0.15, 0.2])
def test_share_of_similar_pairs_that_meet(share):
    r = random.Random(int(100 * share))
    for n in (40, 100, 300):
        pairs = [(w, edited(w, int(share * n), r)) for w in (text(r.random(), n).split() for _ in range(100))]
        pairs = [x for x in pairs if order_minhash.similar(*x) is not None]
        assert sum(shares(*x) for x in pairs) >= 0.98 * len(pairs)


def test_short_similar_pairs_always_meet():
    r = random.Random(5)
    for n in [*range(5, 31)] * 10:
        a = text(r.random(), n, 50).split()
        b = edited(a, r.randrange(1, n // 5 + 1), r)
        if len(b) <= order_minhash.SHORT and order_minhash.similar(a, b) is not None:
            keys = (set(order_minhash.short_keys(order_minhash.word_hashes(x))) for x in (a, b))
            assert a == b or set.intersection(*keys)


def test_one_of_each_keeps_one_row(docs_of):
    t = text(1, 80)
    d = docs_of([(3, t), (1, t), (1, t), (2, t + " end"), (9, "other text here"), (None, None)], CLASH)
    out = order_minhash.one_of_each(d)
    assert out.columns == d.columns and sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "9", "None"]


def spans_by_pattern(t):
    out = []
    for k, (p, ok) in enumerate([
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub(r"\D", "", m)) <= 19 and pii.luhn(re.sub(r"\D", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
    ]):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, t) if ok(m.group())]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.-+ _%(9é4", max_size=40))
def test_base_spans_equal_the_patterns(t):
    assert pii.find(t) == spans_by_pattern(t)


def test_base_spans_of_real_numbers():
    t = "x 4111 1111 1111 1111, +44 (20) 7946-0958 and 10.0.0.300 or 10.0.0.30; a.b@c.de"
    assert pii.find(t) == spans_by_pattern(t) and {k for _, k, _ in pii.find(t)} == {0, 1, 2, 3}


@pytest.mark.parametrize(("t", "kind", "found"), [
    ("write to john dot doe at example dot com now", 0, "john dot doe at example dot com"),
    ("ｕｓｅｒ＠ｅｘａｍｐｌｅ．ｃｏｍ", 0, "ｕｓｅｒ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("te​st@exa​mple.com", 0, "te​st@exa​mple.com"),
    ("x (at) y [dot] com", 0, "x (at) y [dot] com"),
    ("call +four four two zero seven nine four six zero nine", 3, "+four four two zero seven nine four six zero nine"),
    ("card four one one one 1111 1111 double one one one", 2, "four one one one 1111 1111 double one one one"),
])
def test_disguised_spans_map_back(t, kind, found):
    assert (t.index(found), kind, t.index(found) + len(found)) in pii.find_disguised(t, pii.find(t))


@pytest.mark.parametrize("t", ["look at this dot on the map", "meet me at example.com", "one two of the three", "", "at dot"])
def test_plain_texts_have_no_disguised_spans(t):
    assert pii.find_disguised(t, pii.find(t)) == []


def hits(t, items, size=10):
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), x or ""))
    w, hit, found = words(t), set(), set()
    for i, it in items:
        v = words(it)
        n = min(size, len(v))
        for s in range(len(v) - n + 1) if n else ():
            for b in range(len(w) - n + 1):
                if w[b : b + n] == v[s : s + n]:
                    hit |= set(range(b, b + n))
                    found.add(str(i))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_contamination_against_brute_force(spark, docs_of):
    r = random.Random(2)
    items = [(i, text(i, r.randrange(8, 30), 40)) for i in range(12)] + [(20, "w1 w2"), (21, "W3"), (22, ""), (23, "É é"), (3, text(3, 15, 40))]
    texts = [None, "", "É É", "é É é"]
    for i in range(30):
        it = r.choice(items)[1].split()
        a = r.randrange(0, max(1, len(it) - 9))
        texts.append(" ".join([*text(50 + i, 20, 40).split(), *it[a : a + r.randrange(5, 25)], *text(90 + i, 9, 40).split()]).upper())
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated_documents(docs_of(list(enumerate(texts))), b).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        x = got.loc[i]
        assert (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) == hits(t, items), t


def test_proximity_finds_changed_passages(spark, docs_of):
    w = [f"u{i}" for i in range(10)]
    moved = [*w[:5], "extra", *w[5:]]
    rows = [(1, " ".join(["x", *w])), (2, " ".join(moved)), (3, " ".join(f"{x} " + text(i, 9) for i, x in enumerate(w))), (4, "x y z")]
    d = docs_of(rows)
    near = decontam.proximity(d, spark.createDataFrame([(1, " ".join(w))], "item_id long, text string"))
    keys = {bytes(r["key"]) for r in near.collect()}
    by_id = {i: hashlib.md5(t.encode()).digest() for i, t in rows}
    assert by_id[1] in keys and by_id[2] in keys and by_id[3] not in keys and by_id[4] not in keys


def test_toxicity_chain_learns_rare_words(spark, docs_of):
    r = random.Random(9)
    rows, lab = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = text(i, 60).split()
        if bad:
            words[5:8] = [f"nasty{r.choice('abcdef')}{r.randrange(4)}" for _ in range(3)]
        rows.append((i, " ".join(words)))
        lab.append((i, 1, int(bad)))
    labels = spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(docs_of(rows), labels).toPandas()
    asked = got[got.held_out]
    assert (asked.predicted == (asked.doc_id % 4 == 0)).mean() > 0.95
    assert {"p_quality", "p_toxic"} <= set(got.columns)


def curve(cells, bits):
    """Hilbert number of a point, from the published transposition."""
    x, n = list(cells), len(cells)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (3, 8), (1, 4)])
def test_curve_index(spark, dims, bits):
    r = random.Random(1)
    space = (1 << bits) ** dims
    points = [tuple(p >> (bits * k) & ((1 << bits) - 1) for k in range(dims)) for p in (range(space) if space <= 64 else [r.randrange(space) for _ in range(80)])]
    df = spark.createDataFrame([(list(p),) for p in points], "c array<long>")
    got = [x["h"] for x in df.select(hilbert.curve_index(F.col("c"), dims, bits).alias("h")).collect()]
    assert got == [curve(p, bits) for p in points]
    if space <= 64:
        path = [p for _, p in sorted(zip(got, points))]
        assert sorted(got) == list(range(space))
        assert all(sum(abs(a - b) for a, b in zip(u, v)) == 1 for u, v in zip(path, path[1:]))


def test_shards_are_level_and_follow_the_curve(docs_of):
    r = random.Random(4)
    rows = [(i, text(i, r.randrange(1, 50)), r.choice(["de", "en", None]), f"s{r.randrange(5)}") for i in range(203)]
    got = hilbert.sharded_sizes(docs_of(rows)).toPandas()
    n = got.groupby("shard").size()
    assert list(n.index) == list(range(8)) and n.max() - n.min() <= 1
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g))) and g.sort_values("slot").curve.is_monotonic_increasing
    assert got.groupby("shard").curve.max().iloc[:-1].le(got.groupby("shard").curve.min().iloc[1:].values).all()
    again = hilbert.sharded_sizes(docs_of(rows).repartition(7)).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert again.sort_values("doc_id")[key].values.tolist() == got.sort_values("doc_id")[key].values.tolist()
    few = hilbert.sharded_sizes(docs_of(rows[:3])).toPandas()
    assert few.groupby("shard").size().max() == 1


def test_components_chains_stars_and_repeats(spark):
    chain = [(i, i + 1) for i in range(1, 12)]
    star = [(100, i) for i in range(101, 140)] + [(139, 200), (200, 150)]
    repeats = [(301, 300), (300, 301), (301, 300), (302, 302)]
    got = order_minhash.components(spark.createDataFrame(chain + star + repeats, "a long, b long")).collect()
    want = {i: 1 for i in range(1, 13)} | {i: 100 for i in [*range(100, 140), 150, 200]} | {300: 300, 301: 300}
    assert len(got) == len(want) and {r["key"]: r["label"] for r in got} == want
    assert order_minhash.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_signatures_never_reject_a_similar_pair(spark):
    r = random.Random(11)
    rows = []
    for n in (1, 2, 9, 60, 400, 3000):
        for _ in range(25):
            a = [f"w{int(r.paretovariate(0.7))}" for _ in range(n)]
            b = list(a)
            for _ in range(r.randrange(0, n // 3 + 2)):
                i = r.randrange(len(b) + 1)
                b[i : i + r.randrange(2)] = [f"v{r.randrange(50)}"] * r.randrange(2)
            ids = {}
            x, y = (np.array([ids.setdefault(w, len(ids)) for w in t], dtype=np.int64) for t in (a, b))
            true = order_minhash._bits(x, y, max(len(x), len(y)) + 1)
            bits = [order_minhash.parity(order_minhash.word_hashes(t)).tolist() for t in (a, b)]
            rows.append((bits[0], len(a), bits[1], len(b), true))
    df = spark.createDataFrame(rows, "p array<long>, n int, q array<long>, m int, true int")
    least = order_minhash._edits_at_least(F.col("p"), F.col("n"), F.col("q"), F.col("m"))
    got = df.select(least.alias("least"), "true").collect()
    assert all(g.least <= g.true for g in got) and sum(g.least >= 0.9 * g.true for g in got) > 60


@pytest.mark.parametrize("unit", ["a dot ", "dot a . a . ", "x dot y" + " " * 300, "- dot ", "a dot b@", "a" * 300 + " dot", "x" + " " * 300 + "("])
def test_disguises_are_read_in_linear_time(unit):
    import time

    t = (unit * 100_000)[:300_000]
    began = time.time()
    pii.find_disguised(t, pii.find(t))
    assert time.time() - began < 20


@pytest.mark.parametrize("t", ["user { at } host.com", "user < at > host.com", "user (  at\n) host.com", "a dot b at host dot co dot uk"])
def test_any_bracketed_at_is_read(t):
    assert pii.find_disguised(t, pii.find(t)) == [(0, 0, len(t))]
