"""Periodic runs, language kernels and Merkle manifests against brute force, and their odd inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cirrus.llm import lang_kernel, merkle, periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, clash=("start", "period", "runs", "score", "pos", "leaf", "path", "g", "rank")):
    df = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in clash}).repartition(3)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# -- periodic runs ----------------------------------------------------------


def brute_runs(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        s = q
        while s < n:
            if w[s] != w[s - q]:
                s += 1
                continue
            e = s
            while e < n and w[e] == w[e - q]:
                e += 1
            if e - s + q >= max(6, 4 * q):
                found.setdefault((s - q, e - s + q), q)  # the least period comes first
            s = e
    return sorted((s, q, length) for (s, length), q in found.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def expected(doc_id, text):
    w = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(w)
    drop = {i for s, q, n in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
    best = (None,) * 4
    for s, q, n in runs:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    return (doc_id, len(runs), *best, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def repetitive(seed):
    r = random.Random(seed)
    out = []
    while len(out) < r.randrange(1, 400):
        unit = [f"w{r.randrange(r.choice([1, 2, 3, 50]))}" for _ in range(r.choice([1, 1, 2, 3, 5, 7, 8, 15, 16, 17, 33]))]
        out += unit * r.choice([1, 2, 3, 4, 5, 9, 20]) + unit[: r.randrange(len(unit) + 1)]
    return " ".join(out)


@pytest.mark.parametrize("least", [1, 64, periodic.TILE_WORDS])
def test_runs_against_brute_force(spark, least):
    rows = [(i, repetitive(i), "en") for i in range(120)]
    got = sorted(map(tuple, periodic.periodic_documents(frame(spark, rows), least).collect()))
    assert got == sorted(expected(i, t) for i, t, _ in rows)


def test_runs_of_odd_texts(spark):
    one = "a " * 6000  # one run over many tiles
    long = " ".join(f"w{i}" for i in range(700)) + " "
    rows = [
        (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "a a a a a", "en"), (5, "a a a a a a", "en"), (6, one, "en"),
        (6, one, "en"), (6, "b b b b b b b", "en"), (None, one, None), (None, None, None), (7, "ab " * 7 + "\x0b\x0c" + "ab " * 2, "en"),
        (8, "x y " * 6, "en"), (9, long * 5 + "w0 w1 other", "en"), (2**53 + 1, "é é é é é é", "fr"),
    ]
    got = sorted(map(repr, map(tuple, periodic.periodic_documents(frame(spark, rows)).collect())))
    assert got == sorted(repr(expected(i, t)) for i, t, _ in rows)
    assert periodic.periodic_documents(frame(spark, rows).where("false")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 4))
def test_tiles_lose_and_invent_nothing(symbols, least):
    """Tiles of every octave, solved on their own and stitched by hand."""
    x = np.array(symbols, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D)
    matches = set()
    n = len(x)
    for octave in range(max(1, (n // 4).bit_length())):
        step = 2 << octave
        core = max(least, 4 * step) // step * step
        for t in range(0, n, core):
            offset = max(0, t - 2 * step)
            part = x[offset : t + core + step + step // 2 + 8]
            got = periodic.solve_tiles(part, np.array([0, len(part)]), np.array([t - offset]), np.array([t + core - offset]), octave)
            for _, q, s, e in got:
                assert all(x[i + offset] == x[i + offset - q] for i in range(s, e))
                matches |= {(q, i + offset) for i in range(s, e)}
    for s, q, length in brute_runs(symbols):
        assert {(q, i) for i in range(s + q, s + length)} <= matches


# -- languages --------------------------------------------------------------

TONGUES = {"aa": "ka lo mi tu", "bb": "zer gron flax wyt", "cc": "été çà où naïf"}


def speech(seed, lang, n=30):
    r = random.Random(seed)
    parts = TONGUES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_languages_learnt_outside_the_fold(spark):
    langs = sorted(TONGUES)
    rows = [(i, speech(i, langs[i % 3]), langs[i % 3]) for i in range(240)]
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    # Held-out labels are wrong: nothing may be learnt from them.
    shown = [(i, t, "bb" if i in held else lang) for i, t, lang in rows]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, " 123 !? ", "bb"), (None, speech(5, "aa"), "aa"), (1003, "ka", None),
           (1003, "ka", None), (2**53 + 1, speech(7, "cc") * 400, None)]
    got = lang_kernel.languages_of(frame(spark, shown + odd)).collect()
    assert len(got) == len(shown) + len(odd)
    by_id = {r["doc_id"]: r for r in got}
    truth = {i: lang for i, _, lang in rows}
    assert all(by_id[i]["lang_pred"] == truth[i] and by_id[i]["held_out"] == (i in held) for i in truth)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 2**53 + 1)] == ["und", "und", "und", "aa", "cc"]
    again = lang_kernel.languages_of(frame(spark, shown + odd).repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_languages_without_rows_or_labels(spark):
    rows = frame(spark, [(1, "some text", None), (2, None, None)])
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in lang_kernel.languages_of(rows).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert lang_kernel.languages_of(rows.where("false")).count() == 0
    one = frame(spark, [(i, "some text", "xx") for i in range(9)])
    assert {r["lang_pred"] for r in lang_kernel.languages_of(one).collect()} == {"xx"}


def brute_grams(text):
    s = "".join(c if c.isalpha() else "\0" for c in f" {text.lower()}  ")
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - 2) if s[i : i + n].strip("\0")}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abÄß中1 -", max_size=40), min_size=1, max_size=6))
def test_presence_by_table_and_by_search(texts):
    unpack = lambda g: "".join(chr(c) for j in (2, 1, 0) if (c := (int(g) >> (21 * j)) & 0x1FFFFF) != 0x1FFFFF)
    assert {unpack(g) for g in lang_kernel._distinct_grams(texts[0])} == (brute_grams(texts[0]) if texts[0] else set())
    grams = lang_kernel._distinct_grams(texts[0] + texts[-1][::-1])
    by_table, by_search = lang_kernel.Finder(grams), lang_kernel.Finder(grams)
    by_search.tables = None
    for (_, x, some), (_, y, _) in zip(by_table.presence(texts), by_search.presence(texts)):
        assert (x == y).all()
        for i, t in enumerate(texts):
            want = brute_grams(t) if t else set()
            assert {unpack(grams[k]) for k in np.flatnonzero(x[i])} == want & {unpack(g) for g in grams}
            assert some[i] == any(c.isalpha() for c in t.lower())


def test_long_texts_continue_in_pieces(monkeypatch):
    texts = [speech(3, "cc", 200), None, "a", speech(4, "aa", 300)]
    whole = [lang_kernel._distinct_grams(t).tolist() for t in texts]
    monkeypatch.setattr(lang_kernel, "_CHUNK", 7)
    assert [lang_kernel._distinct_grams(t).tolist() for t in texts] == whole


def test_regression_against_the_full_kernel():
    """With all texts as landmarks, Nystroem features give kernel ridge regression itself."""
    r = np.random.default_rng(1)
    x = (r.random((30, 60)) < 0.3).astype(np.float64)
    columns = (x / np.sqrt(x.sum(axis=1, keepdims=True))).T
    k = columns.T @ columns
    y = np.zeros((30, 3))
    y[np.arange(30), np.arange(30) % 3] = 1
    got = k @ lang_kernel._regress(k, columns, y)
    target, weight = y - 1 / 3, 1 / 30
    want = k @ np.linalg.solve(weight * k + lang_kernel.RIDGE * np.eye(30), weight * target)
    assert np.allclose(got, want, atol=1e-6)


# -- manifest ---------------------------------------------------------------


def up(level):
    return [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]


def proofs(nodes):
    """Root and, by place, the siblings from the leaves up (None: alone)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, p in enumerate(at):
            paths[k].append((p % 2, level[p ^ 1] if p ^ 1 < len(level) else None))
        at, level = [p // 2 for p in at], up(level)
    return level[0], paths


def leaf_of(row, more=0):
    doc_id, text, lang, source, n = row
    values = [doc_id, source, lang, None if n is None else n + more, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_manifest(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))):
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: proofs([leaf_of(r) for r in groups[g]]) for g in order}
    root, above = proofs([trees[g][0] for g in order])
    out = []
    for g, way in zip(order, above):
        for r, path in zip(groups[g], trees[g][1]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf_of(r, 1) if hit else leaf_of(r)
            for right, s in path + way:
                node = sha(node if s is None else (s + node if right else node + s))
            siblings = "".join(s for _, s in path + way if s)
            out.append((r[0], leaf_of(r), trees[g][0], root, sha(siblings), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_manifest_against_brute_force(spark, bits):
    rows = [(i, f"text {i}", "abcde"[i % 5] if i % 7 else "hot", "s", i) for i in range(150)]
    rows += [(None, None, None, None, None), (None, "", None, "s", 0), (3, "again", "d", "s", 5), (3, "again", "d", "s", 5),
             (-4, "é\n", "É", "s", None), (2**53 + 1, "x", "é", "s", 2**63 - 1), (900, "alone", "solo", "s", 5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("pos", "leaf", "grp", "node", "g", "h")})
    got = merkle.verified_documents(df.repartition(4), bits)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest(rows)
    assert got.where("not verified").count() == sum(zlib.crc32(str(r[0]).encode()) % 7 == 0 for r in rows if r[0] is not None and r[4] is not None)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_small_manifests(spark, n):
    rows = [(i, None, "en", None, None) for i in range(n)]
    got = merkle.verified_documents(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest(rows) if n else got.count() == 0


def test_manifest_proofs_are_usable(spark):
    rows = [(i, f"t{i}", "ab"[i % 2], "s", i) for i in range(40)]
    m = merkle.manifest(spark.createDataFrame(rows, SCHEMA), bits=2)
    assert m.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert m.where(merkle.fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).count() == 0
