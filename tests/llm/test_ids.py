"""Ids of any type come through, beside nulls; other capitals stay; extra columns stay."""

import pytest
from pyspark.sql import functions as F

from cirrus.llm import decontam, lm_score, mixing, order_minhash, pii, token_scan, toxicity

BIG = 2**53
IDS = [BIG + 1, BIG + 3, None, -7, 0]
WORDS = ["alpha beta gamma delta one two three", "mail me at a.b@c.de or +49 170 1234567 now", "", "x y z " * 30, "x y z " * 30]


@pytest.fixture(params=["long", "string"])
def docs(request, spark):
    rows = [(i if request.param == "long" or i is None else f"id{i}", t, "en", "s", len(t)) for i, t in zip(IDS, WORDS)]
    return spark.createDataFrame(rows, f"doc_id {request.param}, text string, lang string, source string, n_chars long").coalesce(1)


@pytest.fixture
def labels(spark, docs):
    kind = docs.schema["doc_id"].dataType.simpleString()
    return spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").withColumn("doc_id", F.col("doc_id").cast(kind))


def ids_of(df):
    return sorted((r["doc_id"] for r in df.collect()), key=repr)


def test_ids_come_through(docs, labels):
    want = ids_of(docs)
    for out in (
        lm_score.lm_scores(docs, labels), token_scan.token_counts(docs), order_minhash.near_duplicates(docs),
        pii.personal_data(docs), toxicity.toxicity_scores(docs, labels),
    ):
        assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert ids_of(out) == want


def test_classes_and_texts_by_the_right_id(docs):
    got = order_minhash.near_duplicates(docs).collect()
    same = sorted((r["class_id"] for r in got if r["doc_id"] in (-7, 0, "id-7", "id0")), key=repr)
    assert same[0] == same[1]  # equal texts
    kept = order_minhash.one_of_each(docs).collect()
    assert len(kept) == 4 and {r["doc_id"] for r in kept} <= set(ids_of(docs))


def test_only_ascii_capitals_are_lowered(spark):
    docs = spark.createDataFrame([(1, "Ꟁ x"), (2, "ꟁ X"), (3, "É x"), (4, "é x"), (5, "A X")], "doc_id long, text string")
    tests = spark.createDataFrame([("i", "ꟁ x"), ("j", "é X"), ("k", "a x")], "item_id string, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontam.contaminated_documents(docs, tests).collect()}
    assert got == {1: 0, 2: 2, 3: 0, 4: 2, 5: 2}


def test_the_mix_keeps_other_columns(spark):
    rows = [(i, "w " * (i % 5), "en", f"s{i % 2}", 1, f"c{i}", float(i), i) for i in range(40)] + [(None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, Target double, copies long")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    whole = {repr(tuple(r)) for r in df.collect()}
    assert {repr(tuple(r)) for r in out.collect()} <= whole and out.count() > 20
