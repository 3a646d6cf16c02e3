"""The pipeline against its operators and brute force, stage by stage."""

import collections

import corpus_pipeline
from cirrus.llm import decontam, gam, hilbert, mixing, order_minhash
from cirrus.llm.common import read_table

SF = "/root/testdata/sf0.001"


def ids(df):
    return collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, tmp_dir):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_dir}/{n}")
        docs = spark.read.parquet(f"{tmp_dir}/{n}")
        if name != "shard":
            assert docs.columns == columns
        if name == "quality":
            scored = gam.quality_scores(before, read_table(spark, SF, "labels"))
            assert ids(docs) == ids(scored.where("score >= 0.3"))
        elif name == "near_dedup":
            assert ids(docs) == ids(order_minhash.near_duplicates(before).where("kept"))
        elif name == "decontaminate":
            asked = decontam.contaminated_documents(before, read_table(spark, SF, "benchmark"))
            assert ids(docs) == ids(asked.where("not contaminated"))
        elif name == "mix":
            taken = {r["doc_id"]: r["copies"] for r in mixing.mixed_sizes(before).collect() if r["copies"]}
            assert ids(docs) == taken
        else:
            assert ids(docs) == ids(before)
            n = collections.Counter(r["shard"] for r in docs.collect())
            assert len(n) == hilbert.SHARDS and max(n.values()) - min(n.values()) <= 1
    assert ids(corpus_pipeline.run(spark, SF)) == ids(docs)
