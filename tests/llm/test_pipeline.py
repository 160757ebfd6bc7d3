"""The pipeline's stages on the smallest driver tables."""

import os

import pytest

import corpus_pipeline
from transitwx.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


def test_stages(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    for name, function in corpus_pipeline.STAGES:
        kept = corpus_pipeline.stage(function(spark, docs, SF_DIR), name)
        before, after = ({r["doc_id"] for r in df.collect()} for df in (docs, kept))
        assert after <= before and after, name
        if name != "sharding":
            assert kept.schema == docs.schema
        if name == "near_dedup":
            assert queries.near_dedup.near_groups(kept).where("doc_id <> component_id").count() == 0
        if name == "decontamination":
            bench = queries.table(spark, SF_DIR, "benchmark")
            assert queries.decontamination.find_contamination(kept, bench).count() == 0
        docs = kept
    assert docs.groupBy("shard").count().count() == queries.SHARDS


def test_empty_tables(spark):
    docs = queries.table(spark, SF_DIR, "documents").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_repeated_ids_stay_once(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en"), (1, text, "en"), (2, "only this one", "de"), (3, text, "fr"), (4, "", None), (4, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, first string")
    kept = [r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, SF_DIR).orderBy("doc_id").collect()]
    assert kept == [1, 2, 4]


def test_long_texts_make_small_blocks(spark):
    from transitwx.llm.blocks import in_block_pairs

    rows = spark.range(40).selectExpr("id", "1 as key", "100L as weight")
    dealt = in_block_pairs(rows, ["key"], 2048, 1000)
    assert dealt.select("block").distinct().count() == 4
    assert dealt.groupBy("id").count().where("count <> 4").count() == 0
    assert in_block_pairs(rows, ["key"], 2048, 1 << 20).count() == 40
