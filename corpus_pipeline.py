"""The corpus pipeline: every stage works on what the one before it kept.

Toxic documents go, one document of each group of near copies stays, documents
with benchmark passages go, sources are mixed to their target weights, and the
mix is put into shards. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitwx.llm import decontamination, mixing, near_dedup, queries, sharding, toxicity
from transitwx.llm.bits import in_bits, only, own_name, without
from transitwx.session import stage

#: A stage takes (spark, docs, sf_dir).
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; all labels may be learned from but
    those held out in the operator's own query."""
    return toxicity.keep_clean(docs, queries.toxicity_model(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id;
    of rows with one id (or without), the one whose text has the smallest hash."""
    found = near_dedup.near_groups(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    found = stage(found, "found")
    kept = without(docs, "doc_id", found.where("not kept or rows > 1").select("doc_id"))
    again = only(docs, "doc_id", found.where("kept and rows > 1").select("doc_id"))
    first = F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.xxhash64("text")).alias("first")
    return kept.unionByName(again.groupBy(F.col("doc_id").alias("id")).agg(first).select("first.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training. Rows are
    whole: the document that a source's target cuts comes once more if at least
    half of it is taken. Texts without words are not part of a mix. Rows that
    repeat an id (or have none) are told apart by size."""
    plan = mixing.plan_mix(docs)
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("size"))
    plan = stage(plan, "plan")
    ids = plan.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    ids = stage(ids, "repeated")

    def numbered(rows: DataFrame, nth: Column, name: str) -> DataFrame:
        own, flag = in_bits(rows, "doc_id", ids)
        return own.where(~F.col(flag)).withColumn(name, F.lit(1)).unionByName(own.where(flag).withColumn(name, nth)).drop(flag)

    copies = mixing.training_order(numbered(plan, nth, "nth"), "nth").where("2 * words >= size")
    key, place, copy, number, which = (own_name(docs, n) for n in ("id", "position", "copy", "nth", "nth_of"))
    order = copies.select(
        F.col("doc_id").alias(key), F.col("position").alias(place), F.col("copy").alias(copy), F.col("nth").alias(which)
    )
    order = stage(order, "order")
    by_size = F.row_number().over(Window.partitionBy("doc_id").orderBy(mixing.words_in(F.col("text"))))
    rows = numbered(docs, by_size, number)
    rows = rows.join(order, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(number) == F.col(which)))
    return rows.orderBy(place, "doc_id", copy).select(*(F.col(f"`{c}`") for c in docs.columns))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix; copies of a document are one group."""
    return sharding.shard(docs, shards=queries.SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("near_dedup", distinct),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Training a classifier and comparing hashes have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"stage-{name}")
    return docs
