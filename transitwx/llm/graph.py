"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.session import stage


def _edges(df: DataFrame) -> DataFrame:
    a, b = df.columns
    return (
        df.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every id in ``links`` (two id columns).

    The component is named by its smallest id. Large-star and small-star rounds
    hang every id below ever smaller neighbours until each component is one
    star; the number of rounds grows with the logarithm of its size. Each round
    is written to the shared folder, so a lost executor repeats one round only.
    No links give an empty table; links of an id to itself or to null are
    ignored.
    """
    edges = stage(_edges(links.na.drop()), "links")
    before = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("x", "y")
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = (
            both.where("y > x").join(lowest, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u").where("v <> m").select("v", "m").union(root.select("u", "m")).toDF("u", "v").distinct()
        )
        edges = stage(small, "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == before:
            return edges.toDF("id", "component_id")
        before = now
