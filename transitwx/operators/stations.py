"""Station and code tables: clean-up, lookups, translation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.operators.first import first_row

# Columns that are dropped, and the new names of those kept.
DROPPED = ("type", "stationUICCode", "countryCode")
RENAMED = {
    "stationName": "train_station_name",
    "stationShortCode": "train_station_short_code",
    "longitude": "train_long",
    "latitude": "train_lat",
}


def station_dimension(stations: DataFrame) -> DataFrame:
    """Train stations under the names the other operators use."""
    return stations.drop(*DROPPED).withColumnsRenamed(RENAMED)


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    take: dict[str, str],
    order: str | Sequence[str],
) -> DataFrame:
    """Left lookup: the first table row of the key, NULLs where there is none.

    No broadcast is forced: Spark broadcasts the table while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond that, where
    adaptive execution splits a key that holds too many rows.
    """
    cols = list(take)
    order = [order] if isinstance(order, str) else list(order)
    needed = list(dict.fromkeys([table_key, *cols, *order]))
    small = first_row(table.where(F.col(table_key).isNotNull()).select(*needed), [table_key], order)
    small = small.select(
        F.col(table_key).alias("__key"), *[F.col(c).alias(new) for c, new in take.items()]
    )
    return facts.join(small, F.col(key) == F.col("__key"), "left").drop("__key")


def translate(
    codes: DataFrame, text: str, dictionary: DataFrame, target: str | None = None
) -> DataFrame:
    """Add ``text_en`` from a dictionary table (source, target).

    Empty or NULL text gives ``""``; text without an entry is marked.
    """
    target = target or f"{text}_en"
    known = dictionary.select("source", "target").where("target is not null")
    entries = first_row(known, ["source"], "target")
    entries = entries.select(F.col("source").alias("__source"), F.col("target").alias("__target"))
    empty = F.col(text).isNull() | (F.col(text) == "")
    value = F.when(empty, F.lit("")).otherwise(
        F.coalesce(F.col("__target"), F.concat(F.col(text), F.lit(" [untranslated]")))
    )
    joined = codes.join(entries, F.col(text) == F.col("__source"), "left")
    return joined.select(*codes.columns, value.alias(target))
