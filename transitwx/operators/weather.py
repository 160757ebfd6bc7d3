"""Weather observations: from nested documents or long rows to wide rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitwx.functions.numbers import nan_to_null
from transitwx.functions.times import parse_lenient
from transitwx.operators.first import first_row
from transitwx.schemas import STATION_DOCUMENT, WEATHER_DOCUMENT


def flatten_documents(docs: DataFrame, params: Sequence[str], body: str = "value") -> DataFrame:
    """One wide row per (time, station) of each nested document.

    Row by row, without a shuffle. NaN readings become NULL.
    """
    times = docs.select(F.explode(F.from_json(body, WEATHER_DOCUMENT)).alias("time", "stations"))
    rows = times.select("time", F.explode("stations").alias("station_name", "readings"))
    return rows.select(
        parse_lenient(F.col("time")).alias("timestamp"),
        "station_name",
        *[nan_to_null(F.col("readings")[p]["value"]).alias(p) for p in params],
    )


def document_readings(docs: DataFrame, body: str = "value") -> DataFrame:
    """Every reading of nested documents as a row, whatever its parameter:
    ``timestamp, station_name, parameter, value, text``.

    Documents are read as they come, without a schema. ``value`` is the number, NULL
    where there is none or NaN; ``text`` holds what is not a number. Broken
    documents have no readings.
    """
    parsed = docs.select(F.try_parse_json(F.regexp_replace(body, r":\s*-?(?:NaN|Infinity)\b", ": null")).alias("v"))

    def opened(df: DataFrame, kept: Sequence[str], key: str) -> DataFrame:
        found = df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
        return found.select(*kept, F.col("key").alias(key), F.col("value").alias("v"))

    rows = opened(parsed, [], "time")
    rows = opened(rows, ["time"], "station_name")
    rows = opened(rows, ["time", "station_name"], "parameter")
    reading = F.try_variant_get("v", "$.value", "double")
    kind = F.schema_of_variant(F.coalesce(F.try_variant_get("v", "$.value", "variant"), F.parse_json(F.lit("null"))))
    other = F.when(kind.isin("STRING", "BOOLEAN") | kind.rlike("^(OBJECT|ARRAY)"), F.to_json(F.try_variant_get("v", "$.value", "variant")))
    return rows.select(
        parse_lenient(F.col("time")).alias("timestamp"),
        "station_name",
        "parameter",
        F.when(other.isNull(), reading).alias("value"),
        other.alias("text"),
    )


def unlisted_parameters(docs: DataFrame, params: Sequence[str], body: str = "value") -> DataFrame:
    """Parameters of the documents that ``params`` does not list, with their rows,
    readings, stations and times."""
    rows = document_readings(docs, body).where(~F.col("parameter").isin(list(params)))
    return rows.groupBy("parameter").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("readings"),
        F.count_distinct("station_name").alias("stations"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


def weather_parameters(settings) -> list[str]:
    """All parameters that settings name."""
    return list(dict.fromkeys([*settings.rolling_params, *settings.fallback_features]))


def pivot_readings(
    readings: DataFrame,
    keys: Sequence[str],
    params: Sequence[str],
    param: str = "param",
    value: str = "value",
) -> DataFrame:
    """Long readings to wide rows; the parameters are known beforehand.

    Naming them spares the extra job that would look for them.
    """
    return readings.groupBy(*keys).pivot(param, list(params)).agg(F.max(value))


def station_metadata(docs: DataFrame, body: str = "value", order: str = "ord") -> DataFrame:
    """Stations of the first document that lists any."""
    listed = docs.select(order, F.from_json(body, STATION_DOCUMENT).alias("m"))
    listed = listed.where(F.size("m") > 0)
    first = listed.agg(F.min(order).alias("first")).scalar()
    return (
        listed.where(F.col(order) == first)
        .select(F.explode("m").alias("station_name", "at"))
        .select("station_name", "at.*")
    )


def station_metadata_by_key(stations: DataFrame, order: str = "ord") -> DataFrame:
    """Each station as its first document describes it."""
    return first_row(stations, ["station_name"], order)


def in_box(
    places: DataFrame, box: tuple[float, float, float, float], lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Places in a box (west, south, east, north)."""
    west, south, east, north = box
    return places.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def in_box_and_time(
    obs: DataFrame,
    box: tuple[float, float, float, float],
    start,
    stop,
    time: str = "timestamp",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Observations in a box (west, south, east, north) and a closed time range."""
    return in_box(obs.where(F.col(time).between(start, stop)), box, lat, lon)
