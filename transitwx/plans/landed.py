"""The loop over months: whatever has landed since the last call is worked in."""

from __future__ import annotations

import calendar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitwx.config import Settings
from transitwx.functions.times import month_start, parse_date, parse_lenient
from transitwx.operators.weather import (
    flatten_documents,
    in_box,
    station_metadata,
    unlisted_parameters,
    weather_parameters,
)
from transitwx.plans.job import run_month
from transitwx.schemas import TRAIN, WEATHER_DOCUMENT
from transitwx.sources.landing import read_documents, read_trains


def months_of_trains(trains: DataFrame) -> DataFrame:
    return trains.select(month_start(parse_date(F.col("departureDate"))).alias("month"))


def months_of_documents(docs: DataFrame, reach_hours: int) -> DataFrame:
    """Months that the observations of nested documents have a part in: their own,
    and the next one if its windows reach back to them."""
    times = F.map_keys(F.from_json("value", WEATHER_DOCUMENT))
    at = docs.select(F.explode(times).alias("text")).select(parse_lenient(F.col("text")).alias("at"))
    later = F.col("at") + F.expr(f"interval {int(reach_hours)} hours")
    return at.select(F.explode(F.array(month_start(F.col("at").cast("date")), month_start(later.cast("date")))).alias("month"))


def run_landed(
    spark: SparkSession,
    trains_path: str,
    weather_path: str,
    metadata_path: str,
    stations: DataFrame,
    out: str,
    checkpoint: str,
    settings: Settings = Settings(),
) -> dict[str, list[str]]:
    """Run every month that new files have a part in; month -> parameters its
    weather has but ``settings`` do not list.

    ``trains_path`` has JSON lines in ``departureDate=`` folders, ``weather_path``
    nested observation documents and ``metadata_path`` station documents, one per
    line. Which files are new is known from ``checkpoint``: a call reads their days
    only, and then the months they lie in. A month waits until both sides have
    landed. Weather stations are those of the first document that lists any, inside
    ``settings.bounding_box``. If a month fails, its files count as new next time.
    """
    done: dict[str, list[str]] = {}
    ems = in_box(station_metadata(read_documents(spark, metadata_path)), settings.bounding_box)
    # (documents list stations in no order; their names decide a tie in distance)
    ems = ems.withColumn("ord", F.col("station_name"))
    reach = max(settings.rolling_hours)

    def run(months: DataFrame, _batch: int) -> None:
        # one row per month of the calendar
        for r in months.where("month is not null").distinct().orderBy("month").collect():
            first = r["month"]
            last = first.replace(day=calendar.monthrange(first.year, first.month)[1])
            trains = read_trains(spark, trains_path, str(first), str(last))
            docs = read_documents(spark, weather_path)
            weather = flatten_documents(docs, weather_parameters(settings))
            own = weather.where(month_start(F.col("timestamp").cast("date")) == F.lit(first))
            if trains.isEmpty() or own.isEmpty():
                continue
            month = f"{first:%Y-%m}"
            run_month(trains, weather, stations, ems, out, month, settings)
            done[month] = [p["parameter"] for p in unlisted_parameters(docs, weather_parameters(settings)).collect()]

    new_trains = months_of_trains(spark.readStream.schema(TRAIN).json(trains_path))
    new_docs = months_of_documents(spark.readStream.text(weather_path), reach)
    query = (
        new_trains.unionByName(new_docs)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
