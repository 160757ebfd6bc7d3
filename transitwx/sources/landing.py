"""Landed source data: JSON and CSV with explicit schemas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitwx.functions.times import month_from_name
from transitwx.schemas import (
    CAUSE,
    DETAILED_CAUSE,
    THIRD_CAUSE,
    TRAIN,
    TRAIN_CATEGORY,
    TRAIN_STATION,
    WEATHER_STATION,
)

# Dimension name -> schema of its landed records.
DIMENSIONS: dict[str, T.StructType] = {
    "stations": TRAIN_STATION,
    "weather_stations": WEATHER_STATION,
    "train_categories": TRAIN_CATEGORY,
    "causes": CAUSE,
    "detailed_causes": DETAILED_CAUSE,
    "third_causes": THIRD_CAUSE,
}


def read_trains(
    spark: SparkSession,
    path: str,
    start: str,
    end: str,
    schema: T.StructType = TRAIN,
) -> DataFrame:
    """Trains that departed on the days ``start``..``end``, both included.

    Landed layouts: ``departureDate=YYYY-MM-DD/`` or ``year=YYYY/month=MM/``
    folders below ``path``. Folders outside the range are not opened.
    """
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    trains = spark.read.schema(schema).json(path)
    days = trains.where(F.col("departureDate").between(first.isoformat(), last.isoformat()))
    if {"year", "month"} <= set(trains.columns):
        number = F.col("year") * 100 + F.col("month")
        days = days.where(
            number.between(first.year * 100 + first.month, last.year * 100 + last.month)
        )
    return days


def read_dimension(
    spark: SparkSession, name: str, path: str, one_document: bool = True
) -> DataFrame:
    """A code or station table.

    ``one_document``: each file is one JSON list, as the services send it (an
    empty list gives an empty table). Otherwise one record per line.
    """
    reader = spark.read.schema(DIMENSIONS[name]).option("multiLine", one_document)
    return reader.json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested weather documents, one per line, as text with their order."""
    return spark.read.text(path).withColumn("ord", F.col("_metadata.file_path"))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False
) -> DataFrame:
    """CSV with a header; only an empty field is NULL.

    ``line_breaks``: fields may hold them; a file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .csv(path)
    )


def read_monthly_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False
) -> DataFrame:
    """Monthly CSV files; ``source_month`` (YYYY-MM) comes from the file name."""
    files = read_csv(spark, path, schema, line_breaks)
    return files.withColumn("source_month", month_from_name(F.col("_metadata.file_name")))
