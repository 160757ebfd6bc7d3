"""Railway-shaped views over the driver's tables, for Spark and for DuckDB.

Each view exists twice with the same meaning: a DataFrame here and SQL text in
``VIEWS``. Coordinates and running times are invented by formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from transitwx.functions.times import micros
from transitwx.operators.timetable import ordinal, renest_stops
from transitwx.session import prepare

LINE_ORDER = (
    "l_shipdate",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)
EVENT_TYPES = ("view", "click", "error", "signup", "purchase")
# event type -> weather parameter it stands for
PARAMETERS = {
    "view": "Snow depth",
    "click": "Precipitation amount",
    "error": "Wind speed",
    "signup": "Gust speed",
    "purchase": "Air temperature",
}

VIEWS: dict[str, str] = {
    "v_stop": f"""
        SELECT o_orderkey train_id, o_custkey train_number,
               CAST(o_orderdate AS DATE) departure_date, o_orderpriority train_category,
               l_suppkey station_code, l_partkey part_code, l_linenumber line_number,
               CAST(row_number() OVER (PARTITION BY l_orderkey
                    ORDER BY {", ".join(LINE_ORDER)}) - 1 AS INT) idx,
               CASE WHEN l_returnflag = 'N' THEN NULL
                    ELSE CAST(l_quantity AS INT) - 10 END diff
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "v_obs": """
        SELECT user_id station, epoch_us(ts) us, ts, event_id, event_type param,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END val
        FROM events""",
    "v_obs_wide": "SELECT user_id station, epoch_us(date_trunc('hour', ts)) us, "
    + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) p_{t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY user_id, date_trunc('hour', ts)",
    "v_geo": """
        SELECT DISTINCT user_id station, 60 + (user_id * 37 % 1009) / 1e2 lat,
               20 + (user_id * 91 % 1013) / 1e2 lon
        FROM events""",
    "v_train_station": """
        SELECT c_custkey code, c_name name, 60 + (c_custkey * 37 % 1009) / 1e2 lat,
               20 + (c_custkey * 91 % 1013) / 1e2 lon
        FROM customer""",
    "v_ems": """
        SELECT s_suppkey ems, s_name name, 60 + (s_suppkey * 53 % 1009) / 1e2 lat,
               20 + (s_suppkey * 67 % 1013) / 1e2 lon
        FROM supplier""",
    "v_req": """
        SELECT event_id stop_id, user_id station, epoch_us(ts) us
        FROM events WHERE event_type = 'signup'""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def place(key: Column, a: int, b: int) -> tuple[Column, Column]:
    """Invented coordinates; no two keys below 1009 x 1013 coincide."""
    return F.lit(60) + (key * a % 1009) / F.lit(1e2), F.lit(20) + (key * b % 1013) / F.lit(1e2)


def v_stop(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """``together`` leaves all stops of a train in one task, for those who make them
    one list next: they are numbered, meet their order and are nested in one shuffle."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER, "l_returnflag")
    if together:
        within = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
        # as with ``ordinal``, lines without a date are counted and then left out
        lines = lines.withColumn("idx", within - 1).where(F.col("l_shipdate").isNotNull())
    else:
        lines = ordinal(lines, ["l_orderkey"], LINE_ORDER, split=F.trunc("l_shipdate", "month"))
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("train_id"),
        F.col("o_custkey").alias("train_number"),
        F.col("o_orderdate").cast("date").alias("departure_date"),
        F.col("o_orderpriority").alias("train_category"),
        F.col("l_suppkey").alias("station_code"),
        F.col("l_partkey").alias("part_code"),
        F.col("l_linenumber").alias("line_number"),
        "idx",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int") - 10).alias("diff"),
    )


def v_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("station"),
        micros(F.col("ts")).alias("us"),
        "ts",
        "event_id",
        F.col("event_type").alias("param"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("val"),
    )


def v_obs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("station"), micros(F.date_trunc("hour", "ts")).alias("us")
    )
    return hourly.agg(
        *[
            F.max(F.when(F.col("event_type") == t, F.col("value"))).alias(f"p_{t}")
            for t in EVENT_TYPES
        ]
    )


def v_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("station")).distinct()
    lat, lon = place(F.col("station"), 37, 91)
    return users.select("station", lat.alias("lat"), lon.alias("lon"))


def v_train_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = place(F.col("c_custkey"), 37, 91)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("name"),
        lat.alias("lat"),
        lon.alias("lon"),
    )


def v_ems(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = place(F.col("s_suppkey"), 53, 67)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ems"),
        F.col("s_name").alias("name"),
        lat.alias("lat"),
        lon.alias("lon"),
    )


def v_req(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'signup'")
        .select(
            F.col("event_id").alias("stop_id"),
            F.col("user_id").alias("station"),
            micros(F.col("ts")).alias("us"),
        )
    )


# --- the whole merge: trains of January 2024, stations and weather -----------

VIEWS["v_run"] = """
    SELECT *, CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', departure_date) % 30 AS INT) AS DATE) AS day
    FROM v_stop"""
VIEWS["v_call"] = """
    SELECT *, epoch_us(CAST(day AS TIMESTAMP)) + idx * 2220000000
              + (part_code % 3600) * 1000000 + (station_code % 1000) * 1000 call_us
    FROM v_run"""
VIEWS["v_place"] = """
    SELECT 'S' || station station_name, station ord, lat, lon FROM v_geo
    UNION ALL
    SELECT 'D' || ems, 1000000000 + ems, lat, lon FROM v_ems"""
VIEWS["v_weather"] = "SELECT 'S' || station station_name, us, " + ", ".join(
    f'p_{t} "{p}"' for t, p in PARAMETERS.items()
) + " FROM v_obs_wide"


def trains(spark: SparkSession, sf_dir: str, shift_to_2024: bool = False) -> DataFrame:
    """Nested trains in the landed shape; ``version`` holds the order key.

    Shifted trains run in January 2024 and stop at places named by part key, a
    quarter of which no station table knows. Some times lack their fraction.
    """
    stops = v_stop(spark, sf_dir, together=True)
    if shift_to_2024:
        offset = F.datediff("departure_date", F.lit("1995-01-01").cast("date")) % 30
        day = F.date_add(F.lit("2024-01-01").cast("date"), offset)
        us = (
            micros(day)
            + F.col("idx").cast("long") * 2_220_000_000
            + (F.col("part_code") % 3600) * 1_000_000
            + (F.col("station_code") % 1000) * 1000
        )
        at = F.timestamp_micros(us)
        text = F.when(F.col("line_number") == 7, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        text = text.otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        code = F.col("part_code")
    else:
        day, text, code = F.col("departure_date"), F.lit(None).cast("string"), F.col("station_code")
    rows = stops.select(
        F.col("train_number").alias("trainNumber"),
        F.date_format(day, "yyyy-MM-dd").alias("departureDate"),
        F.col("train_category").alias("trainCategory"),
        F.col("train_id").alias("version"),
        "idx",
        code.cast("string").alias("stationShortCode"),
        F.when(F.col("idx") % 2 == 0, "DEPARTURE").otherwise("ARRIVAL").alias("type"),
        text.alias("scheduledTime"),
        F.col("diff").alias("differenceInMinutes"),
    )
    return renest_stops(
        rows,
        ["trainNumber", "departureDate", "trainCategory", "version"],
        ["stationShortCode", "type", "scheduledTime", "differenceInMinutes"],
    )


def train_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_train_station`` under the column names of the station dimension."""
    return v_train_station(spark, sf_dir).select(
        F.col("code").cast("string").alias("train_station_short_code"),
        F.col("name").alias("train_station_name"),
        F.col("lat").alias("train_lat"),
        F.col("lon").alias("train_long"),
        F.col("code").alias("ord"),
    )


def ems_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_ems`` under the column names of the weather-station table."""
    return v_ems(spark, sf_dir).select(
        F.col("ems").alias("station_name"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("ems").alias("ord"),
    )


def geo_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_geo`` under the column names of the weather-station table."""
    return v_geo(spark, sf_dir).select(
        F.col("station").alias("station_name"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("station").alias("ord"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather stations with data (S..) and without (D..)."""
    wet = geo_stations(spark, sf_dir)
    dry = ems_stations(spark, sf_dir).withColumn("ord", F.col("ord") + 1_000_000_000)
    wet = wet.withColumn("station_name", F.concat(F.lit("S"), F.col("station_name")))
    dry = dry.withColumn("station_name", F.concat(F.lit("D"), F.col("station_name")))
    return wet.unionByName(dry)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide hourly weather with the parameter names of the source."""
    return v_obs_wide(spark, sf_dir).select(
        F.timestamp_micros("us").alias("timestamp"),
        F.concat(F.lit("S"), F.col("station")).alias("station_name"),
        *[F.col(f"p_{t}").alias(p) for t, p in PARAMETERS.items()],
    )
