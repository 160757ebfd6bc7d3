"""The registered queries over the driver's tables, each beside its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitwx.config import DAY_US, DELAY, DELAY_FROM_ORIGIN, DELAY_FROM_PREVIOUS, HOUR_US, Settings
from transitwx.functions import times
from transitwx.functions.geo import haversine_km
from transitwx.functions.naming import rolling_columns
from transitwx.operators import delays, months, quality, stations, timetable, weather
from transitwx.operators.asof import asof_nearest, asof_with_fallback
from transitwx.operators.first import first_row
from transitwx.operators.nearest import (
    candidate_lists,
    nearest_station,
    ranked_stations,
    top_stations,
    top_stations_wide,
)
from transitwx.operators.rolling import rolling_features, rolling_for_month, trailing_slice
from transitwx.plans import driver_tables as dt
from transitwx.plans.driver_tables import EVENT_TYPES, PARAMETERS, VIEWS, table
from transitwx.plans.job import load_summary, run_month, save_summary
from transitwx.plans.weather_merge import (
    merge_stops,
    merge_tables,
    nest_merged,
    station_candidates,
    weather_blocks,
    weather_features,
)
from transitwx.schemas import STOP, TRAIN
from transitwx.session import prepare, scratch_path, stage
from transitwx.sources import landing, tables
from transitwx.sources.blocks import read_blocks, write_blocks
from transitwx.sources.releases import read_release

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HOURS = (12, 24, 72)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; views its SQL names are put in front of it."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return add


def with_views(sql: str) -> str:
    used: list[str] = []

    def need(text: str) -> None:
        for view in VIEWS:
            if re.search(rf"\b{view}\b", text) and view not in used:
                need(VIEWS[view])
                used.append(view)

    need(sql)
    if not used:
        return sql
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in used)
    body = sql.strip()
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


def r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def rolling_sql(
    param: str, hours=HOURS, extremes: bool = True, partition: str = "station", q: str = '"'
) -> list[str]:
    """Window expressions of one parameter, named like the operator names them."""
    out = []
    col = f'"{param}"'
    for h in hours:
        frame = (
            f"OVER (PARTITION BY {partition} ORDER BY us "
            f"RANGE BETWEEN {h * HOUR_US - 1} PRECEDING AND CURRENT ROW)"
        )
        total = f"(round_even(sum({col}) {frame} * 1e6, 0) / 1e6)"
        if extremes:
            out.append(f'{r2(f"max({col}) {frame}")} AS "{param} ({h}h max)"')
            out.append(f'{r2(f"min({col}) {frame}")} AS "{param} ({h}h min)"')
        out.append(f'{r2(f"{total} / count({col}) {frame}")} AS "{param} ({h}h mean)"')
        out.append(f'{r2(total)} AS "{param} ({h}h cumulative)"')
    return out


# --- daily delay summaries ----------------------------------------------------


def summary_sql(diff: str, source: str = "v_stop", train: str = "train_number") -> str:
    late = f"FILTER (WHERE {diff} >= 5)"
    return f"""
        SELECT departure_date, CAST(year(departure_date) AS INT) AS year,
               CAST(month(departure_date) AS INT) AS month,
               CAST(day(departure_date) AS INT) AS day_of_month,
               CAST(isodow(departure_date) AS INT) AS day_of_week,
               count(*) {late} AS delay_count_by_day, count(*) AS total_schedules_by_day,
               CAST(coalesce(sum({diff}) {late}, 0) AS BIGINT) AS total_delay_minutes,
               CAST(coalesce(max({diff}) {late}, 0) AS BIGINT) AS max_delay_minutes,
               count(DISTINCT {train}) AS total_trains_on_route,
               coalesce({r2(f"CAST(sum({diff}) {late} AS DOUBLE) / nullif(count(*) {late}, 0)")}, 0)
                   AS avg_delay_minutes
        FROM {source} WHERE departure_date IS NOT NULL GROUP BY departure_date"""


OFFSETS_SQL = """
        SELECT train_id, train_number, departure_date, idx, diff,
               CASE WHEN diff IS NULL THEN NULL WHEN idx = 0 OR head IS NULL THEN diff
                    ELSE diff - head END AS diff_offset,
               CASE WHEN diff IS NULL THEN NULL WHEN prev IS NULL THEN diff
                    ELSE diff - prev END AS diff_each
        FROM (SELECT *, first_value(diff) OVER (PARTITION BY train_id ORDER BY idx) head,
                     last_value(diff IGNORE NULLS) OVER (PARTITION BY train_id ORDER BY idx
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) prev
              FROM v_stop)"""
METRICS = ("diff", "diff_offset", "diff_each")


def _offsets(spark: SparkSession, d: str) -> DataFrame:
    return timetable.add_offsets(dt.v_stop(spark, d), ["train_id"])


@query("delay_daily", summary_sql("diff"))
def delay_daily(spark, d):
    return delays.daily_delays(dt.v_stop(spark, d), ["diff"]).drop("metric")


@query("delay_offsets", f"SELECT train_id, idx, diff, diff_offset, diff_each FROM ({OFFSETS_SQL})")
def delay_offsets(spark, d):
    return _offsets(spark, d).select("train_id", "idx", "diff", "diff_offset", "diff_each")


@query(
    "delay_daily_3",
    f"WITH o AS ({OFFSETS_SQL}) "
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, * FROM ({summary_sql(m, 'o')})" for m in METRICS),
)
def delay_daily_3(spark, d):
    return delays.daily_delays(_offsets(spark, d), METRICS)


TOP10_SQL = """
        SELECT departure_date, '[' || coalesce(string_agg(CAST(diff AS VARCHAR), ', ' ORDER BY rk)
                   FILTER (WHERE rk <= 10), '') || ']' AS top_10_common_delays
        FROM (SELECT DISTINCT departure_date FROM v_stop) LEFT JOIN (
              SELECT departure_date, diff, row_number() OVER (PARTITION BY departure_date
                         ORDER BY count(*) DESC, diff) rk
              FROM v_stop WHERE diff >= 5 GROUP BY departure_date, diff) USING (departure_date)
        GROUP BY departure_date"""


@query("delay_top10", TOP10_SQL)
def delay_top10(spark, d):
    summary = delays.delay_summary(dt.v_stop(spark, d), ["diff"])
    return summary.select("departure_date", "top_10_common_delays")


@query(
    "delay_summary",
    f"SELECT * EXCLUDE (departure_date) FROM ({summary_sql('diff')}) JOIN ({TOP10_SQL}) USING (departure_date)",
)
def delay_summary(spark, d):
    return delays.delay_summary(dt.v_stop(spark, d), ["diff"]).drop("metric", "departure_date")


@query(
    "delay_month_totals",
    f"""SELECT year, month, count(*) AS days, CAST(sum(delay_count_by_day) AS BIGINT) AS total_delays,
               CAST(sum(total_schedules_by_day) AS BIGINT) AS total_schedules,
               CAST(sum(total_trains_on_route) AS BIGINT) AS total_trains
        FROM ({summary_sql('diff')}) GROUP BY year, month""",
)
def delay_month_totals(spark, d):
    return delays.month_totals(delay_daily(spark, d))


@query(
    "month_distinct_trains",
    """SELECT CAST(year(departure_date) AS INT) AS year, CAST(month(departure_date) AS INT) AS month,
              count(DISTINCT train_number) AS distinct_trains
       FROM v_stop WHERE departure_date IS NOT NULL GROUP BY ALL""",
)
def month_distinct_trains(spark, d):
    """Trains that ran in a month, merged from exact bitmaps of its days."""
    days = stage(delays.train_bitmaps(delays.tally(dt.v_stop(spark, d), ["diff"])), "train-days")
    return delays.distinct_trains(days, year=F.year("day"), month=F.month("day"))


_UPSERT_SQL = f"""WITH s AS ({summary_sql('diff')})
        SELECT * EXCLUDE (delay_count_by_day),
               CASE WHEN departure_date < DATE '1998-01-01' THEN 0 ELSE delay_count_by_day END
                   AS delay_count_by_day
        FROM s"""


def _old_and_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Old: days before 1999 with their counts zeroed. New: days from 1998 on."""
    daily = stage(delay_daily(spark, d), "daily")
    old = daily.where("departure_date < '1999-01-01'").withColumn(
        "delay_count_by_day", F.lit(0).cast("long")
    )
    return old, daily.where("departure_date >= '1998-01-01'")


@query("summary_upsert", _UPSERT_SQL)
def summary_upsert(spark, d):
    return delays.upsert_summary(*_old_and_new(spark, d))


@query("summary_roundtrip", _UPSERT_SQL)
def summary_roundtrip(spark, d):
    """The same as a stored table; the new days are saved twice."""
    old, new = _old_and_new(spark, d)
    path = scratch_path(spark, "summary-table")
    for days in (old, new, new):
        save_summary(days, path)
    return load_summary(spark, path)


# --- filters, lists and order of stops ----------------------------------------


@query(
    "category_filter",
    "SELECT train_id, idx, train_category FROM v_stop WHERE train_category = '1-URGENT'",
)
def category_filter(spark, d):
    stops = dt.v_stop(spark, d)
    return timetable.filter_category(stops, "1-URGENT", "train_category").select(
        "train_id", "idx", "train_category"
    )


@query(
    "route_filter",
    """SELECT train_id FROM v_stop WHERE station_code IN (1, 2)
       GROUP BY train_id HAVING count(DISTINCT station_code) = 2""",
)
def route_filter(spark, d):
    """Nested form: the test runs inside each train's list."""
    chosen = timetable.filter_route(dt.trains(spark, d), ["1", "2"])
    return chosen.select(F.col("version").alias("train_id"))


@query(
    "route_filter_flat",
    """SELECT train_id, idx, station_code FROM v_stop WHERE train_id IN (
         SELECT train_id FROM v_stop WHERE station_code IN (1, 2)
         GROUP BY train_id HAVING count(DISTINCT station_code) = 2)""",
)
def route_filter_flat(spark, d):
    stops = dt.v_stop(spark, d).select("train_id", "idx", "station_code")
    return timetable.filter_route_flat(stops, ["train_id"], "station_code", [1, 2])


@query(
    "filter_counts",
    """SELECT count(*) AS before, count(*) FILTER (WHERE urgent) AS category,
              count(*) FILTER (WHERE urgent AND passes) AS route
       FROM (SELECT train_id, bool_or(train_category = '1-URGENT') urgent,
                    count(DISTINCT station_code) FILTER (WHERE station_code IN (1, 2)) = 2 passes
             FROM v_stop GROUP BY train_id)""",
)
def filter_counts(spark, d):
    stages = {
        "category": F.col("trainCategory") == "1-URGENT",
        "route": timetable.passes_all(F.col(timetable.ROWS), ["1", "2"]),
    }
    return quality.filter_counts(dt.trains(spark, d), stages)


@query(
    "station_name_join",
    """SELECT train_id, idx, CAST(station_code AS VARCHAR) AS station_code, name AS station_name
       FROM v_stop LEFT JOIN v_ems ON station_code = ems AND ems % 10 <> 0""",
)
def station_name_join(spark, d):
    """Every tenth station is left unnamed in the dimension, so NULLs show."""
    named = dt.v_ems(spark, d).select(
        F.when(F.col("ems") % 10 != 0, F.col("ems")).cast("string").alias("stationShortCode"),
        F.col("name").alias("stationName"),
        F.col("ems").alias("ord"),
    )
    trains = timetable.add_station_names(stage(dt.trains(spark, d), "trains"), named)
    return timetable.explode_stops(trains.select("version", timetable.ROWS)).select(
        F.col("version").alias("train_id"),
        "idx",
        F.col("stationShortCode").alias("station_code"),
        F.col("stationName").alias("station_name"),
    )


@query(
    "renest_stops",
    f"""SELECT train_id, count(*) AS stops,
               string_agg(coalesce(CAST(diff AS VARCHAR), '-') || '/' || coalesce(CAST(diff_offset AS VARCHAR), '-')
                   || '/' || coalesce(CAST(diff_each AS VARCHAR), '-'), ' ' ORDER BY idx) AS delays
        FROM ({OFFSETS_SQL}) GROUP BY train_id""",
)
def renest_stops(spark, d):
    """Offsets worked out and inserted inside the list, then shown as text."""
    trains = timetable.add_nested_offsets(dt.trains(spark, d))
    show = lambda s, f: F.coalesce(s[f].cast("string"), F.lit("-"))
    text = F.transform(
        timetable.ROWS,
        lambda s: F.concat_ws("/", *[show(s, f) for f in (DELAY, DELAY_FROM_ORIGIN, DELAY_FROM_PREVIOUS)]),
    )
    return trains.select(
        F.col("version").alias("train_id"),
        F.size(timetable.ROWS).cast("long").alias("stops"),
        F.array_join(text, " ").alias("delays"),
    )


@query(
    "decode_timetable",
    """SELECT train_id, CAST(idx AS INT) AS idx, CAST(station_code AS VARCHAR) AS station_code,
              CASE WHEN diff >= 5 THEN TRUE WHEN diff < 5 THEN FALSE END AS train_stopping,
              CASE WHEN idx % 2 = 0 THEN 'None, True' ELSE 'O''Brien' END AS station_name, diff
       FROM v_stop""",
)
def decode_timetable(spark, d):
    """Lists written as Python text, built from the stops, read back as records."""
    stops = dt.v_stop(spark, d, together=True)
    word = F.when(F.col("diff") >= 5, "True").when(F.col("diff") < 5, "False").otherwise("None")
    name = F.when(F.col("idx") % 2 == 0, "'None, True'").otherwise('"O\'Brien"')
    text = F.concat(
        F.lit("{'stationName': "), name,
        F.lit(", 'stationShortCode': '"), F.col("station_code").cast("string"),
        F.lit("', 'trainStopping': "), word,
        F.lit(", 'differenceInMinutes': "), F.coalesce(F.col("diff").cast("string"), F.lit("None")),
        F.lit("}"),
    )
    lists = timetable.renest_stops(
        stops.select("train_id", "idx", text.alias("text")), ["train_id"], ["text"], rows="l"
    )
    as_text = F.concat(F.lit("["), F.array_join(F.col("l.text"), ", "), F.lit("]"))
    legacy = lists.select("train_id", as_text.alias(timetable.ROWS))
    decoded = timetable.decode_timetable(legacy, STOP).where("not decode_error")
    return timetable.explode_stops(decoded.drop("decode_error")).select(
        "train_id",
        "idx",
        F.col("stationShortCode").alias("station_code"),
        F.col("trainStopping").alias("train_stopping"),
        F.col("stationName").alias("station_name"),
        F.col("differenceInMinutes").alias("diff"),
    )


# --- weather rows and rolling features -----------------------------------------

PIVOT_SQL = ", ".join(f"max(CASE WHEN param = '{t}' THEN val END) AS p_{t}" for t in EVENT_TYPES)


def _pivoted(spark, d):
    wide = weather.pivot_readings(
        dt.v_obs(spark, d), ["station", "us"], EVENT_TYPES, "param", "val"
    )
    return wide.withColumnsRenamed({t: f"p_{t}" for t in EVENT_TYPES})


@query("obs_pivot", f"SELECT station, us, {PIVOT_SQL} FROM v_obs GROUP BY station, us")
def obs_pivot(spark, d):
    return _pivoted(spark, d)


def _documents(spark, d):
    leaf = F.create_map("param", F.struct(F.col("val").alias("value")))
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    body = F.create_map(at, F.create_map(F.col("station").cast("string"), leaf))
    return dt.v_obs(spark, d).select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


@query(
    "obs_documents",
    "SELECT CAST(station AS VARCHAR) AS station_name, us, "
    + ", ".join(f"CASE WHEN param = '{t}' THEN val END AS p_{t}" for t in EVENT_TYPES)
    + " FROM v_obs",
)
def obs_documents(spark, d):
    """One nested document per reading, flattened to wide rows."""
    wide = weather.flatten_documents(_documents(spark, d), EVENT_TYPES)
    return wide.select(
        "station_name",
        times.micros(F.col("timestamp")).alias("us"),
        *[F.col(t).alias(f"p_{t}") for t in EVENT_TYPES],
    )


@query(
    "rolling_stats",
    f"SELECT station, us, {', '.join(rolling_sql('val'))} FROM v_obs",
)
def rolling_stats(spark, d):
    obs = dt.v_obs(spark, d).select("station", "us", "val")
    return rolling_features(obs, ["val"], HOURS, station="station").drop("val")


@query(
    "rolling_dense",
    f"""SELECT event_id, station, us, {', '.join(rolling_sql('val'))}
        FROM (SELECT event_id, station % 3 AS station, us, val FROM v_obs)""",
)
def rolling_dense(spark, d):
    """Three busy stations: hundreds of rows in every window."""
    obs = dt.v_obs(spark, d).select("event_id", (F.col("station") % 3).alias("station"), "us", "val")
    return rolling_features(obs, ["val"], HOURS, station="station").drop("val")


@query(
    "rolling_uneven",
    f"""SELECT event_id, station, us, {', '.join(rolling_sql('val', (12, 30)))}
        FROM (SELECT event_id, station % 3 AS station, us, val FROM v_obs)""",
)
def rolling_uneven(spark, d):
    """Windows of which neither divides the other."""
    obs = dt.v_obs(spark, d).select("event_id", (F.col("station") % 3).alias("station"), "us", "val")
    return rolling_features(obs, ["val"], (12, 30), station="station").drop("val")


#: Every fifth reading is a multiple of 2**47, beyond what decimals of six digits hold.
LARGE = "CASE WHEN event_id % 5 = 0 THEN floor(val) * 140737488355328 ELSE val END"
LARGE_PARTS = (
    "CASE WHEN abs(val) < 68719476736 THEN round_even(val * 65536, 0) / 65536 ELSE 0 END",
    "CASE WHEN abs(val) < 68719476736 THEN val - round_even(val * 65536, 0) / 65536 ELSE val END",
)


def _large_sql(hours) -> str:
    out = []
    for h in hours:
        frame = f"OVER (PARTITION BY station ORDER BY us RANGE BETWEEN {h * HOUR_US - 1} PRECEDING AND CURRENT ROW)"
        s = f"(sum({LARGE_PARTS[0]}) {frame} + sum({LARGE_PARTS[1]}) {frame})"
        total = f"(CASE WHEN abs({s}) < 8589934592 THEN round_even({s} * 1e6, 0) / 1e6 ELSE {s} END)"
        out.append(f'{r2(f"{total} / count(val) {frame}")} AS "val ({h}h mean)"')
        out.append(f'{r2(total)} AS "val ({h}h cumulative)"')
    return ", ".join(out)


@query(
    "rolling_large",
    f"""SELECT event_id, station, us, {_large_sql((12, 30, 72))}
        FROM (SELECT event_id, station % 3 AS station, us, CAST({LARGE} AS DOUBLE) AS val FROM v_obs)""",
)
def rolling_large(spark, d):
    """Very large readings among usual ones; three windows, one shuffle."""
    obs = dt.v_obs(spark, d).select(
        "event_id", (F.col("station") % 3).alias("station"), "us", F.expr(LARGE).cast("double").alias("val")
    )
    return rolling_features(obs, ["val"], (12, 30, 72), without_extremes=["val"], station="station").drop("val")


WIDE_PARAMS = [f"p_{t}" for t in EVENT_TYPES]


def _all_sql() -> str:
    cols = [c for p in WIDE_PARAMS for c in rolling_sql(p, extremes=p != "p_purchase")]
    return f"SELECT station, us, {', '.join(WIDE_PARAMS + cols)} FROM v_obs_wide"


@query("rolling_all_params", _all_sql())
def rolling_all_params(spark, d):
    """All parameters and windows; one parameter without extremes, one missing."""
    return rolling_features(
        dt.v_obs_wide(spark, d),
        [*WIDE_PARAMS, "p_absent"],
        HOURS,
        without_extremes=["p_purchase"],
        station="station",
    )


@query(
    "rolling_month_seam",
    f"""SELECT * FROM (SELECT station, us, {', '.join(rolling_sql('val'))} FROM v_obs)
        WHERE us >= epoch_us(TIMESTAMP '2024-01-16 00:00:00')""",
)
def rolling_month_seam(spark, d):
    """The second part of the month from its own rows and 72 hours before it."""
    cut = F.lit("2024-01-16").cast("timestamp")
    obs = dt.v_obs(spark, d)
    early = F.col("ts").cast("timestamp") > cut - F.expr("interval 72 hours")
    part = obs.where(early).select("station", "us", "val")
    rolled = rolling_features(part, ["val"], HOURS, station="station")
    return rolled.where(F.col("us") >= times.micros(cut)).drop("val")


_LATER = 20 * DAY_US


@query(
    "rolling_month",
    f"""SELECT * FROM (SELECT station, us, {', '.join(rolling_sql('val'))}
                       FROM (SELECT station, us + {_LATER} AS us, val FROM v_obs))
        WHERE us >= epoch_us(TIMESTAMP '2024-02-01 00:00:00')""",
)
def rolling_month(spark, d):
    """February of observations moved by 20 days, read with what its windows need of January."""
    obs = dt.v_obs(spark, d).select(
        "station", (F.col("us") + _LATER).alias("us"), F.timestamp_micros(F.col("us") + _LATER).alias("timestamp"), "val"
    )
    rolled = rolling_features(rolling_for_month(obs, "2024-02"), ["val"], HOURS, station="station")
    return rolled.where("in_month").drop("val", "timestamp", "in_month")


@query("rolling_once", f"SELECT station, us, {', '.join(rolling_sql('val'))} FROM v_obs")
def rolling_once(spark, d):
    """A table that has its features already, such as a stored one, is left as it is."""
    obs = dt.v_obs(spark, d).select("station", "us", "val")
    stored = stage(rolling_features(obs, ["val"], HOURS, station="station"), "features")
    return rolling_features(stored, ["val"], HOURS, station="station").drop("val")


@query(
    "unlisted_parameters",
    """SELECT param AS parameter, count(*) AS rows, count(val) AS readings, count(DISTINCT station) AS stations,
              epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us
       FROM v_obs WHERE param NOT IN ('view', 'click') GROUP BY param""",
)
def unlisted_parameters(spark, d):
    """What nested documents hold besides the parameters asked for."""
    found = weather.unlisted_parameters(_documents(spark, d), ["view", "click"])
    return found.select(
        "parameter", "rows", "readings", "stations",
        F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"),
    )


@query(
    "document_readings",
    "SELECT CAST(station AS VARCHAR) AS station_name, us, param AS parameter, val AS value FROM v_obs",
)
def document_readings(spark, d):
    """Every reading of nested documents as a row, without naming parameters."""
    rows = weather.document_readings(_documents(spark, d))
    return rows.select("station_name", times.micros(F.col("timestamp")).alias("us"), "parameter", "value")


@query(
    "station_metadata",
    "SELECT name AS station_name, lat AS latitude, lon AS longitude FROM v_ems WHERE ems % 7 = 1",
)
def station_metadata(spark, d):
    """Stations of the first document that lists any; an earlier one is empty."""
    place = F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    listed = dt.v_ems(spark, d).groupBy((F.col("ems") % 7).alias("ord")).agg(
        F.map_from_entries(F.collect_list(F.struct("name", place))).alias("stations")
    )
    body = F.when(F.col("ord") == 0, F.lit("{}")).otherwise(F.to_json("stations"))
    return weather.station_metadata(listed.select("ord", body.alias("value")))


@query(
    "trailing_slice",
    "SELECT event_id, station, us FROM v_obs WHERE ts > (SELECT max(ts) FROM v_obs) - INTERVAL 72 HOURS",
)
def trailing_latest(spark, d):
    return trailing_slice(dt.v_obs(spark, d), "ts").select("event_id", "station", "us")


@query(
    "feature_profile",
    " UNION ALL ".join(
        f"SELECT '{p}' AS feature, count({p}) AS valid, count(*) - count({p}) AS missing, "
        f"count(*) FILTER (WHERE {p} = 0) AS zeros FROM v_obs_wide"
        for p in WIDE_PARAMS
    ),
)
def feature_profile(spark, d):
    return quality.feature_profile(dt.v_obs_wide(spark, d), WIDE_PARAMS)


@query("obs_dedup", "SELECT station, us, event_id, param, val FROM v_obs")
def obs_dedup(spark, d):
    """Readings at chunk edges arrive twice; the later copy is dropped."""
    obs = dt.v_obs(spark, d).select("station", "us", "event_id", "param", "val")
    again = obs.where(F.col("event_id") % 5 == 0).withColumn("val", F.lit(-1.0))
    both = obs.withColumn("copy", F.lit(0)).unionByName(again.withColumn("copy", F.lit(1)))
    return months.dedup_observations(both, ["station", "us"], ["copy"]).drop("copy")


@query(
    "union_months",
    """SELECT station, us, val, CASE WHEN day(ts) <= 15 THEN param END AS param,
              CASE WHEN day(ts) > 15 THEN event_id END AS event_id FROM v_obs""",
)
def union_months(spark, d):
    """Two part-months, each with a column the other one lacks."""
    obs = dt.v_obs(spark, d)
    first = obs.where("day(ts) <= 15").select("station", "us", "val", "param")
    second = obs.where("day(ts) > 15").select("station", "us", "val", "event_id")
    return months.union_months(first, second)


@query(
    "missing_keys",
    "SELECT DISTINCT param FROM v_obs EXCEPT SELECT DISTINCT param FROM v_obs WHERE val > 350",
)
def missing_keys(spark, d):
    """Parameters of the table that have no reading above 350."""
    obs = dt.v_obs(spark, d)
    return months.missing_keys(obs, obs.where("val > 350"), "param")


@query(
    "bbox_time_filter",
    """SELECT event_id, station, us, lat, lon FROM v_obs JOIN v_geo USING (station)
       WHERE lat BETWEEN 60 AND 65 AND lon BETWEEN 20 AND 25
         AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-14 23:59:59'""",
)
def bbox_time_filter(spark, d):
    obs = dt.v_obs(spark, d)
    lat, lon = dt.place(F.col("station"), 37, 91)
    at = obs.select("*", lat.alias("lat"), lon.alias("lon"))
    ntz = lambda text: F.to_timestamp_ntz(F.lit(text))
    kept = weather.in_box_and_time(
        at, (20, 60, 25, 65), ntz("2024-01-05 00:00:00"), ntz("2024-01-14 23:59:59"), "ts", "lat", "lon"
    )
    return kept.select("event_id", "station", "us", "lat", "lon")


@query(
    "bbox_clustered_read",
    """SELECT event_id, station, us, lat, lon FROM v_obs JOIN v_geo USING (station)
       WHERE lat BETWEEN 61 AND 62 AND lon BETWEEN 22 AND 24
         AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-24 23:59:59'""",
)
def bbox_clustered_read(spark, d):
    """The table is written along a space-filling order; the filter reads its own boxes of it."""
    lat, lon = dt.place(F.col("station"), 37, 91)
    path = scratch_path(spark, "observations-clustered")
    tables.write_clustered(dt.v_obs(spark, d).select("*", lat.alias("lat"), lon.alias("lon")), path, ["ts", "lat", "lon"])
    ntz = lambda text: F.to_timestamp_ntz(F.lit(text))
    kept = weather.in_box_and_time(
        spark.read.parquet(path), (22, 61, 24, 62), ntz("2024-01-05 00:00:00"), ntz("2024-01-24 23:59:59"), "ts", "lat", "lon"
    )
    return kept.select("event_id", "station", "us", "lat", "lon")


# --- stations ---------------------------------------------------------------------


@query(
    "station_dim",
    """SELECT code AS train_station_short_code, name AS train_station_name,
              lat AS train_lat, lon AS train_long FROM v_train_station""",
)
def station_dim(spark, d):
    raw = dt.v_train_station(spark, d).select(
        F.col("code").alias("stationShortCode"),
        F.col("name").alias("stationName"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.lit("STATION").alias("type"),
        F.lit("FI").alias("countryCode"),
    )
    return stations.station_dimension(raw)


_DISTANCE = haversine_sql("t.lat", "t.lon", "e.lat", "e.lon")
_RANKED = f"""
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY round_even(d * 1e9, 0), ems) AS rk
    FROM (SELECT t.code, e.ems, e.lat AS elat, e.lon AS elon, {_DISTANCE} AS d
          FROM v_train_station t CROSS JOIN v_ems e)"""


@query(
    "haversine_km",
    f"""SELECT t.code, round_even({haversine_sql('t.lat', 't.lon', '60.1719', '24.9414')} * 1e6, 0) / 1e6
        AS distance_km FROM v_train_station t""",
)
def haversine(spark, d):
    """Distance of each train station from one point."""
    t = dt.v_train_station(spark, d)
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(60.1719), F.lit(24.9414))
    return t.select("code", (F.rint(km * 1e6) / 1e6).alias("distance_km"))


@query(
    "nearest_station",
    f"""SELECT CAST(code AS VARCHAR) AS code, ems AS closest_ems_station, elat AS ems_latitude,
               elon AS ems_longitude, round_even(d * 1e6, 0) / 1e6 AS distance_km
        FROM ({_RANKED}) WHERE rk = 1""",
)
def nearest(spark, d):
    found = nearest_station(dt.train_stations(spark, d), dt.ems_stations(spark, d))
    return found.select(
        F.col("train_station_short_code").alias("code"),
        "closest_ems_station",
        "ems_latitude",
        "ems_longitude",
        (F.rint(F.col("distance_km") * 1e6) / 1e6).alias("distance_km"),
    )


@query(
    "top5_stations",
    f"""SELECT CAST(code AS VARCHAR) AS code, CAST(rk AS INT) AS rank, ems AS ems_station,
               elat AS ems_lat, elon AS ems_long, {r2('d')} AS distance_km
        FROM ({_RANKED}) WHERE rk <= 5""",
)
def top5(spark, d):
    found = top_stations(dt.train_stations(spark, d), dt.ems_stations(spark, d), 5)
    return found.select(
        F.col("train_station_short_code").alias("code"),
        "rank",
        "ems_station",
        "ems_lat",
        "ems_long",
        "distance_km",
    )


def _wide_sql() -> str:
    cols = []
    for r in range(1, 6):
        pick = lambda c: f"max(CASE WHEN rk = {r} THEN {c} END)"
        cols += [
            f"{pick('ems')} AS ems_{r}_station",
            f"{pick('elat')} AS ems_{r}_lat",
            f"{pick('elon')} AS ems_{r}_long",
            f"{r2(pick('d'))} AS ems_{r}_distance_km",
        ]
    return f"SELECT CAST(code AS VARCHAR) AS code, {', '.join(cols)} FROM ({_RANKED}) GROUP BY code"


@query("top5_wide", _wide_sql())
def top5_wide(spark, d):
    wide = top_stations_wide(dt.train_stations(spark, d), dt.ems_stations(spark, d), 5)
    return wide.withColumnRenamed("train_station_short_code", "code").drop(
        "train_station_name", "train_lat", "train_long", "ord"
    )


@query(
    "translate_dim",
    """SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) || ' (en)'
              ELSE n_name || ' [untranslated]' END AS n_name_en
       FROM nation""",
)
def translate_dim(spark, d):
    """The dictionary knows every other name."""
    names = table(spark, d, "nation").select("n_nationkey", "n_name")
    words = names.where("n_nationkey % 2 = 0").select(
        F.col("n_name").alias("source"), F.concat(F.lower("n_name"), F.lit(" (en)")).alias("target")
    )
    return stations.translate(names, "n_name", words)


@query(
    "first_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) rn FROM events)
       WHERE rn = 1""",
)
def first_per_key(spark, d):
    events = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return first_row(events, ["user_id"], ["ts", "event_id"]).drop("ts")


# --- time-nearest matching -----------------------------------------------------------


@query(
    "asof_nearest",
    """SELECT event_id, station, us, matched_us, click_id FROM (
         SELECT l.event_id, l.user_id AS station, epoch_us(l.ts) AS us, epoch_us(r.ts) AS matched_us,
                r.event_id AS click_id,
                row_number() OVER (PARTITION BY l.event_id
                    ORDER BY abs(epoch_us(r.ts) - epoch_us(l.ts)), r.ts) rn
         FROM events l LEFT JOIN events r ON r.user_id = l.user_id AND r.event_type = 'click'
         WHERE l.event_type = 'error') WHERE rn = 1""",
)
def asof(spark, d):
    obs = dt.v_obs(spark, d)
    errors = obs.where("param = 'error'").select("event_id", "station", "us")
    clicks = obs.where("param = 'click'").select("station", "us", F.col("event_id").alias("click_id"))
    return asof_nearest(errors, clicks, ["station"], "us", take=["click_id"])


@query(
    "asof_blocks",
    """WITH clicks AS (SELECT user_id, ts, max(event_id) AS click_id FROM events
                       WHERE event_type = 'click' GROUP BY user_id, ts)
       SELECT event_id, station, us, matched_us, click_id FROM (
         SELECT l.event_id, l.user_id AS station, epoch_us(l.ts) AS us, epoch_us(r.ts) AS matched_us, r.click_id,
                row_number() OVER (PARTITION BY l.event_id
                    ORDER BY abs(epoch_us(r.ts) - epoch_us(l.ts)), r.ts) rn
         FROM events l LEFT JOIN clicks r ON r.user_id = l.user_id
         WHERE l.event_type = 'error') WHERE rn = 1""",
)
def asof_blocks(spark, d):
    """Clicks stored by station and day, met where they lie."""
    obs = dt.v_obs(spark, d)
    errors = obs.where("param = 'error'").select("event_id", "station", "us")
    clicks = obs.where("param = 'click'").groupBy("station", "us").agg(F.max("event_id").alias("click_id"))
    stored = write_blocks(stage(clicks, "clicks"), scratch_path(spark, "click-blocks"), ["station"], "us")
    return asof_nearest(errors, stored, ["station"], "us", take=["click_id"])


FALLBACK = ("p_view", "p_click")


def _fallback_sql(values: list[str], features: dict[str, list[str]]) -> str:
    out = []
    for v in values:
        owner = next((f for f, cols in features.items() if v == f or v in cols), None)
        here = f'max(CASE WHEN rk = 1 THEN "{v}" END)'
        if owner is None:
            out.append(f'{here} AS "{v}"')
            continue
        other = f'arg_min(struct_pack(v := "{v}"), rk) FILTER (WHERE rk > 1 AND "{owner}" IS NOT NULL)'
        mine = f'max(CASE WHEN rk = 1 THEN "{owner}" END)'
        out.append(f'CASE WHEN {mine} IS NULL THEN coalesce(({other}).v, {here}) ELSE {here} END AS "{v}"')
    return ", ".join(out)


_GEO_RANKED = f"""
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY round_even(d * 1e9, 0), ems) AS rk
    FROM (SELECT t.station AS code, e.station AS ems, {_DISTANCE} AS d
          FROM v_geo t CROSS JOIN v_geo e) QUALIFY rk <= 5"""
_FALLBACK_FROM = f"""
    FROM (SELECT q.stop_id, q.station AS code, q.us AS req_us, g.rk, o.*,
                 row_number() OVER (PARTITION BY q.stop_id, g.rk ORDER BY abs(o.us - q.us), o.us) rn
          FROM v_req q JOIN ({_GEO_RANKED}) g ON g.code = q.station
               JOIN obs o ON o.station = g.ems)
    WHERE rn = 1 GROUP BY stop_id HAVING count(*) FILTER (WHERE rk = 1) = 1"""


@query(
    "asof_fallback",
    f"""WITH obs AS (SELECT * FROM v_obs_wide)
        SELECT stop_id, any_value(code) AS code, any_value(req_us) AS us,
               max(CASE WHEN rk = 1 THEN us END) AS observed_us,
               {_fallback_sql(list(WIDE_PARAMS), {f: [] for f in FALLBACK})} {_FALLBACK_FROM}""",
)
def asof_fallback(spark, d):
    geo = dt.geo_stations(spark, d)
    codes = geo.select(
        F.col("station_name").alias("code"),
        F.col("latitude").alias("train_lat"),
        F.col("longitude").alias("train_long"),
        "ord",
    )
    asked = dt.v_req(spark, d).withColumnRenamed("station", "code")
    answers = asof_with_fallback(
        asked.select("code", "us").distinct(),
        stage(candidate_lists(codes, geo, 5, code="code"), "station-candidates"),
        dt.v_obs_wide(spark, d),
        WIDE_PARAMS,
        {f: [] for f in FALLBACK},
    )
    return asked.join(answers.drop("closest_station"), ["code", "us"])


# --- the whole merge ----------------------------------------------------------------

MERGE = Settings(filter_by_category=False)
_INSTANT = list(PARAMETERS.values())
_ROLLED = [p for p in MERGE.rolling_params if p in _INSTANT]
_VALUES = [*_INSTANT, *[c for p in _ROLLED for c in rolling_columns(p, HOURS, MERGE.rolling_without_extremes)]]
_GROUPS = {
    f: rolling_columns(f, HOURS, MERGE.rolling_without_extremes) if f in _ROLLED else []
    for f in MERGE.fallback_features
    if f in _INSTANT
}
_ROLLED_SQL = ", ".join(
    c
    for p in _ROLLED
    for c in rolling_sql(p, extremes=p not in MERGE.rolling_without_extremes, partition="station_name")
)
_PLACE_RANKED = f"""
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY round_even(d * 1e9, 0), ord) AS rk
    FROM (SELECT t.code, e.station_name AS ems, e.ord, {_DISTANCE} AS d
          FROM v_train_station t CROSS JOIN v_place e) QUALIFY rk <= 5"""
_MERGE_CTES = f"""
    obs AS (SELECT *, {_ROLLED_SQL} FROM v_weather),
    cand AS ({_PLACE_RANKED}),
    offs AS ({OFFSETS_SQL}),
    req AS (SELECT DISTINCT part_code AS code, call_us FROM v_call WHERE line_number <> 7),
    pairs AS (SELECT r.code, r.call_us, c.rk, c.ems FROM req r JOIN cand c USING (code)),
    back AS (SELECT p.*, o.us AS b FROM pairs p ASOF LEFT JOIN obs o
             ON o.station_name = p.ems AND o.us <= p.call_us),
    ahead AS (SELECT p.*, o.us AS a FROM back p ASOF LEFT JOIN obs o
              ON o.station_name = p.ems AND o.us >= p.call_us),
    hit AS (SELECT code, call_us, rk, ems, CASE WHEN a IS NOT NULL AND (b IS NULL OR a - call_us < call_us - b)
                   THEN a ELSE b END AS matched FROM ahead),
    got AS (SELECT h.code, h.call_us, h.rk, h.ems, o.* FROM hit h
            JOIN obs o ON o.station_name = h.ems AND o.us = h.matched),
    answer AS (SELECT code, call_us, max(CASE WHEN rk = 1 THEN ems END) AS found_ems,
                      max(CASE WHEN rk = 1 THEN us END) AS observed_us, {_fallback_sql(_VALUES, _GROUPS)}
               FROM got GROUP BY code, call_us HAVING count(*) FILTER (WHERE rk = 1) = 1)"""


def _short(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


_MERGE_SQL = f"""WITH {_MERGE_CTES}
    SELECT v.train_id, v.idx, CAST(v.part_code AS VARCHAR) AS station_code, o.diff, o.diff_offset, o.diff_each,
           CASE WHEN v.part_code NOT IN (SELECT code FROM v_train_station) THEN 'no_station'
                WHEN v.line_number = 7 THEN 'bad_time'
                WHEN a.found_ems IS NULL THEN 'no_data' ELSE 'ok' END AS weather_status,
           a.found_ems AS closest_ems, a.observed_us,
           {', '.join(f'a."{v}" AS {_short(v)}' for v in _VALUES)}
    FROM v_call v JOIN offs o USING (train_id, idx)
         LEFT JOIN answer a ON a.code = v.part_code AND a.call_us = v.call_us AND v.line_number <> 7"""


def merged(spark: SparkSession, d: str) -> DataFrame:
    return merge_tables(
        stage(dt.trains(spark, d, shift_to_2024=True), "trains"),
        dt.weather(spark, d),
        dt.train_stations(spark, d),
        dt.places(spark, d),
        MERGE,
        train_columns=("trainNumber", "departureDate", "version"),
    )


def _stop_columns(stops: DataFrame) -> DataFrame:
    return stops.select(
        F.col("version").alias("train_id"),
        "idx",
        F.col("stationShortCode").alias("station_code"),
        F.col(DELAY).alias("diff"),
        F.col(DELAY_FROM_ORIGIN).alias("diff_offset"),
        F.col(DELAY_FROM_PREVIOUS).alias("diff_each"),
        "weather_status",
        "closest_ems",
        "observed_us",
        *[F.col(f"`{v}`").alias(_short(v)) for v in _VALUES],
    )


@query("stop_weather", _MERGE_SQL)
def stop_weather(spark, d):
    """Every stop with its delay offsets and the weather around it."""
    return _stop_columns(merged(spark, d))


@query("stop_weather_blocks", _MERGE_SQL)
def stop_weather_blocks(spark, d):
    """The same with the weather stored by station and day and read back by its path."""
    path = scratch_path(prepare(spark), "weather-blocks")
    weather_blocks(stage(weather_features(dt.weather(spark, d), MERGE), "weather-features"), path, MERGE)
    candidates = station_candidates(dt.train_stations(spark, d), dt.places(spark, d), MERGE)
    return _stop_columns(
        merge_stops(
            stage(dt.trains(spark, d, shift_to_2024=True), "trains"),
            read_blocks(spark, path),
            stage(candidates, "station-candidates"),
            MERGE,
            train_columns=("trainNumber", "departureDate", "version"),
        )
    )


@query("job_stops", _MERGE_SQL)
def job_stops(spark, d):
    """The stops that the writing job publishes for a month."""
    out = scratch_path(prepare(spark), "job")
    trains = stage(dt.trains(spark, d, shift_to_2024=True), "trains")
    sides = dt.weather(spark, d), dt.train_stations(spark, d), dt.places(spark, d)
    run_month(trains, *sides, out, "2024-01", MERGE, train_columns=("trainNumber", "departureDate", "version"))
    return _stop_columns(read_release(spark, out, "stops"))


@query(
    "stop_weather_nested",
    f"""SELECT train_id, count(*) AS stops, count(*) FILTER (WHERE weather_status = 'ok') AS observed,
               string_agg(coalesce(closest_ems, '-'), ' ' ORDER BY idx) AS places
        FROM ({_MERGE_SQL}) GROUP BY train_id""",
)
def stop_weather_nested(spark, d):
    """The merged stops put back into their trains."""
    keys = ["trainNumber", "departureDate", "version"]
    # written first: the shuffles that made the stops go before they move to their trains
    nested = nest_merged(stage(merged(spark, d), "merged-stops"), keys, _VALUES)
    found = F.transform(timetable.ROWS, lambda s: s["weather_observations"]["closest_ems"])
    return nested.select(
        F.col("version").alias("train_id"),
        F.size(timetable.ROWS).cast("long").alias("stops"),
        F.size(F.filter(found, lambda c: c.isNotNull())).cast("long").alias("observed"),
        F.array_join(found, " ", "-").alias("places"),
    )


# --- checks ------------------------------------------------------------------------


@query(
    "distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM v_stop"
        for c in ("train_number", "station_code", "departure_date", "train_category")
    ),
)
def distinct_counts(spark, d):
    return quality.distinct_counts(
        dt.v_stop(spark, d), ["train_number", "station_code", "departure_date", "train_category"]
    )


def _month_of(spark, d, name, column):
    return table(spark, d, name).select(F.date_format(column, "yyyy-MM").alias("month"))


@query(
    "coverage_check",
    """SELECT *, left_first = right_first AND left_last = right_last AS "equal" FROM (
         SELECT (SELECT strftime(min(o_orderdate), '%Y-%m') FROM orders) AS left_first,
                (SELECT strftime(max(o_orderdate), '%Y-%m') FROM orders) AS left_last,
                (SELECT strftime(min(l_shipdate), '%Y-%m') FROM lineitem) AS right_first,
                (SELECT strftime(max(l_shipdate), '%Y-%m') FROM lineitem) AS right_last)""",
)
def coverage_check(spark, d):
    return quality.month_coverage(
        _month_of(spark, d, "orders", "o_orderdate"), _month_of(spark, d, "lineitem", "l_shipdate")
    )


@query(
    "common_months",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month FROM orders
       INTERSECT SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem""",
)
def common_months(spark, d):
    return months.common_months(
        _month_of(spark, d, "orders", "o_orderdate"), _month_of(spark, d, "lineitem", "l_shipdate")
    )


# --- times -------------------------------------------------------------------------


@query(
    "parse_times",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 OR event_id % 11 = 0 THEN NULL ELSE epoch_us(ts) END AS strict_us,
              CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 10 = 0 THEN epoch_us(date_trunc('second', ts))
                   ELSE epoch_us(ts) END AS lenient_us
       FROM events""",
)
def parse_times(spark, d):
    """Stop-time text, every 10th without its fraction and every 11th broken."""
    i = F.col("event_id")
    text = (
        F.when(i % 11 == 0, F.lit("2024-13-77 soon"))
        .when(i % 10 == 0, F.date_format("ts", times.ISO_SECOND_FORMAT))
        .otherwise(F.date_format("ts", times.STOP_TIME_FORMAT))
    )
    return table(spark, d, "events").select(
        "event_id",
        times.micros(times.parse_stop_time(text)).alias("strict_us"),
        times.micros(times.parse_lenient(text)).alias("lenient_us"),
    )


@query(
    "date_parts",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
              CAST(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE day(o_orderdate) END AS INT) AS day_of_month,
              CAST(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE isodow(o_orderdate) END AS INT) AS day_of_week,
              CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y_%m') END AS month_label
       FROM orders""",
)
def date_parts(spark, d):
    """Date text, every 9th in a form that does not parse."""
    broken = F.col("o_orderkey") % 9 == 0
    text = F.when(broken, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(
        F.date_format("o_orderdate", times.DATE_FORMAT)
    )
    day = times.parse_date(text)
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.dayofmonth(day).alias("day_of_month"),
        times.iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "yyyy_MM").alias("month_label"),
    )


@query(
    "month_from_name",
    """SELECT o_orderkey, 'all_trains_data_' || strftime(o_orderdate, '%Y_%m') || '.csv' AS name,
              strftime(o_orderdate, '%Y-%m') AS month FROM orders""",
)
def month_from_name(spark, d):
    name = times.monthly_name("all_trains_data.csv", F.col("o_orderdate"))
    return table(spark, d, "orders").select(
        "o_orderkey", name.alias("name"), times.month_from_name(name).alias("month")
    )


@query(
    "calendar_spine",
    """SELECT day, strftime(s, '%Y-%m-%dT%H:%M:%SZ') AS chunk_start,
              strftime(least(s + INTERVAL 1 HOUR, day + INTERVAL 86399 SECOND), '%Y-%m-%dT%H:%M:%SZ') AS chunk_end
       FROM (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
             FROM events),
            LATERAL (SELECT day + INTERVAL (h) HOUR AS s FROM range(24) t(h))""",
)
def calendar_spine(spark, d):
    """Hourly chunks of every day the events span; the last one ends early."""
    span = table(spark, d, "events").agg(
        F.min(F.col("ts").cast("date")).alias("a"), F.max(F.col("ts").cast("date")).alias("b")
    )
    days = span.select(F.explode(times.days_between(F.col("a"), F.col("b"))).alias("day"))
    start = F.col("day").cast("timestamp")
    end = start + F.expr("interval '23:59:59' hour to second")
    return days.select("day", F.inline(times.chunks(start, end))).select(
        "day",
        F.date_format("chunk_start", times.ISO_SECOND_FORMAT).alias("chunk_start"),
        F.date_format("chunk_end", times.ISO_SECOND_FORMAT).alias("chunk_end"),
    )


# --- order and first rows -------------------------------------------------------------


@query(
    "preview",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10""",
)
def preview(spark, d):
    return tables.preview(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )


@query("sort_keys", "SELECT us, station, event_id FROM v_obs ORDER BY us, station")
def sort_keys(spark, d):
    return dt.v_obs(spark, d).select("us", "station", "event_id").orderBy("us", "station")


# --- files ---------------------------------------------------------------------------


@query(
    "train_scan",
    """SELECT train_id, train_number, strftime(departure_date, '%Y-%m-%d') AS departure_date,
              count(*) AS stops, string_agg(CAST(station_code AS VARCHAR), ' ' ORDER BY idx) AS codes
       FROM v_stop GROUP BY train_id, train_number, departure_date""",
)
def train_scan(spark, d):
    """Trains landed as JSON by month, then read for a closed range of days."""
    path = scratch_path(prepare(spark), "trains")
    landed = dt.trains(spark, d)
    day = times.parse_date(F.col("departureDate"))
    tables.write_monthly(
        landed.withColumn("day", day), path, "day", fmt="json"
    )
    first, last = stage(landed.select("departureDate"), "days").agg(F.min("departureDate"), F.max("departureDate")).first()
    back = landing.read_trains(spark, path, first or "1970-01-01", last or "1970-01-01", schema=TRAIN)
    codes = F.col(f"{timetable.ROWS}.stationShortCode")
    return back.select(
        F.col("version").alias("train_id"),
        F.col("trainNumber").alias("train_number"),
        F.col("departureDate").alias("departure_date"),
        F.size(timetable.ROWS).cast("long").alias("stops"),
        F.array_join(codes, " ").alias("codes"),
    )


@query(
    "dim_scan",
    """SELECT 'stations' AS dimension, CAST(code AS VARCHAR) AS code, name FROM v_train_station
       UNION ALL SELECT 'weather_stations', NULL, name FROM v_ems
       UNION ALL SELECT 'train_categories', CAST(o_custkey AS VARCHAR), o_orderpriority FROM orders GROUP BY ALL
       UNION ALL SELECT 'causes', CAST(r_regionkey AS VARCHAR), r_name FROM region
       UNION ALL SELECT 'detailed_causes', CAST(n_nationkey AS VARCHAR), n_name FROM nation
       UNION ALL SELECT 'third_causes', CAST(p_partkey AS VARCHAR), p_name FROM part""",
)
def dim_scan(spark, d):
    """The six code and station tables, landed as JSON and read with schemas."""
    place = dt.v_train_station(spark, d)
    source = {
        "stations": (place.select(F.col("code").cast("string").alias("stationShortCode"), F.col("name").alias("stationName"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude")), "stationShortCode", "stationName"),
        "weather_stations": (dt.v_ems(spark, d).select(F.col("name").alias("station_name"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude")), None, "station_name"),
        "train_categories": (table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name")).distinct(), "id", "name"),
        "causes": (_codes(spark, d, "region", "r_regionkey", "r_name", "category"), "categoryCode", "categoryName"),
        "detailed_causes": (_codes(spark, d, "nation", "n_nationkey", "n_name", "detailedCategory"), "detailedCategoryCode", "detailedCategoryName"),
        "third_causes": (_codes(spark, d, "part", "p_partkey", "p_name", "thirdCategory"), "thirdCategoryCode", "thirdCategoryName"),
    }
    parts = []
    for name, (rows, code, label) in source.items():
        path = scratch_path(spark, name)
        rows.write.json(path)
        back = landing.read_dimension(spark, name, path, one_document=False)
        key = F.col(code).cast("string") if code else F.lit(None).cast("string")
        parts.append(back.select(F.lit(name).alias("dimension"), key.alias("code"), F.col(label).alias("name")))
    return months.union_months(*parts)


def _codes(spark, d, name, key, label, prefix):
    return table(spark, d, name).select(
        F.col(key).cast("string").alias(f"{prefix}Code"), F.col(label).alias(f"{prefix}Name")
    )


@query(
    "csv_roundtrip",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day,
              CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 'NA, "' || o_orderpriority || '"'
                   ELSE o_orderpriority END AS priority
       FROM orders""",
)
def csv_roundtrip(spark, d):
    """Quotes, commas, the word NA and empty fields survive a CSV file."""
    orders = table(spark, d, "orders")
    k, p = F.col("o_orderkey") % 3, F.col("o_orderpriority")
    text = F.when(k == 1, F.concat(F.lit('NA, "'), p, F.lit('"'))).when(k == 2, p)
    rows = orders.select(
        "o_orderkey",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        text.alias("priority"),
    )
    path = scratch_path(spark, "orders-csv")
    tables.write_table(rows, path, "csv")
    return landing.read_csv(spark, path, rows.schema)


@query(
    "partitioned_write",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
              CASE WHEN year(o_orderdate) >= 1999 THEN 'second' ELSE 'first' END AS run
       FROM orders""",
)
def partitioned_write(spark, d):
    """Months written twice; the second run replaces only its own months."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    path = scratch_path(spark, "orders-monthly")
    tables.write_monthly(orders.withColumn("run", F.lit("first")), path, "o_orderdate")
    later = orders.where("year(o_orderdate) >= 1999").withColumn("run", F.lit("second"))
    tables.write_monthly(later, path, "o_orderdate", sort=["o_orderkey"])
    return spark.read.parquet(path).select("o_orderkey", "year", "month", "run")


@query(
    "monthly_files",
    """SELECT strftime(o_orderdate, '%Y-%m') AS source_month, count(*) AS orders,
              CAST(sum(o_orderkey) AS BIGINT) AS key_sum
       FROM orders GROUP BY 1""",
)
def monthly_files(spark, d):
    """Monthly CSV files found by name; the month is taken from the name."""
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "orders-files")
    named = orders.select(
        "o_orderkey", times.monthly_name("all_trains_data.csv", F.col("o_orderdate")).alias("file")
    )
    (
        named.hint("rebalance", "file")
        .write.partitionBy("file").option("header", "true").csv(path)
    )
    schema = T.StructType([T.StructField("o_orderkey", T.LongType())])
    name = times.month_from_name(F.col("_metadata.file_path"))
    back = landing.read_csv(spark, f"{path}/*", schema).withColumn("source_month", name)
    return back.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("key_sum")
    )
