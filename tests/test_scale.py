"""What moves between tasks and to the driver: plans of the steps that grow with the input."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from transitwx.config import HOUR_US, Settings
from transitwx.operators.asof import asof_with_fallback
from transitwx.operators.nearest import k_nearest
from transitwx.operators.rolling import rolling_features
from transitwx.operators.timetable import add_nested_offsets, add_station_names, decode_timetable, explode_stops
from transitwx.plans import catalog
from transitwx.plans import driver_tables as dt
from transitwx.plans.weather_merge import merge_stops
from transitwx.schemas import STOP
from transitwx.session import CLEANUP, stage, tidy_shuffles


@pytest.fixture
def no_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def orders(spark, tmp_path):
    """Orders of up to three lines, one of a line without a date, one row of orders twice."""
    lines = [(k, p, 7, n, 20.0 + n, 1.0, 0.0, 0.0, "A", "O", f"199{k}-0{4 - n}-01" if p else None)
             for k in (1, 2, 3) for n, p in ((1, 5), (2, 6), (3, 0 if k == 3 else 4))]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, d string"
    table = spark.createDataFrame(lines, names).withColumn("l_shipdate", F.to_timestamp("d")).drop("d")
    table.write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = [(k, 10 * k, "O", 1.0, "5-LOW") for k in (1, 2, 3, 3)]
    head = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    head.withColumn("o_orderdate", F.to_timestamp(F.lit("1995-01-02"))).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_shuffle_files_of_a_staged_step_go(spark):
    assert spark.conf.get(CLEANUP) == "false"
    with tidy_shuffles(spark):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == "false"
    assert stage(spark.range(9).groupBy((F.col("id") % 3).alias("k")).count(), "tidy-test").count() == 3


def test_no_copies_of_places_are_collected_in_the_driver(spark):
    spots = [(f"p{i}", 60 + i % 7 / 10, 20 + i / 100, i) for i in range(60)]
    places = spark.createDataFrame(spots, "station_name string, latitude double, longitude double, ord int")
    assert "BroadcastExchange" not in plan_of(k_nearest(places, places, 3))


def test_wide_answers_meet_nothing_after_they_are_put_together(spark, no_broadcasts):
    asked = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], "code string, us long")
    ranked = [("a", [(1, "s", True), (2, "t", False)]), ("b", [(1, "u", True), (2, "s", False)])]
    candidates = spark.createDataFrame(ranked, "code string, ranked array<struct<rank:int,station:string,is_primary:boolean>>")
    seen = spark.createDataFrame([("s", 9, None, 1.0), ("t", 12, 5.0, 2.0)], "station string, us long, snow double, wind double")
    out = asof_with_fallback(asked, candidates, seen, ["snow", "wind"], {"snow": [], "wind": []})
    plan = plan_of(out)
    assert "Join" not in plan[: plan.index("Exchange")]
    assert [tuple(r) for r in out.collect()] == [("a", 10, "s", 9, 5.0, 1.0)]


def test_trains_are_numbered_and_nested_in_one_shuffle(spark, orders, no_broadcasts):
    trains = dt.trains(spark, orders)
    # one of the lines, one of the orders
    assert plan_of(trains).count("Exchange hashpartitioning") == 2
    got = {r["version"]: [s["differenceInMinutes"] for s in r["timeTableRows"]] for r in trains.collect()}
    assert got == {1: [13, 12, 11], 2: [13, 12, 11], 3: [12, 12, 11, 11]}
    # the same as numbered in parts
    flat = dt.v_stop(spark, orders).select("train_id", "idx", "diff")
    assert sorted(flat.collect()) == sorted(dt.v_stop(spark, orders, together=True).select("train_id", "idx", "diff").collect())


def test_list_text_is_read_once(spark):
    trains = spark.createDataFrame([(1, "[{'stationShortCode': 'A'}]"), (2, "[{"), (3, "[]")], "n int, timeTableRows string")
    decoded = decode_timetable(trains, STOP)
    stops = explode_stops(decoded.where("not decode_error").drop("decode_error"))
    assert plan_of(stops.select("n", "idx", "stationShortCode")).count("from_json") == 1
    assert [(r["n"], r["stationShortCode"]) for r in stops.collect()] == [(1, "A")]
    assert {r["n"]: (r["decode_error"], len(r["timeTableRows"])) for r in decoded.collect()} == {1: (False, 1), 2: (True, 0), 3: (False, 0)}


def test_names_of_sets_go_by_a_number(spark, no_broadcasts):
    trains = spark.createDataFrame(
        [(1, [("A",), ("B",), ("A",), (None,)]), (2, [("B",), ("A",)]), (3, []), (4, None), (5, [("?",)])],
        "n int, timeTableRows array<struct<stationShortCode:string>>",
    )
    stations = spark.createDataFrame([("A", "Aa", 1), ("B", "Bb", 2), ("A", "late", 3)], "stationShortCode string, stationName string, ord int")
    named = add_station_names(trains, stations)
    plan = plan_of(explode_stops(named))
    assert "hashpartitioning(__set" in plan and "Join [__calls" not in plan
    got = {r["n"]: r["timeTableRows"] and [s["stationName"] for s in r["timeTableRows"]] for r in named.collect()}
    assert got == {1: ["Aa", "Bb", "Aa", None], 2: ["Bb", "Aa"], 3: [], 4: None, 5: [None]}


def test_a_stop_is_shuffled_once_and_meets_packed_answers(spark, no_broadcasts):
    record = "array<struct<stationShortCode:string,type:string,scheduledTime:string,differenceInMinutes:int>>"
    rows = [("A", "D", "2024-01-01T00:10:00.000Z", 1), ("A", "D", "2024-01-01T00:10:00Z", None), ("?", "D", "2024-01-01T00:10:00Z", 4),
            ("B", "D", "2024-01-01T00:10:00.000Z", 5), ("", "D", None, 6), ("C", "D", "2024-01-01T00:10:00.000Z", 7), ("A", "D", "", 8)]
    trains = spark.createDataFrame([(1, "2024-01-01", "x", rows)], f"trainNumber long, departureDate string, trainCategory string, timeTableRows {record}")
    ranked = [("A", "s", [(1, "s", True), (2, "t", False)]), ("B", "u", [(1, "u", True)]), ("C", None, None)]
    lists = "stationShortCode string, closest_ems_station string, ranked array<struct<rank:int,station:string,is_primary:boolean>>"
    seen = [("s", 9, None, 1.0, 3.0), ("t", 12, 5.0, 2.0, 4.0)]
    weather = spark.createDataFrame(seen, "station_name string, us long, `Snow depth` double, `Wind speed` double, `Air temperature` double")
    weather = weather.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).withColumn("us", F.col("us") + 1_704_067_200_000_000)
    merged = merge_stops(trains, weather, spark.createDataFrame(ranked, lists), Settings(filter_by_category=False))
    plan = plan_of(merged)
    assert plan.count("SortMergeJoin [stationShortCode") == 1 and "Exchange hashpartitioning(stationShortCode#" in plan
    # between the window that puts answers together and the join they are neither shuffled nor sorted
    above = plan[: plan.index("Window [first(__f0")].splitlines()[-4:]
    assert not any("Exchange" in line or "Sort " in line for line in above), above
    got = {r["idx"]: (r["weather_status"], r["closest_ems"], r["Snow depth"], r["Wind speed"], r["Air temperature"]) for r in merged.collect()}
    assert got == {0: ("ok", "s", 5.0, 1.0, 3.0), 1: ("bad_time", None, None, None, None), 2: ("no_station", None, None, None, None),
                   3: ("no_data", None, None, None, None), 4: (None,) * 5, 5: ("no_data", None, None, None, None), 6: (None,) * 5}


def test_finished_windows_travel_as_one_column(spark):
    obs = spark.createDataFrame([("s", 10 * HOUR_US, 1.5, "x"), ("s", 15 * HOUR_US, None, "y"), ("s", 40 * HOUR_US, 4.0, None)], "station_name string, us long, p double, note string")
    rolled = rolling_features(obs, ["p"], (12, 24))
    plan = plan_of(rolled)
    assert "__t_24#" in plan and "__others#" in plan and "__t_max_0_24" not in plan
    got = sorted((r["us"] // HOUR_US, r["note"], r["p"], r["p (12h max)"], r["p (24h cumulative)"]) for r in rolled.collect())
    assert got == [(10, "x", 1.5, 1.5, 1.5), (15, "y", None, 1.5, 1.5), (40, None, 4.0, 4.0, 4.0)]


def test_offsets_search_a_list_once_and_only_at_a_gap(spark):
    delays = [None, None, 3, None, None, 7, 6]
    trains = spark.createDataFrame([(1, [(d,) for d in delays]), (2, [(2,), None, (5,)]), (3, []), (4, None)], "n int, timeTableRows array<struct<differenceInMinutes:int>>")
    out = add_nested_offsets(trains)
    assert plan_of(out).count("filter(") == 1
    got = {r["n"]: r["timeTableRows"] and [tuple(s) for s in r["timeTableRows"]] for r in out.collect()}
    assert got[1] == [(None, None, None), (None, None, None), (3, 3, 3), (None, None, None), (None, None, None), (7, 7, 4), (6, 6, -1)]
    assert got[2] == [(2, 2, 2), (None, None, None), (5, 3, 3)]
    assert got[3] == [] and got[4] is None


def test_nested_stops_leave_the_shuffles_of_the_merge_behind(spark, orders, no_broadcasts):
    seen = [(1, "2024-01-03 01:00:00", 4, "view", 2.0), (2, "2024-01-09 01:00:00", 5, "error", 3.0)]
    events = spark.createDataFrame(seen, "event_id long, t string, user_id long, event_type string, value double")
    events.withColumn("ts", F.to_timestamp("t")).write.parquet(f"{orders}/events.parquet")
    for name, key in (("customer", "c"), ("supplier", "s")):
        keys = spark.createDataFrame([(k, str(k)) for k in (4, 5)], f"{key}_{'cust' if key == 'c' else 'supp'}key long, {key}_name string")
        keys.write.parquet(f"{orders}/{name}.parquet")
    nested = catalog.QUERIES["stop_weather_nested"](spark, orders)
    # by train alone: what merged the stops is no part of the query that nests them
    assert plan_of(nested).count("Exchange hashpartitioning") == 1
    got = {r["train_id"]: (r["stops"], r["observed"], r["places"]) for r in nested.collect()}
    assert got == {1: (3, 2, "S4 - S5"), 2: (3, 2, "S4 - S5"), 3: (4, 2, "- - S5 S5")}, got
