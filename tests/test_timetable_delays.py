import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from transitwx.config import DELAY, DELAY_FROM_ORIGIN, DELAY_FROM_PREVIOUS
from transitwx.operators import delays, months, quality, stations, timetable, weather
from transitwx.operators.first import first_row

NESTED = "train int, timeTableRows array<struct<stationShortCode:string,differenceInMinutes:int,type:string>>"


def offsets(values):
    origin = values[0] if values else None
    out, before = [], None
    for i, v in enumerate(values):
        if v is None:
            out.append((None, None))
            continue
        out.append((v if i == 0 or origin is None else v - origin, v if before is None else v - before))
        before = v
    return out


def trains(seed=1, n=60):
    rng = random.Random(seed)
    cases = [[], [None], [None, 4, 6], [3, None, None, 9, 1], [5]]
    while len(cases) < n:
        cases.append([None if rng.random() < 0.4 else rng.randrange(-5, 40) for _ in range(rng.randrange(1, 30))])
    return cases


def test_nested_offsets(spark):
    cases = trains()
    df = spark.createDataFrame([(i, [("S", v, "T") for v in c]) for i, c in enumerate(cases)], NESTED)
    out = timetable.add_nested_offsets(df)
    fields = out.schema["timeTableRows"].dataType.elementType.fieldNames()
    assert fields == ["stationShortCode", DELAY, DELAY_FROM_ORIGIN, DELAY_FROM_PREVIOUS, "type"]
    for r in out.collect():
        got = [(s[DELAY_FROM_ORIGIN], s[DELAY_FROM_PREVIOUS]) for s in r["timeTableRows"]]
        assert got == offsets(cases[r["train"]])
    assert "Exchange" not in plan_of(out)


@pytest.mark.parametrize("block", [1, 4, 256])
def test_flat_offsets_with_any_block_size(spark, block):
    cases = trains(2)
    rows = [(i, j, v) for i, c in enumerate(cases) for j, v in enumerate(c)]
    df = spark.createDataFrame(rows, "train int, idx int, diff int")
    out = timetable.add_offsets(df, ["train"], block=block).collect()
    assert len(out) == len(rows)
    want = {(i, j): o for i, c in enumerate(cases) for j, o in enumerate(offsets(c))}
    assert {(r["train"], r["idx"]): (r["diff_offset"], r["diff_each"]) for r in out} == want


def test_ordinal_counts_across_parts(spark):
    df = spark.createDataFrame([(k, v) for k in "ab" for v in range(50)], "k string, v int")
    out = timetable.ordinal(df, ["k"], ["v"], split=(F.col("v") / 7).cast("int"))
    assert all(r["idx"] == r["v"] for r in out.collect())


def test_route_and_category(spark):
    rows = [
        (1, [("HKI", 1, "D"), ("OL", 1, "A"), ("ROI", 1, "A")]),
        (2, [("HKI", 1, "D"), ("OL", 1, "A")]),
        (3, []),
        (4, None),
        (5, [(None, 1, "D"), ("ROI", 1, "A"), ("OL", 1, "A"), ("HKI", 1, "A"), ("HKI", 1, "A")]),
    ]
    df = spark.createDataFrame(rows, NESTED)
    must = ["HKI", "OL", "ROI"]
    assert {r["train"] for r in timetable.filter_route(df, must).collect()} == {1, 5}
    assert timetable.filter_route(df, None).count() == 5
    flat = timetable.explode_stops(df)
    chosen = timetable.filter_route_flat(flat, ["train"], "stationShortCode", must)
    assert {r["train"] for r in chosen.collect()} == {1, 5}
    assert timetable.filter_category(df, None).count() == 5
    assert timetable.filter_category(df, 3, "train").count() == 1


def test_explode_and_renest_keep_the_order(spark):
    df = spark.createDataFrame([(1, [("B", 2, "x"), ("A", None, "y")]), (2, [])], NESTED)
    flat = timetable.explode_stops(df, keep_empty=True)
    assert flat.where("train = 2").first()["idx"] is None
    back = timetable.renest_stops(flat, ["train"], ["stationShortCode", DELAY, "type"])
    rows = {r["train"]: [s["stationShortCode"] for s in r["timeTableRows"]] for r in back.collect()}
    assert rows == {1: ["B", "A"], 2: []}


def test_station_names_first_match_null_and_position(spark):
    df = spark.createDataFrame([(1, [("A", 2, "x"), ("Q", 1, "y"), ("B", 0, "z")]), (2, []), (3, None)], NESTED)
    dim = spark.createDataFrame(
        [("A", "first", 1), ("A", "second", 2), ("B", "bee", 3), (None, "none", 0)],
        "stationShortCode string, stationName string, ord int",
    )
    out = timetable.add_station_names(df, dim)
    assert out.schema["timeTableRows"].dataType.elementType.fieldNames()[0] == "stationName"
    rows = {r["train"]: r["timeTableRows"] for r in out.collect()}
    assert [s["stationName"] for s in rows[1]] == ["first", None, "bee"]
    assert rows[2] == [] and rows[3] is None


def test_station_names_of_equal_trains_and_null_keys(spark):
    stops = [("A", 2, "x"), (None, 1, "y"), ("A", 0, "z")]
    df = spark.createDataFrame([(1, stops), (1, stops), (None, stops), (None, [("Q", 1, "x")])], NESTED)
    dim = spark.createDataFrame([("A", "first", 1)], "stationShortCode string, stationName string, ord int")
    out = [[s["stationName"] for s in r["timeTableRows"]] for r in timetable.add_station_names(df, dim).collect()]
    assert sorted(out, key=len) == [[None], *[["first", None, "first"]] * 3]


STOPS = "departure_date date, train_number int, diff int"


def stops(spark):
    rows = [("2024-01-01", 1, v) for v in (5, 5, 7, 4, None, 7, 6, 30)]
    rows += [("2024-01-02", 1, 4), ("2024-01-02", 2, None), (None, 3, 50)]
    df = spark.createDataFrame(rows, "departure_date string, train_number int, diff int")
    return df.withColumn("departure_date", F.col("departure_date").cast("date"))


def summary(spark):
    return delays.delay_summary(stops(spark), ["diff"]).drop("metric", "departure_date")


def test_delay_summary(spark):
    got = {r["day_of_month"]: r.asDict() for r in summary(spark).collect()}
    assert got[1] == {
        "year": 2024, "month": 1, "day_of_month": 1, "day_of_week": 1, "delay_count_by_day": 6,
        "total_schedules_by_day": 8, "total_delay_minutes": 60, "max_delay_minutes": 30,
        "total_trains_on_route": 1, "avg_delay_minutes": 10.0, "top_10_common_delays": "[5, 7, 6, 30]",
    }
    assert got[2]["delay_count_by_day"] == 0 and got[2]["avg_delay_minutes"] == 0.0
    assert got[2]["max_delay_minutes"] == 0 and got[2]["top_10_common_delays"] == "[]"
    assert got[2]["total_trains_on_route"] == 2 and len(got) == 2


def test_top_ten_is_cut_by_count_then_value(spark):
    rows = [(v,) for v in range(5, 25)] + [(24,), (23,)]
    df = spark.createDataFrame(rows, "diff int").withColumn("departure_date", F.lit("2024-01-01").cast("date"))
    assert delays.common_delays(df, ["diff"]).first()["top_delays"] == [23, 24, 5, 6, 7, 8, 9, 10, 11, 12]


def test_upsert_twice_is_upsert_once(spark):
    daily = summary(spark)
    old = daily.withColumn("delay_count_by_day", F.lit(99).cast("long")).where("day_of_month = 2")
    once = delays.upsert_summary(old, daily)
    twice = delays.upsert_summary(once, daily)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == sorted(map(tuple, daily.collect()))
    totals = delays.month_totals(once).first()
    assert (totals["days"], totals["total_delays"], totals["total_schedules"], totals["total_trains"]) == (2, 6, 10, 3)


def test_hot_day_is_reduced_before_the_shuffle(spark):
    plan = plan_of(delays.daily_delays(stops(spark), ["diff"]))
    first = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_sum" in first or "partial_count" in first


def test_quality(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, "a"), (None, "b")], "x double, s string")
    assert tuple(quality.feature_profile(df, ["x"]).first()) == ("x", 2, 1, 1)
    got = {r["column"]: r["distinct_values"] for r in quality.distinct_counts(df, ["x", "s"]).collect()}
    assert got == {"x": 2, "s": 2}
    counts = quality.filter_counts(df, {"a": F.col("s") == "a", "zero": F.col("x") == 0}).first()
    assert tuple(counts) == (3, 2, 1)
    month = lambda *m: spark.createDataFrame([(x,) for x in m], "month string")
    quality.require_same_months(month("2024-01", "2024-03"), month("2024-03", "2024-01", "2024-02"))
    with pytest.raises(ValueError, match="months differ"):
        quality.require_same_months(month("2024-01"), month("2024-02"))
    with pytest.raises(ValueError, match="months differ"):
        quality.require_same_months(month("2024-01"), month("2024-01").where("false"))
    with pytest.raises(ValueError):
        quality.require_rows(3, 4)
    assert [r[0] for r in months.common_months(month("a", "b", "b"), month("b", "c")).collect()] == ["b"]
    assert [r[0] for r in months.missing_keys(month("a", "b"), month("b"), "month").collect()] == ["a"]


def test_stations_and_codes(spark):
    raw = spark.createDataFrame(
        [("HKI", "Helsinki", 60.1, 24.9, "STATION", 1, "FI")],
        "stationShortCode string, stationName string, latitude double, longitude double, type string, stationUICCode int, countryCode string",
    )
    dim = stations.station_dimension(raw)
    assert dim.columns == ["train_station_short_code", "train_station_name", "train_lat", "train_long"]
    assert stations.station_dimension(dim).columns == dim.columns
    codes = spark.createDataFrame([("Syy",), ("muu",), ("",), (None,)], "categoryName string")
    words = spark.createDataFrame([("Syy", "Cause"), ("Syy", "Reason")], "source string, target string")
    got = {r["categoryName"]: r["categoryName_en"] for r in stations.translate(codes, "categoryName", words).collect()}
    assert got == {"Syy": "Cause", "muu": "muu [untranslated]", "": "", None: ""}


def test_weather_rows(spark):
    doc = '{"2024-01-01 00:00:00": {"A": {"t": {"value": 1.5}, "w": {"value": NaN}}, "B": {"t": {"value": null}}}, "bad": {"A": {"t": {"value": 2.0}}}}'
    df = spark.createDataFrame([(doc,), ("not json",)], "value string")
    got = {(r["timestamp"] is not None, r["station_name"]): (r["t"], r["w"]) for r in weather.flatten_documents(df, ["t", "w"]).collect()}
    assert got == {(True, "A"): (1.5, None), (True, "B"): (None, None), (False, "A"): (2.0, None)}
    meta = spark.createDataFrame(
        [(1, "{}"), (2, '{"A": {"latitude": 1.0, "longitude": 2.0}}'), (3, '{"B": {"latitude": 3.0, "longitude": 4.0}}')],
        "ord int, value string",
    )
    assert [tuple(r) for r in weather.station_metadata(meta).collect()] == [("A", 1.0, 2.0)]


def test_first_row_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z")], "k string, o int, v string")
    out = first_row(df, ["k"], "o")
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [("a", 1, "x"), ("b", 5, "z")]
    assert "partial_min_by" in plan_of(out)


def test_python_text_escapes(spark):
    from transitwx.functions.text import decode_records
    from transitwx.schemas import STOP

    names = ["Oulu\xa0asema", "tab\t\x07\x0b\\x41 it's \"q\"", "None, (a, )", "\u2028\U000e0001\ud800"[:2]]
    lists = [[{"stationName": n, "differenceInMinutes": 3}] for n in names]
    texts = [ascii(x) for x in lists] + [repr(tuple(lists[0])), repr((lists[0][0],))]
    bad = [r"[{'stationName': 'a\q'}]", r"[{'stationName': '\N{DASH}'}]", r"[{'stationName': '\x4'}]", "nothing"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts + bad)], "i int, t string")
    got = [r["d"] for r in table.select("i", decode_records(F.col("t"), STOP).alias("d")).orderBy("i").collect()]
    assert [[x["stationName"] for x in d] for d in got[:6]] == [[n] for n in [*names, names[0], names[0]]]
    assert got[6:] == [None] * 4
    nan = spark.createDataFrame([("[{'stationName': 'nan', 'differenceInMinutes': nan}]",)], "t string")
    first = nan.select(decode_records(F.col("t"), STOP).alias("d")).first()["d"][0]
    assert (first["stationName"], first["differenceInMinutes"]) == ("nan", None)


def test_summary_reads_stops_once(spark, tmp_path):
    from transitwx.operators.delays import delay_summary, distinct_trains, tally, train_bitmaps

    rows = [(i % 5, f"2024-0{1 + i % 2}-0{1 + i % 3}", i % 7 if i % 4 else None, i % 11) for i in range(300)]
    path = str(tmp_path / "stops")
    spark.createDataFrame(rows, "train_number long, day string, a int, b int").write.parquet(path)
    stops = spark.read.parquet(path).withColumn("departure_date", F.col("day").cast("date"))
    summary = delay_summary(stops, ["a", "b"], 3, 2)
    assert plan_of(summary).count("FileScan parquet") == 1
    got = {(r["metric"], str(r["departure_date"])): r for r in summary.collect()}
    for i, metric in ((2, "a"), (3, "b")):
        for day in {r[1] for r in rows}:
            mine = [r for r in rows if r[1] == day]
            late = [r[i] for r in mine if r[i] is not None and r[i] >= 3]
            top = sorted(set(late), key=lambda v: (-late.count(v), v))[:2]
            r = got[metric, day]
            assert (r["delay_count_by_day"], r["total_delay_minutes"], r["max_delay_minutes"]) == (len(late), sum(late), max(late))
            assert r["total_schedules_by_day"] == len(mine) and r["total_trains_on_route"] == len({x[0] for x in mine})
            assert r["top_10_common_delays"] == str(top)
    spans = distinct_trains(train_bitmaps(tally(stops, ["a"])), month=F.month("day"))
    assert {r["month"]: r["distinct_trains"] for r in spans.collect()} == {1: 5, 2: 5}
    named = stops.withColumn("train_number", F.concat(F.lit("T"), "train_number"))
    assert delay_summary(named, ["a", "b"], 3, 2).exceptAll(summary).count() == 0
