import datetime as d

import pytest
from pyspark.sql import functions as F

from transitwx.config import Settings
from transitwx.functions import geo, naming, numbers, times
from transitwx.functions.text import list_text
from transitwx.operators.timetable import decode_timetable, explode_stops
from transitwx.schemas import STOP, TRAIN


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_names_and_width_of_the_rolling_features():
    s = Settings()
    assert naming.rolling_column_names("Air temperature", 12) == {
        "max": "Air temperature (12h max)",
        "min": "Air temperature (12h min)",
        "mean": "Air temperature (12h mean)",
        "cumulative": "Air temperature (12h cumulative)",
    }
    assert list(naming.rolling_column_names("Precipitation amount", 24, False)) == ["mean", "cumulative"]
    names = [
        c for p in s.rolling_params for c in naming.rolling_columns(p, s.rolling_hours, s.rolling_without_extremes)
    ]
    assert len(names) == len(set(names)) == 102


@pytest.mark.parametrize("x,want", [(1.005, 1.0), (0.125, 0.12), (2.675, 2.68), (-0.125, -0.12), (3.0, 3.0)])
def test_round2(spark, x, want):
    assert one(spark, numbers.round2(F.lit(x))) == pytest.approx(want)


def test_mean_or_zero_and_nan(spark):
    assert one(spark, numbers.mean_or_zero(F.lit(7), F.lit(0))) == 0.0
    assert one(spark, numbers.mean_or_zero(F.lit(7), F.lit(2))) == 3.5
    assert one(spark, numbers.nan_to_null(F.lit(float("nan")))) is None
    assert one(spark, numbers.nan_to_null(F.lit(1.5))) == 1.5


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2024-01-01T05:06:07.000Z", True),
        ("2024-01-01T05:06:07.1Z", True),
        ("2024-01-01T05:06:07.123456Z", True),
        ("2024-01-01T05:06:07Z", False),
        ("2024-01-01 05:06:07.000", False),
        ("2024-13-01T05:06:07.000Z", False),
        ("", False),
        (None, False),
    ],
)
def test_stop_time_needs_its_fraction(spark, text, ok):
    got = one(spark, times.parse_stop_time(F.lit(text).cast("string")))
    assert (got is not None) == ok
    if ok:
        assert got.replace(microsecond=0) == d.datetime(2024, 1, 1, 5, 6, 7)


@pytest.mark.parametrize("text,day", [("2024-02-29", d.date(2024, 2, 29)), ("2023-02-29", None), ("2024-2-9", None), ("x", None)])
def test_parse_date(spark, text, day):
    assert one(spark, times.parse_date(F.lit(text))) == day


def test_weekday_month_and_names(spark):
    monday, sunday = (F.lit(x).cast("date") for x in ("2024-01-01", "2024-01-07"))
    assert (one(spark, times.iso_weekday(monday)), one(spark, times.iso_weekday(sunday))) == (1, 7)
    assert one(spark, times.monthly_name("weather.csv", sunday)) == "weather_2024_01.csv"
    assert one(spark, times.month_from_name(F.lit("/data/all_2023_11.csv"))) == "2023-11"
    assert one(spark, times.month_from_name(F.lit("stations.csv"))) is None


def test_last_chunk_of_a_day_ends_early(spark):
    start = F.lit("2024-01-01").cast("timestamp")
    parts = one(spark, times.chunks(start, start + F.expr("interval '23:59:59' hour to second")))
    assert len(parts) == 24
    assert parts[-1]["chunk_end"] == d.datetime(2024, 1, 1, 23, 59, 59)
    assert one(spark, F.size(times.chunks(start, start))) == 0


def test_time_block_is_exact_at_its_edges(spark):
    width = 43_200_000_000
    for k in (0, 39_444, 65_537, 120_001):
        for off, want in ((-1, k - 1), (0, k), (width - 1, k)):
            us = k * width + off
            if us >= 0:
                assert one(spark, times.time_block(F.lit(us).cast("long"), width)) == want
    assert one(spark, times.time_block(F.lit(-1).cast("long"), width)) == -1


def test_haversine(spark):
    km = geo.haversine_km(F.lit(60.1719), F.lit(24.9414), F.lit(65.0121), F.lit(25.4651))
    assert one(spark, km) == pytest.approx(538.9, abs=0.5)
    assert one(spark, geo.haversine_km(*[F.lit(x) for x in (5.0, 6.0, 5.0, 6.0)])) == 0.0
    pole = geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))
    assert one(spark, pole) == pytest.approx(6371.0088 * 3.141592653589793)


def test_list_text(spark):
    assert one(spark, list_text(F.array(F.lit(5), F.lit(7)))) == "[5, 7]"
    assert one(spark, list_text(F.array().cast("array<int>"))) == "[]"


DECODE = [
    ("plain", "[{'stationShortCode': 'HKI', 'trainStopping': True, 'cancelled': False, 'commercialTrack': None, 'differenceInMinutes': 3}]"),
    ("apostrophe", "[{'stationName': \"King's Cross\", 'stationShortCode': 'K'}]"),
    ("both quotes", "[{'stationName': 'the \\'old\\' \"yard\"', 'stationShortCode': 'Y'}]"),
    ("word in a name", "[{'stationName': 'None True', 'stationShortCode': 'N'}]"),
    ("two stops", "[{'stationShortCode': 'A', 'differenceInMinutes': 1}, {'stationShortCode': 'B'}]"),
    ("empty", "[]"),
    ("no list", "{'stationShortCode': 'A'}"),
    ("broken", "[{'stationShortCode': 'A'"),
    ("null", None),
]


def test_decode_timetable(spark):
    df = spark.createDataFrame(DECODE, "case string, timeTableRows string")
    rows = {r["case"]: r for r in decode_timetable(df, STOP).collect()}
    plain = rows["plain"]["timeTableRows"][0]
    assert (plain["stationShortCode"], plain["trainStopping"], plain["cancelled"]) == ("HKI", True, False)
    assert plain["commercialTrack"] is None and plain["differenceInMinutes"] == 3
    assert rows["apostrophe"]["timeTableRows"][0]["stationName"] == "King's Cross"
    assert rows["both quotes"]["timeTableRows"][0]["stationName"] == "the 'old' \"yard\""
    assert rows["word in a name"]["timeTableRows"][0]["stationName"] == "None True"
    assert [s["stationShortCode"] for s in rows["two stops"]["timeTableRows"]] == ["A", "B"]
    assert rows["two stops"]["timeTableRows"][1]["differenceInMinutes"] is None
    assert rows["empty"]["timeTableRows"] == [] and not rows["empty"]["decode_error"]
    for case in ("no list", "broken", "null"):
        assert rows[case]["timeTableRows"] == [] and rows[case]["decode_error"]
    # an unreadable train stays as a train without stops
    kept = explode_stops(decode_timetable(df, STOP), keep_empty=True)
    assert {r["case"] for r in kept.collect()} == {c for c, _ in DECODE}


def test_schemas_follow_the_landed_fields():
    assert len(TRAIN) == 14 and TRAIN["timeTableRows"].dataType.elementType == STOP
    assert STOP["differenceInMinutes"].dataType.simpleString() == "int"
