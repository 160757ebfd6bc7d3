import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from transitwx.functions.curve import interleave, slice_of
from transitwx.operators.weather import flatten_documents
from transitwx.schemas import _struct
from transitwx.session import scratch_path, scratch_root, stage
from transitwx.sources import landing, tables


def land(root, folder, records, name="part.json"):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    with open(f"{root}/{folder}/{name}", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


def train(number, day, **more):
    return {"trainNumber": number, "departureDate": day, "trainCategory": "Cargo", "timeTableRows": [], **more}


def test_trains_of_a_closed_range(spark, tmp_path):
    for day in ("2023-12-31", "2024-01-01", "2024-01-02", "2024-01-03"):
        record = train(int(day[-2:]), day)
        record.pop("departureDate")
        land(tmp_path, f"departureDate={day}", [record])
    out = landing.read_trains(spark, str(tmp_path), "2024-01-01", "2024-01-02")
    assert sorted(r["departureDate"] for r in out.collect()) == ["2024-01-01", "2024-01-02"]
    plan = plan_of(out)
    assert "PartitionFilters: [isnotnull(departureDate" in plan
    with pytest.raises(ValueError):
        landing.read_trains(spark, str(tmp_path), "01.01.2024", "2024-01-02")


def test_trains_by_month_folders(spark, tmp_path):
    land(tmp_path, "year=2024/month=1", [train(1, "2024-01-31"), train(2, "2024-01-05")])
    land(tmp_path, "year=2024/month=2", [train(3, "2024-02-01", extra="ignored")])
    land(tmp_path, "year=2023/month=12", [train(4, "2023-12-31")])
    out = landing.read_trains(spark, str(tmp_path), "2024-01-31", "2024-02-01")
    rows = {r["trainNumber"]: r for r in out.collect()}
    assert set(rows) == {1, 3} and rows[1]["commuterLineID"] is None
    assert "PartitionFilters: [isnotnull" in plan_of(out)


def test_dimensions(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"stationShortCode": "HKI", "latitude": 60.1}, {"stationShortCode": "OL"}]))
    (tmp_path / "e.json").write_text("[]")
    out = landing.read_dimension(spark, "stations", str(tmp_path / "s.json"))
    assert [(r["stationShortCode"], r["latitude"]) for r in out.collect()] == [("HKI", 60.1), ("OL", None)]
    assert landing.read_dimension(spark, "causes", str(tmp_path / "e.json")).count() == 0


def test_weather_documents(spark, tmp_path):
    body = {"2024-01-01 00:00:00": {"A": {"t": {"value": 1.5}}, "B": {"t": {"value": 2.5}}}}
    land(tmp_path, ".", [body], "obs_1.json")
    docs = landing.read_documents(spark, str(tmp_path))
    rows = flatten_documents(docs, ["t", "absent"]).collect()
    assert sorted((r["station_name"], r["t"], r["absent"]) for r in rows) == [("A", 1.5, None), ("B", 2.5, None)]
    assert docs.first()["ord"].endswith("obs_1.json")


def test_csv_keeps_words_quotes_and_line_breaks(spark, tmp_path):
    schema = _struct("a bigint, b string, c double")
    rows = [(1, "NA", 0.1), (2, None, None), (3, 'say "hi", ok', -1e-7), (4, "two\nlines", 1e300)]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "t")
    assert tables.write_table(df, path, "csv")
    assert sorted(map(tuple, landing.read_csv(spark, path, schema, line_breaks=True).collect())) == rows


def test_empty_table_is_not_written(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not tables.write_table(spark.range(0), path)
    assert not os.path.exists(path)


def test_month_comes_from_the_file_name(spark, tmp_path):
    (tmp_path / "all_trains_data_2024_03.csv").write_text("a\n1\n2\n")
    (tmp_path / "all_trains_data_2024_04.csv").write_text("a\n3\n")
    out = landing.read_monthly_csv(spark, str(tmp_path), _struct("a bigint"))
    assert sorted(map(tuple, out.collect())) == [(1, "2024-03"), (2, "2024-03"), (3, "2024-04")]


def test_only_written_months_are_replaced(spark, tmp_path):
    path = str(tmp_path / "m")
    day = F.expr("date_add(date'2024-01-30', cast(id as int))").alias("day")
    df = spark.range(4).select("id", day)
    tables.write_monthly(df.withColumn("v", F.lit("old")), path, "day")
    tables.write_monthly(df.where("id >= 2").withColumn("v", F.lit("new")), path, "day", sort=["id"])
    got = {(r["id"], r["year"], r["month"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == {(0, 2024, 1, "old"), (1, 2024, 1, "old"), (2, 2024, 2, "new"), (3, 2024, 2, "new")}


def test_preview(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "a int")
    assert [r["a"] for r in tables.preview(df, ["a"], 2).collect()] == [1, 3]


def test_stage_uses_the_named_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = spark.createDataFrame([(1.0, "a")], "`t (12h max)` double, s string")
    staged = stage(df, "odd-names")
    assert staged.columns == df.columns and staged.collect() == df.collect()
    assert root in staged.inputFiles()[0]


def files_that_may_hold(path, box):
    """Files whose statistics meet the box, and all files."""
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
    hit = 0
    for meta in found:
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        hit += any(
            all(
                g.column(at[c]).statistics.min <= high and g.column(at[c]).statistics.max >= low
                for c, (low, high) in box.items()
            )
            for g in groups
        )
    return hit, len(found)


def test_clustered_files_hold_small_boxes(spark, tmp_path):
    rows = spark.range(60000).select(
        (F.pmod(F.xxhash64("id"), F.lit(10000)) / 100).alias("a"),
        # crowded at one end
        F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000, 4).alias("b"),
        F.timestamp_micros(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10**12))).cast("timestamp_ntz").alias("t"),
        F.col("id").alias("__curve0"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tables.write_clustered(rows, f"{tmp_path}/t", ["a", "b", "t"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.columns == rows.columns
    assert back.exceptAll(rows).isEmpty() and back.count() == 60000
    hit, of = files_that_may_hold(f"{tmp_path}/t", {"a": (10.0, 15.0), "b": (0.0, 0.001)})
    assert of > 40 and hit <= of / 4
    plan = plan_of(back.where("a between 10 and 15 and b < 0.001"))
    assert "GreaterThanOrEqual(a,10.0)" in plan and "LessThan(b,0.001)" in plan


def test_clustered_write_of_nulls_one_value_and_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1.0), (2, None), (None, None), (2, 1.0), (2, 1.0)], "a int, b double")
    for n, part in enumerate((rows, rows.where("a = 2 and b = 1"), rows.where("false"))):
        tables.write_clustered(part, f"{tmp_path}/{n}", ["a", "b"])
        back = spark.read.parquet(f"{tmp_path}/{n}")
        assert sorted(back.collect(), key=str) == sorted(part.collect(), key=str)


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    key = interleave([F.col("a"), F.col("b")], 2)
    for r in rows.select("a", "b", key.alias("k")).collect():
        assert r["k"] == int("".join(f"{r['a']:02b}"[i] + f"{r['b']:02b}"[i] for i in range(2)), 2)
    cuts = [1.0, 2.5, 2.75, 9.0, 9.5]
    values = spark.createDataFrame([(x,) for x in (None, -1.0, 1.0, 2.6, 9.2, 99.0)], "x double")
    assert [r[0] for r in values.select(slice_of(F.col("x"), cuts)).collect()] == [0, 0, 1, 2, 4, 5]
