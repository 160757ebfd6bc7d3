"""Trains and their stops: filters, flattening, order and delay offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitwx.config import DELAY, DELAY_FROM_ORIGIN, DELAY_FROM_PREVIOUS
from transitwx.functions.naming import quoted
from transitwx.functions.text import decode_records
from transitwx.operators.stations import lookup

ROWS = "timeTableRows"
STOPS_PER_BLOCK = 256


def _once(costly: Column) -> Column:
    """The value, worked out once a row: Spark copies an expression into the filters
    on it, which later steps may bring, but not a generator."""
    return F.explode(F.array(costly))


def decode_timetable(trains: DataFrame, record: T.StructType, rows: str = ROWS) -> DataFrame:
    """Turn list text into records.

    Text that cannot be read gives an empty list and ``decode_error = true``;
    NULL text counts as unreadable too. A list is read once, whatever the caller
    filters by.
    """
    decoded = decode_records(F.col(rows), record)
    out = trains.select("*", _once(decoded).alias("__decoded"))
    empty = F.from_json(F.lit("[]"), T.ArrayType(record))
    return (
        out.withColumn(rows, F.coalesce("__decoded", empty))
        .withColumn("decode_error", F.col("__decoded").isNull())
        .drop("__decoded")
    )


def filter_category(trains: DataFrame, category: str | None, column: str = "trainCategory"):
    """Trains of one category; all of them for ``None``."""
    return trains if category is None else trains.where(F.col(column) == category)


def passes_all(rows: Column, stations: Sequence[str], field: str = "stationShortCode") -> Column:
    """True when a list of stops contains every one of the stations."""
    codes = F.transform(rows, lambda s: s[field])
    wanted = F.array(*[F.lit(s) for s in stations])
    return F.size(F.array_except(wanted, F.coalesce(codes, F.array().cast("array<string>")))) == 0


def filter_route(trains: DataFrame, stations: Sequence[str] | None, rows: str = ROWS) -> DataFrame:
    """Trains that stop at all the stations; no list means no filter."""
    return trains.where(passes_all(F.col(rows), stations)) if stations else trains


def routes_passing(stops: DataFrame, keys: Sequence[str], code: str, stations: Sequence) -> DataFrame:
    """Keys of flat trains that stop at all the stations.

    One flag per station: a plain hash aggregate that is reduced map-side.
    """
    flags = [F.max(F.col(code) == s).alias(f"__s{i}") for i, s in enumerate(stations)]
    everywhere = " and ".join(f"__s{i}" for i in range(len(stations)))
    relevant = stops.where(F.col(code).isin(list(stations)))
    return relevant.groupBy(*keys).agg(*flags).where(everywhere).select(*keys)


def filter_route_flat(stops, keys: Sequence[str], code: str, stations: Sequence) -> DataFrame:
    """All stops of the trains that stop at all the stations."""
    if not stations:
        return stops
    return stops.join(routes_passing(stops, keys, code, stations), list(keys), "left_semi")


def explode_stops(trains: DataFrame, rows: str = ROWS, keep_empty: bool = False) -> DataFrame:
    """One row per stop with its position ``idx``, list order kept.

    ``keep_empty`` keeps a train without stops as one row with NULL ``idx``.
    """
    rest = [c for c in trains.columns if c != rows]
    spread = F.posexplode_outer if keep_empty else F.posexplode
    flat = trains.select(*rest, spread(rows).alias("idx", "__stop"))
    # a stop field that repeats a train field is told apart by a prefix
    fields = trains.schema[rows].dataType.elementType.fieldNames()
    named = [F.col("__stop")[f].alias(f if f not in rest else f"stop_{f}") for f in fields]
    return flat.select(*rest, "idx", *named)


def renest_stops(
    stops: DataFrame, keys: Sequence[str], fields: Sequence[str], idx: str = "idx", rows: str = ROWS
) -> DataFrame:
    """One row per train with its stops as an ordered list."""
    entry = F.struct(F.col(idx).alias("__idx"), F.struct(*fields).alias("__stop"))
    # compiled, as array_sort and a transform are not
    ordered = F.sort_array(F.collect_list(F.when(F.col(idx).isNotNull(), entry)))
    nested = stops.groupBy(*keys).agg(ordered.alias(rows))
    return nested.withColumn(rows, F.col(quoted(rows))["__stop"])


def add_station_names(
    trains: DataFrame,
    stations: DataFrame,
    order: str = "ord",
    rows: str = ROWS,
    code: str = "stationShortCode",
) -> DataFrame:
    """Put ``stationName`` in front of every stop of every train.

    Names depend only on the set of stations a train calls at. They are looked up
    once per set, and each train meets the names of its own set; trains are
    neither told apart by keys nor taken to pieces, so equal rows and rows with
    NULL keys keep their stops. Sets go by a hash, so that the lists are neither
    copied per station nor sorted; sets with equal hashes share their names.
    """
    fields = [f for f in trains.schema[rows].dataType.elementType.fieldNames() if f != "stationName"]
    calls = F.sort_array(F.array_distinct(F.array_compact(F.col(quoted(rows))[code])))
    keyed = trains.withColumn("__set", F.xxhash64(calls))
    sets = trains.select(_once(calls).alias("__calls")).distinct()
    each = sets.select(F.xxhash64("__calls").alias("__set"), F.explode("__calls").alias("__code"))
    named = lookup(each, stations, "__code", code, {"stationName": "__name"}, order)
    names = named.groupBy("__set").agg(
        F.map_from_entries(F.collect_set(F.struct("__code", "__name"))).alias("__names")
    )
    stops = F.transform(
        rows,
        lambda s: F.struct(
            F.when(s[code].isNotNull(), F.col("__names")[s[code]]).alias("stationName"),
            *[s[f].alias(f) for f in fields],
        ),
    )
    joined = keyed.join(names, "__set", "left")
    return joined.select(*[_once(stops).alias(rows) if c == rows else F.col(c) for c in trains.columns])


def add_nested_offsets(trains: DataFrame, rows: str = ROWS) -> DataFrame:
    """Both delay offsets, right after the delay of every stop.

    Works inside the row, so trains are not shuffled.
    """
    record = trains.schema[rows].dataType.elementType
    none = F.lit(0).cast(record[DELAY].dataType)
    origin = F.get(F.col(rows), F.lit(0))[DELAY]

    def offsets(stop: Column, i: Column) -> Column:
        now = stop[DELAY]
        # mostly the stop before knows it, and the list need not be searched
        last = F.get(F.col(rows), i - 1)[DELAY]
        seen = F.array_compact(F.slice(F.col(rows)[DELAY], F.lit(1), i - 1))
        before = F.coalesce(last, F.when(i > 1, F.try_element_at(seen, F.lit(-1))), none)
        from_origin = now - F.when(i > 0, F.coalesce(origin, none)).otherwise(none)
        out = []
        for f in record.fieldNames():
            out.append(stop[f].alias(f))
            if f == DELAY:
                out.append(from_origin.alias(DELAY_FROM_ORIGIN))
                out.append((now - before).alias(DELAY_FROM_PREVIOUS))
        return F.struct(*out)

    return trains.withColumn(rows, F.transform(rows, offsets))


def add_offsets(
    stops: DataFrame,
    keys: Sequence[str],
    idx: str = "idx",
    delay: str = "diff",
    from_origin: str = "diff_offset",
    from_previous: str = "diff_each",
    block: int = STOPS_PER_BLOCK,
) -> DataFrame:
    """Both delay offsets on flat stops whose ``idx`` starts at 0.

    From origin: minus the first stop's delay, if it has one. From previous:
    minus the last earlier delay that is present. A missing delay stays missing.
    Trains are cut into blocks of stops; what a block needs from earlier ones
    comes from a summary with one row per block, so a long train is not one task.
    """
    keys = list(keys)
    cut = stops.withColumn("__block", ((F.col(idx) - F.pmod(F.col(idx), F.lit(block))) / block).cast("long"))
    present = F.when(F.col(delay).isNotNull(), F.col(idx))
    summary = cut.groupBy(*keys, "__block").agg(
        F.max(F.when(F.col(idx) == 0, F.col(delay))).alias("__origin"),
        F.max_by(delay, present).alias("__last"),
    )
    earlier = W.partitionBy(*keys).orderBy("__block")
    summary = summary.select(
        *keys,
        "__block",
        F.max("__origin").over(earlier.rowsBetween(W.unboundedPreceding, 0)).alias("__origin"),
        F.last("__last", ignorenulls=True)
        .over(earlier.rowsBetween(W.unboundedPreceding, -1))
        .alias("__carried"),
    )
    w = W.partitionBy(*keys, "__block").orderBy(idx)
    now = F.col(delay)
    local = F.last(delay, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    before = F.coalesce(local, F.col("__carried"))
    origin = F.col("__origin")
    return (
        cut.join(summary, [*keys, "__block"])
        .select(
            *stops.columns,
            F.when((F.col(idx) == 0) | origin.isNull(), now).otherwise(now - origin).alias(from_origin),
            F.when(before.isNull(), now).otherwise(now - before).alias(from_previous),
        )
    )


def ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Column, name: str = "idx"
) -> DataFrame:
    """Position (from 0) of each row within its key.

    ``split`` must not decrease along ``order``; it cuts a key into parts that
    are numbered on their own and then moved by the size of earlier parts.
    """
    keys = list(keys)
    parts = df.withColumn("__part", split)
    sizes = parts.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__size"))
    earlier = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        *keys, "__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__base")
    )
    within = F.row_number().over(W.partitionBy(*keys, "__part").orderBy(*order))
    return parts.join(sizes, [*keys, "__part"]).select(
        *df.columns, (F.col("__base") + within - 1).cast("int").alias(name)
    )
