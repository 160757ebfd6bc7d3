"""Result tables on shared storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitwx.functions.curve import interleave, slice_of

#: Columns of a clustered table are cut into 2^SLICE_BITS parts of about equal rows.
SLICE_BITS = 6


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> bool:
    """Write the table unless it is empty; says whether it was written."""
    if df.isEmpty():
        return False
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(fmt).save(path)
    return True


def write_monthly(
    df: DataFrame,
    path: str,
    month: str,
    fmt: str = "parquet",
    sort: Sequence[str] = (),
    max_rows_per_file: int = 5_000_000,
) -> None:
    """Write into ``year=/month=`` folders; only months in ``df`` are replaced.

    Rows of a month go to few files, and a month that is too big for one task
    is split by adaptive execution (a rebalance, not a plain repartition).
    Sorting within a file keeps its statistics useful for later reads.
    """
    keyed = df.withColumn("year", F.year(month)).withColumn("month", F.month(month))
    spread = keyed.hint("rebalance", "year", "month")
    if sort:
        spread = spread.sortWithinPartitions("year", "month", *sort)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("year", "month")
        .format(fmt)
        .save(path)
    )


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", max_rows_per_file: int = 5_000_000
) -> None:
    """Write so that a filter on any of the columns ``by`` (numbers, dates, times)
    or on several at once finds its rows in few files.

    Each column is cut at its quantiles, the slice numbers are interleaved to one
    key and the files are ranges of it, so the statistics that a file keeps span a
    small box. Rows of one key are ranged by the columns themselves, which splits
    crowded boxes. The quantiles take one pass over ``by``, ranging another over
    ``df``, so hand in a table rather than a long plan. Nulls come first. The
    number of files is left to adaptive execution.
    """
    share = [i / (1 << SLICE_BITS) for i in range(1, 1 << SLICE_BITS)]
    number = {c: _as_double(df, c) for c in by}
    quantiles = df.agg(*(F.percentile_approx(number[c], share, 10_000).alias(c) for c in by)).first()
    cuts = {c: sorted(set(quantiles[c] or [])) for c in by}
    taken = set(df.columns)
    key = next(k for k in (f"__curve{i}" for i in range(len(taken) + 1)) if k not in taken)
    keyed = df.withColumn(key, interleave([slice_of(number[c], cuts[c]) for c in by], SLICE_BITS))
    (
        keyed.repartitionByRange(key, *by)
        .sortWithinPartitions(key, *by)
        .drop(key)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows_per_file)
        .format(fmt)
        .save(path)
    )


def _as_double(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    return (value.cast("timestamp") if kind in ("date", "timestamp_ntz") else value).cast("double")


def preview(df: DataFrame, order: Sequence[str], rows: int = 10) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)
