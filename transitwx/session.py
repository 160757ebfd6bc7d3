"""Session settings the library relies on, and its scratch folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: With it Spark drops the shuffle files of a query when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_run: ContextVar[list[str] | None] = ContextVar("run", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Check what results depend on; the session itself is the caller's to set."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; times are read and written in UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else one in the
    warehouse, which all executors reach as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that no earlier run has used."""
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    made = _run.get()
    if made is not None:
        made.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """The file system that a path names, and the path as it takes it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system the path names."""
    fs, where = file_system(spark, path)
    return fs.exists(where)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Remove at its end all scratch folders asked for inside.

    For a job that writes its results: tables it has staged can't be read later.
    """
    made: list[str] = []
    token = _run.set(made)
    try:
        yield
    finally:
        _run.reset(token)
        for p in made:
            fs, path = file_system(spark, p)
            fs.delete(path, True)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind."""
    # None: not set, which says nothing about Spark's own default
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the table once on shared storage and go on from there.

    For a result that several later steps read: it is not worked out again, a
    lost executor does not send the job back to the beginning, and the shuffle
    files of the step go.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with tidy_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
