"""Mixing sources to target weights along a time-varying curriculum.

Only DataFrame functions. Every source gets a word target and a weight schedule
over training time 0..1. The integral of the schedule, scaled to the target, is
the source's cumulative word demand; a document whose words lie at ``c`` in the
source's own (hashed) order is trained on when the demand reaches ``c``. Sorting
all copies by that time is the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitwx.session import stage

#: A word of the size: `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MAX_EPOCHS = 3
#: Weight of a source relative to its target at times 0, 1/2 and 1, by its place
#: among the sources: rising, level, falling, repeating.
SCHEDULES = ((0.5, 1.0, 1.5), (1.0, 1.0, 1.0), (1.5, 1.0, 0.5))
#: A source's documents are put in order in so many pieces, whatever its share.
PIECES = 4096
#: Share of the order's key space: 32 bits of md5(doc_id).
KEYS = 1 << 32


def order_key(doc_id: Column) -> Column:
    """A document's place in its source's order, as an integer below 2**32."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 by code point, null last, without a global window.

    Ranges of names are counted apart; the counts, one row for each of at most
    ``spark.sql.shuffle.partitions`` ranges, shift the ranks within the ranges.
    """
    dealt = stage(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    shift = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("rank", inside).join(shift, "part").withColumn("rank", F.col("rank") + F.col("shift")).drop("part", "shift")


def targets(sources: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """Add ``weight`` and ``target``: shares of all words by weight, stopped at
    ``max_epochs`` times the source's words, the excess reshared by weight until
    none is above. Each round is one sum over the sources table."""
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(sources.withColumn("weight", weight), "weights")
    limit = max_epochs * F.col("source_size")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = None
    while True:
        stopped = F.lit(False) if level is None else limit <= F.col("weight") * F.lit(level)
        held, free = table.agg(
            F.coalesce(F.sum(F.when(stopped, limit)), F.lit(0)), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        if not free:
            break
        new = float(total - held) / float(free)
        if level is not None and new <= level:
            break
        level = new
    share = F.col("weight") * F.lit(level or 0.0)
    return table.withColumn("target", F.least(limit.cast("double"), share))


def demand_time(done: Column, knots: Column) -> Column:
    """The time at which the share ``done`` (0..1) of a schedule's integral is
    reached; ``knots`` are weights at evenly spaced times, positive somewhere.

    The integral is quadratic between knots; the piece that reaches ``done`` is
    found from the running integrals and inverted in closed form.
    """
    n = F.size(knots) - 1
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (knots[i] + knots[i + 1]) / 2 / n)
    whole = F.aggregate(pieces, F.lit(0.0), lambda a, x: a + x)
    reached = F.transform(
        F.sequence(F.lit(0), n), lambda i: F.aggregate(F.slice(pieces, 1, i), F.lit(0.0), lambda a, x: a + x)
    )
    want = done * whole
    piece = F.greatest(F.size(F.filter(F.slice(reached, 1, n), lambda r: r <= want)), F.lit(1)) - 1
    left = (want - reached[piece]) * n
    a, b = knots[piece], knots[piece + 1]
    root = a + F.sqrt(F.greatest(a * a + 2 * (b - a) * left, F.lit(0.0)))
    inside = F.when(root > 0, 2 * left / root).otherwise(F.lit(0.0))
    return F.when(whole > 0, F.least((piece + F.least(inside, F.lit(1.0))) / n, F.lit(1.0))).otherwise(F.lit(0.0))


def words_in(text: Column) -> Column:
    """Number of words; null has none."""
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken,
    position``.

    ``taken`` counts the words the mix takes, repeats included: whole passes over
    the source and then its documents in order until the target, rounded to a
    word, is met; the document at the end is taken in part. ``position`` is the
    training time of its first word, null if none is taken.

    Null and empty texts have size 0 and nothing is taken. A null source is a
    source of its own, the last one. Repeated ids are documents of their own;
    equal rows share whatever order Spark gives them, with the same sums. An
    empty table gives an empty result.
    """
    size = words_in(F.col(text_col))
    sized = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            size.alias("size"),
            order_key(F.col(id_col)).alias("key"),
        ).withColumn("piece", F.floor(F.col("key") * PIECES / KEYS).cast("int")),
        "sizes",
    )
    pieces = stage(sized.groupBy("source", "piece").agg(F.sum("size").alias("words")), "pieces")
    sources = pieces.groupBy("source").agg(F.sum("words").alias("source_size"))
    goals = targets(ranked_sources(sources), weights, max_epochs)
    knots = F.element_at(
        F.array(*(F.array(*(F.lit(float(w)) for w in s)) for s in schedules)),
        (F.col("rank") % len(schedules) + 1).cast("int"),
    )
    before = F.sum("words").over(Window.partitionBy("source").orderBy("piece")) - F.col("words")
    goals = goals.select(F.col("source").alias("s"), "source_size", "target", knots.alias("knots"))
    offsets = (
        pieces.withColumn("offset", before)
        .join(goals, F.col("source").eqNullSafe(F.col("s")))
        .select("s", F.col("piece").alias("p"), "offset", "source_size", "target", "knots")
    )
    within = Window.partitionBy("source", "piece").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
        .withColumn("start", F.col("offset") + F.col("inside"))
    )
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    rest = goal - passes * F.col("source_size")
    part = F.greatest(F.least(rest - F.col("start"), F.col("size")), F.lit(0))
    taken = (passes * F.col("size") + part).cast("long")
    time = demand_time(F.col("start") / F.col("target"), F.col("knots"))
    return placed.withColumn("taken", taken).select(
        "doc_id", "source", "size", "source_size", "target", "taken", F.when(F.col("taken") > 0, time).alias("position"), "start", "knots"
    )


def training_order(plan: DataFrame, *others: str) -> DataFrame:
    """One row per copy of a document, range-sorted by training position:
    ``doc_id, source, copy, size, words, position`` and ``others`` of the plan's
    columns. Only the last copy is in part."""
    copies = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("taken") / F.col("size")).cast("int"), F.lit(1)) - 1)
    rows = plan.where("taken > 0").withColumn("copy", F.explode(copies))
    done = (F.col("start") + F.col("copy") * F.col("source_size")) / F.col("target")
    return (
        rows.withColumn("words", F.least(F.col("taken") - F.col("copy") * F.col("size"), F.col("size")))
        .withColumn("position", demand_time(F.least(done, F.lit(1.0)), F.col("knots")))
        .select("doc_id", "source", "copy", "size", "words", "position", *others)
        .orderBy("position", "doc_id", "copy")
    )
