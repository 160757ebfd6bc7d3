"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are one group. Groups too large for a shard are split by
id; groups of ordinary size are packed as they are; the many groups far smaller
than a shard go together, by hash, into blocks that are packed like groups, so
that the number of items to pack is bounded by the shards, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitwx.session import stage

ROW_BYTES = 16
#: Blocks of small groups per shard; also, a group of over 1/BLOCKS of a shard
#: is an item of its own. At most 2 * BLOCKS * shards items plus the pieces of
#: split groups are packed, for very many shards about 2 * ITEMS.
BLOCKS = 256
ITEMS = 200_000
#: Rows of one item that are numbered together.
UNIT_ROWS = 4096


class Room:
    """Bins by remaining room in a treap: a balanced search tree of (room, bin)."""

    def __init__(self):
        self.root = None
        self.seed = 1

    def add(self, key: tuple[int, int]) -> None:
        self.seed = self.seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.seed, None, None]), right)

    def remove(self, key: tuple[int, int]) -> None:
        left, rest = self._split(self.root, key)
        _, right = self._split(rest, (key[0], key[1] + 1))
        self.root = self._merge(left, right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least room that holds ``size``."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def widest(self) -> tuple[int, int]:
        node = self.root
        while node[3]:
            node = node[3]
        return node[0]

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return [a[0], a[1], a[2], self._merge(a[3], b)]
        return [b[0], b[1], self._merge(a, b[2]), b[3]]


def best_fit(sizes: Iterable[int], capacity: int, bins: int | None = None) -> Iterator[int]:
    """Bin of each item of a falling list of sizes.

    An item enters the bin with the least room that holds it, else a new bin.
    With ``bins`` given no more are opened: what fits nowhere enters the bin with
    the most room.
    """
    room = Room()
    opened = 0
    for size in sizes:
        at = room.tightest(size)
        if at is None and (bins is None or opened < bins):
            at = (max(capacity, size), opened)
            opened += 1
        elif at is None:
            at = room.widest()
            room.remove(at)
        else:
            room.remove(at)
        room.add((at[0] - size, at[1]))
        yield at[1]


def even_share(sizes: list[int], shards: int) -> int:
    """Capacity at which a falling list of sizes fills the shards: the even share
    of what is left when items larger than it have shards of their own."""
    rest, alone = sum(sizes), 0
    while alone < min(shards - 1, len(sizes)) and sizes[alone] * (shards - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    return max(1, math.ceil(rest / (shards - alone)))


def shard(
    docs: DataFrame,
    shards: int | None = None,
    capacity: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 16. With ``shards``
    the capacity is their even share, so that sizes come out near equal; with
    ``capacity`` as few shards as best fit decreasing finds are opened. Equal
    texts stay in one shard: a group larger than a shard has one of its own, which
    exceeds the others by what the group has too much, and the others share the
    rest evenly. ``slot`` numbers the rows of a shard from 0 without gaps.

    Null texts are a group of their own with checksum 0. Repeated rows are rows
    of their own. An empty table gives an empty result.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    text = F.col(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("null")).alias("text_key"),
        ),
        "rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = capacity or max(1, math.ceil(total / shards))
    bins = shards or math.ceil(total / capacity)
    blocks = max(8, min(BLOCKS, ITEMS // max(1, bins)))
    small = max(1, capacity // blocks)
    count = F.count("*").alias("rows")
    groups = stage(rows.groupBy("text_key").agg(F.sum("size").alias("bytes"), count), "groups")
    large = groups.where(F.col("bytes") > small).select("text_key", F.col("rows").alias("rows_of"))
    # groups of over 1/blocks of a shard: at most bins * blocks of them
    keyed = rows.join(F.broadcast(large) if bins * blocks <= ITEMS else large, "text_key", "left")
    keyed = keyed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.when(
            F.col("rows_of").isNull(),
            F.format_string("block-%d", F.pmod(F.xxhash64("text_key"), F.lit(max(1, bins) * blocks))),
        )
        .otherwise(F.col("text_key"))
        .alias("item"),
        F.when(F.col("rows_of").isNull(), 0)
        .otherwise(F.pmod(F.xxhash64("doc_id", F.lit("unit")), F.ceil(F.col("rows_of") / UNIT_ROWS)))
        .alias("unit"),
    )
    keyed = stage(keyed, "items")
    units = stage(keyed.groupBy("item", "unit").agg(F.sum("size").alias("bytes"), count), "units")
    # bounded by the shards, see BLOCKS
    items = units.groupBy("item").agg(F.sum("bytes").alias("bytes")).collect()
    items.sort(key=lambda r: (-r["bytes"], r["item"]))
    sizes = [r["bytes"] for r in items]
    found = best_fit(sizes, even_share(sizes, shards) if shards else capacity, shards)
    placed = docs.sparkSession.createDataFrame(
        [(r["item"], b) for r, b in zip(items, found, strict=True)], "item string, shard int"
    )
    # slots: rows of earlier units of the shard, then the place in the unit
    units = units.join(placed, "item")
    earlier = Window.partitionBy("shard").orderBy("item", "unit").rowsBetween(Window.unboundedPreceding, -1)
    units = units.select("item", "unit", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("item", "unit").orderBy("doc_id", "text_crc32", "size")) - 1
    return (
        keyed.withColumn("inside", inside)
        .join(units, ["item", "unit"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"))
    )
