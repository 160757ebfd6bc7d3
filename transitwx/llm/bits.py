"""Tables of bits that tell most rows apart from a set of keys without a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, and powers of two between which the table's size lies: 4 KB to 64 MB.
PER_KEY = 16
LEAST, MOST = 15, 29
#: Bits of one row of the table.
CHUNK = 15


def own_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _place(key: Column, power: int) -> Column:
    return F.xxhash64(key.cast("long")).bitwiseAND((1 << power) - 1)


def bit_array(keys: DataFrame, name: str) -> np.ndarray:
    """The bits of a table of distinct 64-bit hashes, whose last bits are the places,
    as bytes: what comes to the driver is 4 KB to 64 MB."""
    power = min(MOST, max(LEAST, (PER_KEY * keys.count()).bit_length()))
    at = F.col(name).bitwiseAND((1 << power) - 1)
    out = np.zeros((1 << power) // 8, np.uint8)
    for r in _chunks(keys, at).collect():
        lo = r["__chunk"] << (CHUNK - 3)
        out[lo : lo + len(r["__bits"])] = np.frombuffer(r["__bits"], np.uint8)
    return out


def _chunks(keys: DataFrame, at: Column) -> DataFrame:
    table = keys.select(F.shiftright(at, CHUNK).alias("__chunk"), at.bitwiseAND((1 << CHUNK) - 1).alias("__bit"))
    return table.groupBy("__chunk").agg(F.bitmap_construct_agg("__bit").alias("__bits"))


def in_bits(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, str]:
    """``df`` and a new column, and its name: false where ``key`` is not in ``keys``
    (one column, best a written table), true where it is and, for up to one key in
    sixteen, where it isn't. Null is a key like others.

    The set is sent to every task as a table of bits of at most 64 MB. Beyond 33
    million keys it says true more often; whoever asks has to look at those rows.
    """
    name = keys.columns[0]
    power = min(MOST, max(LEAST, (PER_KEY * keys.count()).bit_length()))
    table = _chunks(keys, _place(F.col(name), power))
    chunk, bits, flag = (own_name(df, n) for n in ("__chunk", "__bits", "__maybe"))
    table = table.withColumnsRenamed({"__chunk": chunk, "__bits": bits})
    here = _place(F.col(f"`{key}`"), power)
    bit = here.bitwiseAND((1 << CHUNK) - 1)
    joined = df.withColumn(chunk, F.shiftright(here, CHUNK)).join(F.broadcast(table), chunk, "left")
    byte = F.conv(F.hex(F.substr(F.col(bits), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1
    return joined.withColumn(flag, F.coalesce(held, F.lit(False))).drop(chunk, bits), flag


def without(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``keys``. Only rows that the bits
    can't clear take part in the join."""
    known, flag = in_bits(df, key, keys)
    other = own_name(known, "__key")
    left = known.where(F.col(flag)).join(
        keys.select(F.col(keys.columns[0]).alias(other)), F.col(f"`{key}`").cast("long").eqNullSafe(F.col(other)), "left_anti"
    )
    return known.where(~F.col(flag)).unionByName(left).drop(flag)


def only(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys``, by the same means."""
    known, flag = in_bits(df, key, keys)
    other = own_name(known, "__key")
    return known.where(F.col(flag)).drop(flag).join(
        keys.select(F.col(keys.columns[0]).alias(other)), F.col(f"`{key}`").cast("long").eqNullSafe(F.col(other)), "left_semi"
    )
