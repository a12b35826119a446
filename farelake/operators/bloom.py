"""Bloom filters of key columns, as small tables of bitmaps that Spark builds and probes with its own functions.

A filter has no false negatives: what it has not seen is not there. Some one in five thousand keys is taken for seen. All bits of
a key lie in one bitmap, so a key is one small row (bitmap, hash) for building and for asking, and a bitmap is put together in one
place instead of once in every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

HASHES = 4
BITS_PER_KEY = 32
LAYOUT = 2  # of the bits of a key; a filter of another layout cannot be asked
BUCKET = 32_768  # fixed value: bits of one of Spark's bitmaps


def size(keys: int) -> int:
    """Bits of a filter for so many keys, in whole bitmaps."""
    return max(1, -(-keys * BITS_PER_KEY // BUCKET)) * BUCKET


def _placed(columns: list[str], bits: int) -> list[Column]:
    """The bitmap of a key and the hash that holds its places in there, 15 bits each."""
    return [F.pmod(F.xxhash64(*columns), F.lit(bits // BUCKET)).cast("int").alias("bucket"), F.xxhash64(*columns, F.lit(1)).alias("hash")]


def _positions() -> list[Column]:
    """Bits of a key in its bitmap, from 0."""
    return [F.shiftrightunsigned("hash", 15 * i).bitwiseAND(F.lit(BUCKET - 1)).cast("int") for i in range(HASHES)]


def build(df: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """The filter of the keys of ``df``: bucket, bitmap. A key is moved once, the bitmaps are not."""
    placed = df.select(*_placed(columns, bits)).repartition("bucket")
    bits_set = placed.select("bucket", F.explode(F.array(*_positions())).alias("at"))
    return bits_set.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def seen(df: DataFrame, columns: list[str], built: DataFrame, bits: int) -> DataFrame:
    """The keys of ``df``, repeats included, that the filter has seen."""
    asked = df.select(*columns, *_placed(columns, bits))
    bit = "shiftright(cast(conv(hex(substr(bitmap, {0} div 8 + 1, 1)), 16, 10) AS int), {0} % 8) & 1 = 1"
    at = ["cast(shiftrightunsigned(hash, %d) & %d AS int)" % (15 * i, BUCKET - 1) for i in range(HASHES)]
    return asked.join(built, "bucket").where(" AND ".join(bit.format(a) for a in at)).select(*columns)


def may_hold(df: DataFrame, columns: list[str], built: DataFrame, bits: int) -> DataFrame | None:
    """The keys of ``df`` that the filter has seen, written down so that they are known to be few; None if there are none."""
    keys = stored(seen(df, columns, built, bits), "asked")
    return None if keys.isEmpty() else keys
