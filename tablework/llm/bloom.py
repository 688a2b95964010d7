"""Blocked Bloom filter in DataFrame functions.

A block is 256 bits, kept as four longs; a key sets one bit in each of its
block's eight 32-bit words, so a look-up touches one row of the filter.  The
filter is a table (block, w0..w3) built by ``bit_or``; it is broadcast while
its size, which follows from the number of keys, is within a bound, and
joined on the block number otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import BROADCAST_BYTES

BITS_PER_KEY = 16
BLOCK_BITS = 256
BLOCK_BYTES = 64          # a row of the filter in memory: number, four words, overhead
WORDS = ["w0", "w1", "w2", "w3"]


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def masks(key: Column) -> list[Column]:
    """Four longs with two bits each, one in either half."""
    h = F.xxhash64(F.lit(17), key)

    def bit(i):
        return F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")

    def one(n):                                    # shiftleft by a column
        return F.call_function("shiftleft", F.lit(1).cast("long"), n)

    return [one(bit(2 * j)).bitwiseOR(one(bit(2 * j + 1) + 32)) for j in range(4)]


def build(keys: DataFrame, key: str, count: int, bits_per_key: int = BITS_PER_KEY) -> tuple[DataFrame, int]:
    """(filter table, number of blocks) over ``count`` distinct keys."""
    blocks = max(1, math.ceil(count * bits_per_key / BLOCK_BITS))
    table = (keys.select(block_of(F.col(key), blocks).alias("block"),
                         *[m.alias(w) for m, w in zip(masks(F.col(key)), WORDS)])
             .groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS]))
    return table, blocks


def probe(df: DataFrame, key: Column, table: DataFrame, blocks: int, flag: str = "maybe",
          bound: int = BROADCAST_BYTES) -> DataFrame:
    """df with a boolean column: false if the key is surely not in the filter
    (null keys are not), true if it may be."""
    words = table.withColumnsRenamed({w: f"_{w}" for w in WORDS} | {"block": "_block"})
    if blocks * BLOCK_BYTES <= bound:
        words = F.broadcast(words)
    hit = F.lit(True)
    for m, w in zip(masks(key), WORDS):
        hit = hit & (F.col(f"_{w}").bitwiseAND(m) == m)
    return (df.withColumn("_probe", block_of(key, blocks))
            .join(words, F.col("_probe") == F.col("_block"), "left")
            .withColumn(flag, F.coalesce(hit & key.isNotNull(), F.lit(False)))
            .drop("_probe", "_block", *[f"_{w}" for w in WORDS]))
