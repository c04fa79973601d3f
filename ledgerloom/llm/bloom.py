"""Blocked Bloom filters as small tables, built and asked with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8  # of 64 bits in a block
PROBES = 6


def _probe(key: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a key, and its bits from 0 to 511 in it."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    return block, F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64 * WORDS)).cast("int") for i in range(PROBES)])


def bloom_blocks(keys: DataFrame, key: Column, blocks: int) -> DataFrame:
    """(block, words): the filter's non-empty blocks, `blocks` rows of 64 bytes at most."""
    block, bits = _probe(key, blocks)
    set_ = keys.select(block.alias("block"), F.explode(bits).alias("bit"))
    word = F.expr("bit_or(shiftleft(1L, bit % 64))")
    words = set_.groupBy("block", (F.col("bit") / 64).cast("int").alias("word")).agg(word.alias("value"))
    filled = [F.coalesce(F.max(F.when(F.col("word") == i, F.col("value"))), F.lit(0).cast("long")) for i in range(WORDS)]
    return words.groupBy("block").agg(F.array(*filled).alias("words"))


def _asked(rows: DataFrame, key: Column, filter_: DataFrame, blocks: int, how: str) -> tuple[DataFrame, Column]:
    block, bits = _probe(key, blocks)
    asked = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), block.alias("block"), bits.alias("bits"))
    is_set = F.expr("forall(bits, b -> (shiftright(words[cast(b / 64 as int)], b % 64) & 1L) = 1L)")
    return asked.join(F.broadcast(filter_), "block", how), is_set


def possible(rows: DataFrame, key: Column, filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and a few others. The filter is broadcast, which its number
    of blocks bounds at 64 bytes each."""
    asked, is_set = _asked(rows, key, filter_, blocks, "inner")
    return asked.where(is_set).select("row.*")


def impossible(rows: DataFrame, key: Column, filter_: DataFrame, blocks: int) -> DataFrame:
    """All other rows: their key is not in the filter."""
    asked, is_set = _asked(rows, key, filter_, blocks, "left")
    return asked.where(F.col("words").isNull() | ~is_set).select("row.*")
