"""Sharding by jump consistent hashing, in column expressions only.

A 64-bit generator seeded with the key draws the shard counts at which the key would move;
the last one below the number of shards is its shard. No ring and no table is kept, and one
shard more takes rows only into itself, a fraction of one in the new number.

Signed 64-bit columns refuse to overflow, so the generator's product modulo 2^64 is built
from two 32-bit halves.

Slots are places inside a shard, counted without gaps from 0. Rows that agree in all
returned columns are counted before any shuffle, so copies under one key are one row there,
whatever their number; each shard is numbered in chunks by key and text, whose offsets are added, so a
key with a third of all rows and different texts is many chunks of its shard.

Null texts have no bytes. A null key is hashed as 0 and stays null. Repeated rows get slots
of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from homeledger.session import cut_lineage

MULTIPLIER = 2862933555777941757  # fixed value of the published generator
LOW, HALF = 0xFFFFFFFF, 0xFFFF
CHUNK_ROWS = 200_000
MOST_CHUNKS = 1024  # per shard
BLOCK = 4096  # equal rows given out at a time


def _times(a: Column, b: int) -> Column:
    """a * b modulo 2^32, of two 32-bit numbers."""
    high = (a * F.lit(b >> 16)).bitwiseAND(HALF)
    return (a * F.lit(b & HALF) + F.shiftleft(high, 16)).bitwiseAND(LOW)


def _draw(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next state, as two 32-bit halves."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & LOW
    upper, lower = F.shiftright(low, 16) * F.lit(m_low), low.bitwiseAND(HALF) * F.lit(m_low)
    joined = F.shiftleft(upper.bitwiseAND(HALF), 16) + lower + F.lit(1)
    carry = F.shiftright(upper, 16) + F.shiftright(joined, 32)
    return (carry + _times(high, m_low) + _times(low, m_high)).bitwiseAND(LOW), joined.bitwiseAND(LOW)


def _halves(key: Column) -> tuple[Column, Column]:
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(LOW)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of an integer key."""
    high, low = _halves(key)
    begin = F.struct(high.alias("h"), low.alias("l"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))

    def step(s: Column, _: Column) -> Column:
        h, l = _draw(s["h"], s["l"])
        drawn = (F.shiftright(h, 1) + F.lit(1)).cast("double")  # the state's upper 31 bits
        jump = F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(2147483648.0) / drawn)).cast("bigint")
        return F.when(s["j"] >= F.lit(shards), s).otherwise(
            F.struct(h.alias("h"), l.alias("l"), s["j"].alias("b"), jump.alias("j")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), begin, step, lambda s: s["b"].cast("int"))


def chunk_of(key: Column, size: Column, crc: Column, chunks: int) -> Column:
    """Chunk of a row inside its shard: the upper bits of its key's third draw, moved on by its text, so that
    rows of one key and different texts are spread."""
    state = _halves(key)
    for _ in range(3):
        state = _draw(*state)
    return ((F.shiftright(state[0], 1) + size + crc) % F.lit(chunks)).cast("int")


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """Per row: key, size, text_crc32, law, shard, slot and the shard if there were one more."""
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    counted = cut_lineage(
        docs.select(key, (F.octet_length(body).cast("bigint") + F.lit(overhead)).alias("size"), F.crc32(body).alias("text_crc32"))
        .groupBy(key, "size", "text_crc32").agg(F.count("*").alias("n")), "shards")
    rows = counted.agg(F.sum("n")).first()[0] or 0
    chunks = min(MOST_CHUNKS, max(1, -(-rows // (shards * CHUNK_ROWS))))
    placed = counted.withColumns({
        "shard": jump_shard(F.col(key), shards), "grown_shard": jump_shard(F.col(key), shards + 1),
        "chunk": chunk_of(F.col(key), F.col("size"), F.col("text_crc32"), chunks)})
    chunk_sizes = placed.groupBy("shard", "chunk").agg(F.sum("n").alias("n"))  # at most shards * MOST_CHUNKS rows
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = chunk_sizes.select("shard", "chunk", before(Window.partitionBy("shard").orderBy("chunk")).alias("offset"))
    inside = Window.partitionBy("shard", "chunk").orderBy(F.col(key).asc_nulls_first(), "size", "text_crc32")
    blocks = (
        placed.withColumn("at", before(inside)).join(F.broadcast(offsets), ["shard", "chunk"])
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / BLOCK).cast("bigint")))))
    left = F.least(F.col("n") - F.col("block") * BLOCK, F.lit(BLOCK).cast("bigint"))
    return (
        blocks.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), left - 1)))
        .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                (F.col("offset") + F.col("at") + F.col("block") * BLOCK + F.col("i")).alias("slot"), "grown_shard"))
