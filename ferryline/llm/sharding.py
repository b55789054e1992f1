"""Shards of bounded size by extendible hashing.

A directory is indexed by the first bits of a hash of the key. A bucket with more bytes than a
shard may have is split on its next bit, and only such buckets are; the others stay as they are.
So a shard is the shortest prefix whose rows fit.

Sizes are first summed for prefixes of ``LEVEL_BITS`` bits, and depths are found on those sums.
Prefixes that are still too large go on with the next bits, their rows only. Rows left after
``MAX_BITS`` bits have equal keys; they get further random bits, written once, so that repeated
keys fit too. A single row above the limit is a shard of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.runtime import materialize

LEVEL_BITS = 16
MAX_BITS = 64


def hash_bits(key: Column) -> Column:
    """64 bits of the MD5 of the key's text, as a string of 0 and 1. NULL is hashed as an empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    part = lambda at: F.lpad(F.conv(F.substring(digest, at, 8), 16, 2), 32, "0")
    return F.concat(part(1), part(9))


def _depths(sizes: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """``prefix`` (of ``high`` bits), ``shard`` and its ``shard_bytes``; no shard where ``high`` bits are too few."""
    spread = sizes.select("prefix", "bytes", "rows", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    spread = spread.withColumn("shard", F.expr("substring(prefix, 1, depth)"))
    fit = spread.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("n"))
    fit = fit.where((F.col("shard_bytes") <= limit) | (F.col("n") == 1))
    found = spread.join(fit, ["depth", "shard"]).groupBy("prefix").agg(F.min(F.struct("depth", "shard", "shard_bytes")).alias("best"))
    return sizes.select("prefix").join(found, "prefix", "left").select("prefix", "best.shard", "best.shard_bytes")


def assign_shards(rows: DataFrame, key: str, size: str, limit: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``shard`` (its bits, empty for the only shard), ``depth`` and ``shard_bytes``.

    ``size`` names the column of bytes; NULL counts as 0. No shard has more than ``limit`` bytes,
    unless it is a single row. One row for each input row; no row gives no shard.
    """
    left = rows.select(F.struct(*keep).alias("kept_columns"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("bytes"), hash_bits(F.col(key)).alias("bits"))
    done, low, bits = None, 0, MAX_BITS
    while True:
        high = low + LEVEL_BITS
        level = left.withColumn("prefix", F.substring("bits", 1, high))
        sizes = materialize(level.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")), "shard-sizes")
        depths = materialize(_depths(sizes, low, high, limit), "shard-depths")
        placed = level.join(depths, "prefix").drop("prefix")
        part = placed.where("shard IS NOT NULL")
        done = part if done is None else done.unionByName(part)
        if depths.where("shard IS NULL").isEmpty():
            break
        left, low = placed.where("shard IS NULL").drop("shard", "shard_bytes"), high
        if low == bits:
            more = F.lpad(F.conv(F.floor(F.rand() * 2**32).cast("string"), 10, 2), 32, "0")
            left, bits = materialize(left.withColumn("bits", F.concat("bits", more)), "shard-rest"), bits + 32
    return done.select("kept_columns.*", "shard", F.length("shard").alias("depth"), "shard_bytes")


def directory(shards: DataFrame) -> DataFrame:
    """The directory: every prefix of the greatest depth and the shard it points to."""
    each = shards.select("shard", "depth").distinct()
    depth = each.agg(F.max("depth").alias("full"))
    return each.join(F.broadcast(depth)).select(
        F.explode(
            F.when(
                F.col("full") > F.col("depth"),
                F.transform(
                    F.expr("sequence(0L, shiftleft(1L, full - depth) - 1)"),
                    lambda i: F.concat("shard", F.lpad(F.conv(i.cast("string"), 10, 2), F.col("full") - F.col("depth"), F.lit("0"))),
                ),
            ).otherwise(F.array("shard"))
        ).alias("prefix"),
        "shard",
    )
