"""Sharding by extendible hashing: a directory over the first bits of a hash, split only where a bucket is too large."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.work import Scratch, fresh

#: Bits of the key's hash that the directory may use: 15 hex digits of an MD5.
BITS = 60


def hash_bits(key: Column) -> Column:
    """The key's hash as a whole number of 60 bits; a NULL key hashes as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def _prefix(depth) -> Column:
    return F.expr(f"shiftright(hash, {BITS} - {depth})") if isinstance(depth, (int, str)) else None


def extendible_shards(df: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Columns key, bytes, hash, depth, prefix, shard_bytes, oversized for every row of df.

    A bucket is the set of rows whose hash starts with the same `depth` bits (`prefix`). The root has depth 0. A
    bucket over `limit` bytes splits on one more bit, until each holds the limit or its rows share all 60 bits (one
    key, however often repeated, or one row over the limit): these stay whole, marked oversized. Empty halves are no
    shards. NULL sizes count 0 bytes; no rows give no rows. Columns of df beside the key aren't read.

    Sizes are summed on the first `fine` bits, chosen so that a fine bucket is expected to hold 1/64 of the limit;
    all splits above that depth are rolled up from these sums. Rows of fine buckets that are still over the limit go
    on alone, 8 bits at a time. Splitting stops where a bucket holds a single hash. No text is shuffled.
    """
    work = Scratch(df.sparkSession, "shards")
    rows = work.save(df.select(F.col(key).alias("key"), F.coalesce(size.cast("bigint"), F.lit(0)).alias("bytes"), hash_bits(F.col(key)).alias("hash")), "rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    fine = min(40, max(1, math.ceil(math.log2(max(1, total / max(1, limit)))) + 6))
    done, rest, above = None, rows, 0
    while True:
        sums = work.save(rest.groupBy(_prefix(fine).alias("fine")).agg(F.sum("bytes").alias("bytes"), F.min("hash").alias("lo"), F.max("hash").alias("hi")), f"sums{fine}")
        levels = sums.select("fine", "bytes", "lo", "hi", F.explode(F.sequence(F.lit(above), F.lit(fine))).alias("depth"))
        levels = levels.withColumn("prefix", F.expr(f"shiftright(fine, {fine} - depth)"))
        nodes = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))).select("depth", "prefix", "shard_bytes")
        # the highest node that fits is the leaf
        leaf = levels.join(fits, ["depth", "prefix"]).groupBy("fine").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("leaf"))
        leaf = work.save(leaf.select("fine", "leaf.*"), f"leaf{fine}")
        found = rest.withColumn("fine", _prefix(fine)).join(leaf, "fine").drop("fine")
        done = found if done is None else done.unionByName(found)
        if fine >= BITS or sums.join(leaf, "fine", "left_anti").isEmpty():
            break
        rest = work.save(rest.withColumn("fine", _prefix(fine)).join(leaf, "fine", "left_anti").drop("fine"), f"rest{fine}")
        above, fine = fine + 1, min(BITS, fine + 8)
    return done.withColumn("oversized", F.col("shard_bytes") > limit)


def directory(shards: DataFrame) -> DataFrame:
    """One row a shard: depth, prefix, shard_bytes, rows."""
    return shards.groupBy("depth", "prefix").agg(F.max("shard_bytes").alias("shard_bytes"), F.count("*").alias("n_rows"))


def write_shards(df: DataFrame, key: str, shards: DataFrame, path: str) -> None:
    """Writes df's rows as one Parquet folder a shard (depth-prefix), rows with a NULL key too. Rows are dealt by shard, so that each shard is one file."""
    name, at = fresh(df, "shard"), fresh(df, "_key")
    named = shards.select(F.col("key").alias(at), F.concat_ws("-", F.lpad(F.col("depth").cast("string"), 2, "0"), F.hex("prefix")).alias(name)).distinct()
    df.join(named, F.col(key).eqNullSafe(F.col(at))).drop(at).repartition(name).write.partitionBy(name).parquet(path)
