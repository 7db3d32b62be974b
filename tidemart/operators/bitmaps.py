"""Exact integrity checks by bitmaps of integer keys.

A bitmap holds one bit for each of 32768 neighbouring keys (Spark's
``bitmap_bucket_number`` / ``bitmap_bit_position``), built in every task before
anything is shuffled. A bucket with fewer bits than rows holds a repeated key; a
bucket whose bits grow when the child's keys are added to the parent's holds a
foreign key. Only the rows of such buckets are shuffled and checked one by one:
on clean tables nothing but bitmaps moves, about a bit and a few bytes a key
where rows would move whole keys.

Bitmaps pay where keys lie close together in a task. Whether they do is counted
first (rows, and distinct pairs of task and bucket); keys that are scattered, or
are not integers, go the ordinary way. Both ways give the same rows. Several
checks run in one job each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

BITMAP_BYTES = 4096 + 16
ROW_BYTES = 16
BROADCAST_BUCKETS = 1 << 20

Side = tuple[str, DataFrame, str]  # name, table, key column


def bucket(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key).cast("bigint"))


def position(key: str) -> Column:
    return F.bitmap_bit_position(F.col(key).cast("bigint"))


def dense(sides: Sequence[Side]) -> set[str]:
    """Names of the sides with integer keys whose bitmaps are smaller than their keys (one pass over the keys)."""
    whole = [s for s in sides if isinstance(s[1].schema[s[2]].dataType, (ByteType, ShortType, IntegerType, LongType))]
    if not whole:
        return set()
    pairs = reduce(DataFrame.unionAll, [
        df.where(F.col(key).isNotNull()).select(F.lit(name).alias("name"), F.xxhash64(
            F.spark_partition_id(), bucket(key)).alias("pair")) for name, df, key in whole])
    found = pairs.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("pair").alias("bitmaps"))
    sized = {r["name"]: (r["rows"], r["bitmaps"]) for r in found.collect()}
    return {name for name, _, _ in whole if name not in sized or sized[name][1] * BITMAP_BYTES <= sized[name][0] * ROW_BYTES}


def repeated_buckets(sides: Sequence[Side]) -> DataFrame:
    """(name, bucket) of the buckets that hold a key more than once."""
    keys = reduce(DataFrame.unionAll, [
        df.where(F.col(key).isNotNull()).select(F.lit(name).alias("name"), bucket(key).alias("bucket"),
                                                position(key).alias("at")) for name, df, key in sides])
    maps = keys.groupBy("name", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"), F.count(F.lit(1)).alias("rows"))
    return maps.where(F.bitmap_count("bits") < F.col("rows")).select("name", "bucket")


def foreign_buckets(children: Sequence[Side], parents: Sequence[Side]) -> DataFrame:
    """(name, bucket) of the buckets in which a child has a key that the parent of that name has not."""
    keys = reduce(DataFrame.unionAll, [
        df.where(F.col(key).isNotNull()).select(F.lit(name).alias("name"), bucket(key).alias("bucket"),
                                                position(key).alias("at"), F.lit(owner).alias("owner"))
        for owner, sides in ((False, children), (True, parents)) for name, df, key in sides])
    maps = keys.groupBy("name", "bucket", "owner").agg(F.bitmap_construct_agg("at").alias("bits"))
    both = maps.groupBy("name", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
        F.coalesce(F.max(F.when(F.col("owner"), F.bitmap_count("bits"))), F.lit(0)).alias("owned"))
    return both.where(F.col("all") > F.col("owned")).select("name", "bucket")


def rows_of(side: Side, buckets: DataFrame, counts: dict[str, int]) -> DataFrame | None:
    """Rows of a side in its ``buckets``; None where there are none (no pass over the rows).

    A list of buckets is broadcast up to a checked number, beyond it joined by shuffle.
    """
    name, df, key = side
    if not counts.get(name):
        return None
    mine = buckets.where(F.col("name") == name).select(F.col("bucket").alias("_bucket"))
    if counts[name] <= BROADCAST_BUCKETS:
        mine = F.broadcast(mine)
    return df.where(F.col(key).isNotNull()).join(mine, bucket(key) == F.col("_bucket"), "left_semi")


def counted(buckets: DataFrame) -> dict[str, int]:
    """Number of buckets per name."""
    return {r["name"]: r["count"] for r in buckets.groupBy("name").count().collect()}
