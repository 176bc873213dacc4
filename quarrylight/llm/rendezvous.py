"""Sharding by weighted rendezvous (highest-random-weight) hashing of stable record keys.

Each key draws, for each shard, a uniform number from xxhash64(key, shard name); the shard with the least
-ln(u) / weight wins. A draw involves nothing but the key and that shard, so that adding a shard moves records only
into it, a removed shard's records spread over the others, and weights are met in expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots are counted in so many hash buckets for each shard, so that no task holds a shard whole.
SLOT_BUCKETS = 4096


def _draw(key: Column, shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """Column with the winning shard of each key. Null keys count as one key; equal draws go to the smaller shard.

    weights: shard -> weight; shards of weight 0 take nothing. At least one weight must be positive.
    """
    live = {s: w for s, w in sorted(weights.items()) if w > 0}
    if not live or any(w < 0 for w in weights.values()):
        raise ValueError("weights must be nonnegative, one of them positive")
    name = F.coalesce(key.cast("string"), F.lit("\0null"))
    draws = [F.struct(_draw(name, s, w).alias("d"), F.lit(s).alias("s")) for s, w in live.items()]
    return F.array_min(F.array(*draws))["s"] if len(draws) > 1 else draws[0]["s"]


def assign_shards(df: DataFrame, key: str, weights: dict[int, float], *, order: list[str] = (), shard: str = "shard", slot: str = "slot") -> DataFrame:
    """df with its shard and a gapless slot (from 0) within it.

    Slots follow (hash bucket of the key, key, order). Bucket counts (at most SLOT_BUCKETS rows for each shard, so a
    broadcast of proven size) give each bucket's first slot; rows are ranked within (bucket, shard) alone.
    Repeated rows get slots of their own; an empty table gives an empty result; a column of df that is named like an
    output is replaced.
    """
    b, n, first = "__ql_bucket", "__ql_n", "__ql_first"
    placed = df.withColumn(shard, rendezvous(F.col(key), weights)).withColumn(b, F.pmod(F.xxhash64(F.col(key).cast("string"), *map(F.col, order)), F.lit(SLOT_BUCKETS)).cast("int"))
    starts = placed.groupBy(shard, b).agg(F.count(F.lit(1)).alias(n))
    starts = starts.select(shard, b, (F.sum(n).over(Window.partitionBy(shard).orderBy(b)) - F.col(n)).alias(first))
    ranked = placed.withColumn(slot, F.row_number().over(Window.partitionBy(b, shard).orderBy(key, *order)).cast("long") - 1)
    return ranked.join(F.broadcast(starts), [shard, b]).withColumn(slot, F.col(slot) + F.col(first)).drop(b, first)
