import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from quarrylight.llm import rendezvous as R
from quarrylight.llm.queries import QUERIES


def draws(spark, keys, shards):
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", *(F.xxhash64(F.coalesce(F.col("k").cast("string"), F.lit("\0null")), F.lit(s)).alias(f"h{s}") for s in shards))
    return {r.k: {s: ((r[f"h{s}"] % 2**64 >> 11) + 0.5) / 2**53 for s in shards} for r in df.collect()}


def test_weights_and_definition(spark):
    weights = {0: 1.0, 1: 2.0, 2: 0.0, 7: 5.0}
    keys = [*range(4000), None]
    got = {r.k: r.s for r in spark.createDataFrame([(k,) for k in keys], "k long").select("k", R.rendezvous(F.col("k"), weights).alias("s")).collect()}
    u = draws(spark, keys, [0, 1, 7])
    assert got == {k: min((-math.log(u[k][s]) / weights[s], s) for s in (0, 1, 7))[1] for k in keys}
    n = Counter(got.values())
    assert abs(n[7] / 4001 - 5 / 8) < 0.04 and abs(n[1] / 4001 - 2 / 8) < 0.04


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op6_sharding"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key") and 0 <= r.shard < 16
        assert r.grown_shard in (r.shard, 16)
    slots = Counter((r.shard, r.slot) for r in rows)
    for s, n in Counter(r.shard for r in rows).items():
        assert all(slots[s, i] == 1 for i in range(n))


def test_edges(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "b")], "doc_id long, slot string")
    got = R.assign_shards(df, "doc_id", {0: 1.0}).collect()
    assert sorted(r.slot for r in got) == [0, 1, 2, 3]
    assert R.assign_shards(df.limit(0), "doc_id", {0: 1.0, 1: 1.0}).count() == 0
