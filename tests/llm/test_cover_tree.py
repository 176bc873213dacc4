import math
import random

import numpy as np
import pytest

from quarrylight.llm import cover_tree as C


def slow(rows, k, scale=256):
    v = {}
    for i, x in rows:
        if i is not None and x and all(y is not None and math.isfinite(y) for y in x):
            v[i] = [math.floor(scale * y) for y in x]
    out = {}
    for q in v:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q and len(x) == len(v[q]))
            out |= {(q, n + 1): (i, -t) for n, (t, i) in enumerate(s[:k])}
    return out


def test_tree_covers_and_separates():
    p = np.random.default_rng(1).normal(size=(500, 3))
    t = C.CoverTree(p, leaf=1)
    assert sorted(t.order.tolist()) == list(range(500))

    def walk(n):
        inside = p[t.order[n.begin : n.end]]
        assert np.linalg.norm(inside - n.centre, axis=1).max() <= n.radius + 1e-9
        if n.children:
            half = 2.0 ** (np.ceil(np.log2(n.radius)) - 1)
            c = np.array([x.centre for x in n.children])
            d = np.linalg.norm(c[:, None] - c[None], axis=2) + np.eye(len(c)) * 1e9
            assert d.min() > half and np.linalg.norm(c - n.centre, axis=1).max() <= 2 * half
            for x in n.children:
                walk(x)

    walk(t.root)


def test_pruning_prunes():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16)) * 100
    data = np.floor(centres[rng.integers(0, 8, 4000)] + rng.normal(size=(4000, 16)))
    s = C.Search(np.arange(40), data[:40], 5)
    s.against(np.arange(4000), C.CoverTree(data))
    assert s.pairs < 0.5 * 40 * 4000


@pytest.mark.parametrize("block", [C.BLOCK, 40])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "PER_PIVOT", 50)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # copies: ties by key
    rows += [(1000, None), (1001, [None] * 8), (1050, [1.0] * 7 + [float("nan")]), (1100, []), (1150, [0.5, 0.25]), (1151, [1.0, 1.0]), (None, [1.0] * 8), (1200, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    import struct

    f32 = [(i, None if x is None else [None if y is None else struct.unpack("f", struct.pack("f", y))[0] for y in x]) for i, x in rows]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in C.top_k(df, "vec_id", "embedding", "vec_id % 50 = 0").collect()}
    assert got == slow(f32, 5)


def test_whole_table_and_empty(spark):
    from quarrylight.llm.queries import QUERIES

    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op3_cover_tree"](spark, "/root/testdata/sf0.001").collect()}
    assert got == slow([(r.vec_id, r.embedding) for r in df.collect()], 5)
    assert C.top_k(df.limit(0), "vec_id", "embedding", "vec_id % 50 = 0").count() == 0


@pytest.mark.parametrize("block", [C.BLOCK, 40])
def test_repeated_rows_and_keys(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "PER_PIVOT", 50)
    rng = random.Random(6)
    vectors = {i: [[rng.randint(-4, 4) / 4 for _ in range(8)]] for i in range(150)}
    vectors[50] += [[rng.randint(-4, 4) / 4 for _ in range(8)]]
    vectors[7] += vectors[0] + [[2.0] * 8]
    vectors[149] = vectors[100]
    rows = [(i, x) for i, xs in vectors.items() for x in xs] * 2 + [(100, vectors[100][0])] * 6
    want = {}
    for q in (0, 50, 100):
        best = {i: max(sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y)) for x in vectors[q] for y in ys) for i, ys in vectors.items() if i != q}
        want |= {(q, n + 1): (i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5])}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in C.top_k(df, "vec_id", "embedding", "vec_id % 50 = 0").collect()}
    assert got == want


@pytest.mark.parametrize("block", [C.BLOCK, 8])
def test_large_components(spark, monkeypatch, block):
    """Doubles of any size: exact as long as components and scores are 64-bit integers, the nearest in range beyond."""
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "PER_PIVOT", 10)
    rng = random.Random(8)
    rows = [(0, [1e7, 1.0]), (1, [1e7, 2.0]), (2, [1.0, 1.0]), (50, [-3e12, 7.5]), (51, [1.7e308, 0.0]), (100, [1e14 + 1 / 64, -1e14]), (101, [1e14, 1e14])]
    rows += [(200 + i, [rng.choice([1, 1e4, 1e8, 1e12]) * rng.uniform(-1, 1), rng.choice([1, 1e4, 1e8]) * rng.uniform(-1, 1)]) for i in range(60)]
    most = 2**63 - 1
    whole = {i: [min(max(math.floor(256 * y) if abs(y) < 1e300 else int(y), -most), most) for y in x] for i, x in rows}
    want = {}
    for q in (i for i in whole if i % 50 == 0):
        s = sorted((-min(max(sum(a * b for a, b in zip(whole[q], x)), -most), most), i) for i, x in whole.items() if i != q)
        want |= {(q, n + 1): (i, -t) for n, (t, i) in enumerate(s[:5])}
    df = spark.createDataFrame([(i, x, 1, 2, "v") for i, x in rows], "vec_id long, embedding array<double>, score int, dim int, q string").repartition(3)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in C.top_k(df, "vec_id", "embedding", "vec_id % 50 = 0").collect()}
    assert got == want
    few = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in C.top_k(df.filter("vec_id < 3"), "vec_id", "embedding", "vec_id = 0").collect()}
    assert few == {(0, 1): (1, 6553600000000131072), (0, 2): (2, 655360065536)}


def test_sql(spark):
    """The registered query beside its SQL."""
    import duckdb

    from quarrylight.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.sql(queries.ORACLES["op3_cover_tree"]).fetchall()
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in queries.op3_cover_tree(spark, sf).collect()]
    assert sorted(got) == sorted(want)
