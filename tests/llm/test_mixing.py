import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.llm import mixing as M
from quarrylight.llm import queries


def rows():
    a, b = "alpha beta gamma delta", "uno dos tres quatro"
    out = [(i, a if i % 3 else b) for i in range(60)] + [(100, f"{a} {b}"), (101, ""), (102, None), (103, "unseen words only")]
    return [(i, None if t is None else " ".join([t] * (1 + i % 4)) if t else t) for i, t in out]


def slow_posteriors(spark, docs, labels, domains):
    """The same formula from plain counts; hash buckets come from the engine's xxhash64."""
    words = {i: [w for w in re.split(r"[ \t\n\x0b\f\r]+", (t or "").lower()) if w] for i, t in docs}
    vocab = sorted({w for x in words.values() for w in x})
    df = spark.createDataFrame([(w,) for w in vocab], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(M.BUCKETS)).alias("b"))
    bucket = {r.w: r.b for r in df.collect()}
    counts = defaultdict(Counter)
    for i, d in labels:
        counts[d].update(bucket[w] for w in words[i])
    sums = [sum(counts[d].values()) for d in domains]
    out = {}
    for i, x in words.items():
        z = [math.log((s + 1) / (sum(sums) + len(domains))) + sum(math.log((counts[d][bucket[w]] + 0.5) / (s + 0.5 * M.BUCKETS)) for w in x) / max(1, len(x)) ** M.TEMPER for d, s in zip(domains, sums)]
        e = [math.exp(y - max(z)) for y in z]
        out[i] = (len(x) + 1, [y / sum(e) for y in e])
    return out


def dense_rates(tokens, p, targets, low):
    """The same least-squares problem by an active-set method over all documents at once."""
    t, p = np.array(tokens, float), np.array(p, float)
    total, k = t.sum(), p.shape[1]
    share, have = t / total, t @ p / total
    w = np.where(have > 0, targets, 0.0)
    w = w / w.sum()
    aim = w * (max(h / x for h, x in zip(have, w) if x > 0) if low >= 1 else 1.0)
    free = np.ones(len(t), bool)
    for _ in range(1000):
        # r = 1 - p.u on the free ones, low on the others; residual = RIDGE u
        g = (p[free] * share[free, None]).T @ p[free]
        c = p[free].T @ share[free] + low * (p[~free].T @ share[~free])
        u = np.linalg.solve(g + M.RIDGE * np.eye(k), c - aim)
        now = 1 - p @ u > low
        if (now == free).all():
            return np.maximum(low, 1 - p @ u), aim
        free = now
    raise AssertionError("no fixed active set")


@pytest.mark.parametrize("low", [0.0, 1.0])
def test_rates_against_a_dense_solver(spark, low):
    rng = np.random.default_rng(7)
    for k, n in ((2, 30), (3, 80), (4, 300)):
        p = rng.dirichlet([0.2] * k, n)
        tokens = rng.integers(1, 500, n)
        targets = rng.dirichlet([2] * k)
        want, aim = dense_rates(tokens, p, targets, low)
        post = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "tokens long, p array<double>").repartition(3)
        u, aims, reached = M.solve(post, targets.tolist(), low)
        got = np.maximum(low, 1 - p @ np.array(u))
        assert np.abs(got - want).max() < 1e-5 and np.allclose(np.array(aims) / tokens.sum(), aim)
        assert np.allclose(reached, (tokens * got) @ p)
        if low == 0:
            assert np.abs(np.array(reached) - aims).max() < 1e-4 * tokens.sum()


def test_posteriors_and_rates(spark):
    docs = rows()
    labels = [(i, "b" if i % 3 == 0 else "a") for i in range(0, 60, 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, "a"), (3, None), (9, "z")], "doc_id long, domain string")
    want = slow_posteriors(spark, docs, labels, ["a", "b"])
    for low in (0.0, 1.0):
        got = {r.doc_id: r for r in M.mix(df, "doc_id", "text", lab, {"a": 1.0, "b": 1.0}, low=low).collect()}
        assert set(got) == set(want)
        for i, (n, p) in want.items():
            assert got[i].tokens == n and got[i].p == pytest.approx(p, abs=1e-9)
            assert got[i].rate >= low and math.floor(got[i].rate) <= got[i].copies <= math.ceil(got[i].rate)
        slow, _ = dense_rates([n for n, _ in want.values()], [p for _, p in want.values()], np.array([0.5, 0.5]), low)
        assert [got[i].rate for i in want] == pytest.approx(slow.tolist(), abs=1e-5)
    down = {r.doc_id: r for r in M.mix(df, "doc_id", "text", lab, {"a": 0.0, "b": 1.0}).collect()}
    slow, _ = dense_rates([n for n, _ in want.values()], [p for _, p in want.values()], np.array([0.0, 1.0]), 0.0)
    assert [down[i].rate for i in want] == pytest.approx(slow.tolist(), rel=1e-5, abs=1e-5)


def test_registered_query_meets_its_targets(spark):
    got = queries.op8_mixing(spark, "/root/testdata/sf0.001").collect()
    tokens = np.array([r.tokens for r in got])
    p = np.array([[r[f"p_{d}"] for d in queries.TARGETS] for r in got])
    want, aim = dense_rates(tokens, p, np.array(list(queries.TARGETS.values())), 0.0)
    rate = np.array([r.rate for r in got])
    assert np.abs(rate - want).max() < 1e-6
    assert np.abs((tokens * rate) @ p / tokens.sum() - aim).max() < 1e-4


def test_edges(spark):
    df = spark.createDataFrame([(1, "alpha", 5.0), (1, "alpha", 6.0), (None, "beta", 1.0), (None, None, 2.0), (2, "x " * 200_000, 0.0), (2, "other", 0.0)], "doc_id long, text string, rate double")
    none = spark.createDataFrame([], "doc_id long, domain string")
    got = M.mix(df, "doc_id", "text", none, {"a": 1.0, "b": 3.0}).collect()
    assert sorted(((r.doc_id, r.tokens) for r in got), key=str) == sorted([(1, 4), (None, 2), (None, 1), (2, 200_001), (2, 2)], key=str)
    assert all(r.rate >= 0 and r.p == pytest.approx([0.5, 0.5]) for r in got)
    assert M.mix(df.limit(0), "doc_id", "text", none, {"a": 1.0}).count() == 0
