import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.llm import backoff_lm as B


def slow(rows, order, mu=B.MU):
    words = lambda t: re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1
    count = Counter()
    for k, t in rows:
        if not held(k):
            w = ["<s>", *words(t)]
            count.update(tuple(w[i - n + 1 : i + 1]) for i in range(len(w)) for n in range(1, order + 1) if i >= n - 1)
    starts = count.pop(("<s>",), 0)
    one = {g: c for g, c in count.items() if len(g) == 1}
    n, v = sum(one.values()), len(one)

    def p(h, w):
        if not h:
            return (count[(w,)] + 0.5) / (n + 0.5 * (v + 1))
        c = starts if h == ("<s>",) else count[h]
        return (count[(*h, w)] + mu * p(h[1:], w)) / (c + mu)

    out = []
    for k, t in rows:
        w = ["<s>", *words(t)]
        score = sum(math.log10(p(tuple(w[max(0, i - order + 1) : i]), w[i])) for i in range(1, len(w)))
        out.append((k, held(k), len(w) - 1, sum(count[(x,)] > 0 for x in w[1:]), n, sum(math.log10(p((), x)) for x in w[1:]), score))
    return out


@pytest.mark.parametrize("block,order,stretch", [(B.BLOCK, B.ORDER, B.STRETCH), (300, 1, 7), (300, 2, 5), (300, 3, 4), (200, 4, 3)])
def test_against_brute_force(spark, monkeypatch, block, order, stretch):
    monkeypatch.setattr(B, "STRETCH", stretch)
    monkeypatch.setattr(B.blocks, "__defaults__", (block,))
    rng = random.Random(2)
    vocab = ["The", "é", "cat.", "Dog", "x\x1cy", "É"] + [f"w{i}" for i in range(20)]
    rows = [(i, " \n".join(rng.choice(vocab) for _ in range(rng.randint(0, 30)))) for i in range(80)]
    rows += [(7, rows[7][1]), (100, None), (101, ""), (None, "the cat"), (102, "w1 " * 500)]
    df = spark.createDataFrame([(*r, 1, "b", 0) for r in rows], "doc_id long, text string, key int, name string, bucket int").repartition(3)
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted(map(tuple, B.score_documents(df, "doc_id", "text", order).collect()), key=key)
    want = sorted(slow(rows, order), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-8)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_probabilities_sum_to_one(order):
    """At every state: one training text, and held-out texts that go on from each history by each token, known ones and an unknown one."""
    training = [2, 3, 2, 4, 3, 2]
    histories = [[], [2], [3], [4], [5], [2, 3], [3, 2], [2, 4, 3], [5, 2, 3], [4, 4]]
    texts = [[*training, B.END]]
    for h in histories:
        texts += [[*h, t] for t in (B.END, 2, 3, 4, 5)] + [h or [B.END]]
    sizes = np.array([len(t) for t in texts])
    held = np.array([False] + [True] * (len(texts) - 1))
    block = B.Block(list(range(len(texts))), held, sizes, np.concatenate(texts).astype(np.int32), np.arange(7, dtype=np.uint64))
    grams = block.grams(order)
    score = B.Automaton(block, grams, B._counts(block, grams), 7, 4, B.MU).traverse(sizes)[1:].reshape(-1, 6)
    for h, row in zip(histories, score):
        assert sum(10 ** (row[:5] - (row[5] if h else 0.0))) == pytest.approx(1)


def test_repartition_upstream_and_long_texts(spark):
    """Rows that another shuffle delivers, in small blocks, and a text of many stretches."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40)))) for i in range(200)] + [(200, "a b c " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7, "text").groupBy("doc_id").agg(F.first("text").alias("text"))
    got = {r.doc_id: r.score for r in B.score_documents(df, "doc_id", "text").collect()}
    assert got == pytest.approx({w[0]: w[6] for w in slow(rows, B.ORDER)}, abs=1e-6)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.score_documents(df, "doc_id", "text").count() == 0
