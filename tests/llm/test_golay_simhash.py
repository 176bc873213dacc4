import random

import numpy as np
import xxhash

from quarrylight.llm import golay_simhash as G


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, w = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [w] if w else []
            w = ""
        else:
            w += c
    sh = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_code_and_keys():
    words = {int(i) << 11 | int(G._HIGH[i]) for i in range(4096)}
    assert len(words) == 4096 and min(w.bit_count() for w in words if w) == 7
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 23, 300)
    for x, row in zip(v.tolist(), G.codewords(v).tolist()):
        assert {c for c in row if c >= 0} == {w >> 11 for w in words if (w ^ x).bit_count() <= 4}
    for distance in (2, 8):
        for _ in range(300):
            x = random.getrandbits(64)
            y = x
            for b in random.sample(range(64), random.randint(0, distance)):
                y ^= 1 << b
            r, k = G.keys(np.array([x, y], np.uint64), distance)
            assert set(k[r == 0].tolist()) & set(k[r == 1].tolist())


def test_groups_against_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"W{i}é" for i in range(30)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += [t + " tail" for t in texts[:30]] + texts[:10] + [None, "", "one", "one", "two words", "\x1c a\x0bB\tc " * 50]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for shingle, distance in ((3, 2), (2, 8)):
        got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in G.near_groups(df, "doc_id", "text", shingle, distance).collect()}
        fps = [slow_fingerprint(t, shingle) for t in texts]
        roots = slow_components(fps, distance)
        assert got == {rows[i][0]: (fps[i], rows[roots[i]][0]) for i in range(len(rows))}


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (4, "a b c d")], "doc_id long, text string")
    assert [r.component_id for r in G.near_groups(df, "doc_id", "text").collect()] == [4, 4, 4]
    assert G.near_groups(df.limit(0), "doc_id", "text").count() == 0


def test_forest_spans_components():
    fp = np.array([0, 1, 3, 7, 7 << 40, (7 << 40) | 1, 7 << 58], np.uint64)
    f = G.forest(fp, 1)
    assert len(f) == 4 and all(int(fp[i] ^ fp[j]).bit_count() <= 1 for i, j in f)
