import random

import corpus_pipeline as P
import numpy as np

from quarrylight.llm import golay_simhash as G

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_set(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    a, b = slow_set(a), slow_set(b)
    return a == b or len(a & b) >= 0.8 * len(a | b)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def changed(rng, words, n):
    """n words replaced, far from one another: each takes five shingles."""
    out = list(words)
    for at in range(3, 3 + 10 * n, 10):
        out[at] = f"new{rng.randint(0, 10**9)}"
    return " ".join(out)


def test_forest_of_similar_sets():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(12):
        base = np.arange(40) + rng.integers(0, 1 << 40)
        sets += [np.sort(np.concatenate([base[n:], rng.integers(1 << 41, 1 << 42, n)])).astype(np.uint64) for n in (0, 3, 4, 5, 20)]
    sets += [np.empty(0, np.uint64), np.empty(0, np.uint64)]
    root = list(range(len(sets)))
    for i, j in G.similar_forest(sets):
        old = root[j]
        root = [root[i] if r == old else r for r in root]
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                old = want[i]
                want = [want[j] if w == old else w for w in want]
    assert [[a == b for b in root] for a in root] == [[a == b for b in want] for a in want]


def test_only_similar_documents_go(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for _ in range(30):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        rows += [" ".join(words), changed(rng, words, 1), changed(rng, words, 2), changed(rng, words, 8), changed(rng, words, 12)]
    rows = list(enumerate(rows))
    texts = dict(rows)
    for block, hubs in ((G.BLOCK, G.HUBS), (2, 1), (2, 3)):  # components in one piece, and dealt out in blocks
        monkeypatch.setattr(G, "BLOCK", block)
        monkeypatch.setattr(G, "HUBS", hubs)
        left = {r.doc_id for r in P.near_dedup(spark, frame(spark, rows), "").collect()}
        for i in set(texts) - left:
            assert any(i != j and similar(texts[i], texts[j]) for j in texts), i
        gone = len(texts) - len(left)
        assert gone >= 55 and all(5 * n in left for n in range(30))


def test_null_and_repeated_ids(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    rows = [(None, a), (None, b), (None, b), (None, c + " tail"), (7, c), (7, d), (7, d + " tail"), (9, d), (9, e), (7, e + " tail"), (None, None), (None, ""), (11, " ")]
    out = P.near_dedup(spark, frame(spark, rows), "")
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [x for x in got if x[1] and x[1][0] in "abc"] == sorted([(None, a), (None, b), (7, c)], key=str)
    assert [x[0] for x in got if x[1] and x[1][0] in "de"] == [7, 7] and len(got) == 6 and (11, " ") in got


def test_blocks_lose_no_link(spark, monkeypatch):
    """Chains and classes of many sizes under one root, in small blocks with few hubs: the components are those of all pairs."""
    monkeypatch.setattr(G, "BLOCK", 8)
    monkeypatch.setattr(G, "HUBS", 2)
    rng = np.random.default_rng(3)
    sets = []
    for n in (60, 20, 9, 3, 1, 1, 1):
        base = rng.integers(0, 1 << 60, 60)
        for i in range(n):
            base = np.concatenate([base[3:], rng.integers(0, 1 << 60, 3)])  # each is like the next ones only
            sets.append(np.unique(base.astype(np.uint64)))
    rows = [(1, len(sets), bytearray(i.to_bytes(2, "big") * 8), bytearray(sets[i].tobytes())) for i in rng.permutation(len(sets)).tolist()]
    members = spark.createDataFrame(rows, "root long, n long, same binary, s binary").repartition(3)
    root = {r.node[:2]: bytes(r.root)[:2] for r in G.similar_classes(members).collect()}
    got = [int.from_bytes(root.get(i.to_bytes(2, "big"), i.to_bytes(2, "big")), "big") for i in range(len(sets))]
    want = list(range(len(sets)))
    for i, j in G.similar_forest(sets):
        want = [min(want[i], want[j]) if w in (want[i], want[j]) else w for w in want]
    assert got == want and len(set(want)) == 7


def test_recall_and_precision_on_the_documents(spark):
    """Against all pairs of sf0.01: at least nine tenths of the similar pairs share a group, and what goes is similar to one of its group."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: slow_set(r.text) for r in docs.select("doc_id", "text").collect()}
    left = {r.doc_id for r in P.near_dedup(spark, docs, "").select("doc_id").collect()}
    where = {}
    for i, s in texts.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    pairs = {(a, b) for a, b in pairs if len(texts[a] & texts[b]) >= 0.8 * len(texts[a] | texts[b])}
    root = {i: i for i in texts}
    for a, b in sorted(pairs):
        ra, rb = root[a], root[b]
        root = {i: min(ra, rb) if r in (ra, rb) else r for i, r in root.items()}
    should = {i for i in texts if root[i] != i}
    gone = set(texts) - left
    assert gone <= should | {i for i in texts if not texts[i]} and len(gone & should) >= 0.9 * len(should) > 40
