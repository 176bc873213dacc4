import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.llm import token_output as T
from quarrylight.llm import tokens
from quarrylight.llm import vector_packing as V

ODD = ["<|endoftext|>", "A's don'T", "x y z ́a é", "İstanbul ΣΑΣ \x1cfoo\x85bar ½a. 5, a',", "ﬁ Å Ω μ", "WORD!!! word.,; a-b", "", " ", "\n\n", "long" * 3000, "naïve,café. ß SS", "ǅ ª º"]


def reference(texts):
    t = tokens.WordIds().tokenizer
    return [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_cached_words_give_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 20)
    rng = random.Random(0)
    pool = [w for x in ODD for w in x.split(" ")] + ["the", "The", "the,", "THE.", "ness", "Ness!!"]
    texts = ODD + [rng.choice([" ", "\n", "\t"]).join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    w = tokens.WordIds()
    assert [w.encode(t) for t in texts] == reference(texts)


def check(pieces, lengths, prompts, limits):
    by_item, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0
        by_item[p.item].append(p)
        by_seq[p.sequence].append(p)
    for i, n in enumerate(lengths):
        at = 0
        for p in sorted(by_item[i], key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == n
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
        assert sum(p.length for p in ps) <= limits.tokens and len(ps) <= limits.segments
        assert sum(max(0, p.start + p.length - max(p.start, prompts[p.item])) for p in ps) <= limits.loss
    return len(by_seq)


@pytest.mark.parametrize("limits", [V.Limits(64, 8, 64), V.Limits(64, 3, 20), V.Limits(10, 1, 1), V.Limits(7, 50, 7)])
def test_limits_hold_and_nothing_is_lost(limits):
    rng = random.Random(1)
    for _ in range(20):
        lengths = np.array([rng.choice([0, 1, 2, 5, 30, 63, 64, 65, 300]) for _ in range(rng.randint(0, 40))], np.int64)
        prompts = np.array([rng.randint(0, int(n)) for n in lengths], np.int64)
        check(V.pack(lengths, prompts, limits), lengths, prompts, limits)


def test_padding_is_small():
    rng = random.Random(2)
    lengths = np.array([int(rng.lognormvariate(6, 1)) + 1 for _ in range(2000)], np.int64)
    n = check(V.pack(lengths, np.zeros(2000, np.int64), V.Limits()), lengths, np.zeros(2000, int), V.Limits())
    assert n * 2048 - lengths.sum() < 2048


def frame(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (100, None), (None, "null id " * 900)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x")), rows


def test_pack_documents(spark):
    df, rows = frame(spark)
    got = V.pack_documents(df.repartition(2), "doc_id", "text").collect()
    ids = {k: b + np.array([1], "<u4").tobytes() for (k, _), b in zip(rows, reference([t or "" for _, t in rows]))}
    for p in got:
        part = ids[p.doc_id][4 * p.start : 4 * (p.start + p.length)]
        assert zlib.crc32(part) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id]) // 4
    assert sum(p.length for p in got) == sum(len(ids[k]) // 4 for k, _ in rows)
    assert V.pack_documents(df.limit(0), "doc_id", "text").count() == 0
    whole(got, V.Limits())


def whole(rows, limits):
    """Sequences are gapless and within the limits."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(rs) <= limits.segments and sum(r.loss_tokens for r in rs) <= limits.loss
    return by


def test_registered_query(spark):
    """Every id of every document once, in gapless sequences with little padding."""
    from quarrylight.llm import queries
    from quarrylight.llm.common import documents

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    got = queries.op4_packing(spark, sf).collect()
    by = whole(got, V.Limits())
    ids = dict(zip(texts, [b + np.array([1], "<u4").tobytes() for b in reference([t or "" for t in texts.values()])]))
    parts = defaultdict(list)
    for p in got:
        part = ids[p.doc_id][4 * p.start : 4 * (p.start + p.length)]
        assert zlib.crc32(part) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id]) // 4
        parts[p.doc_id].append((p.start, part))
    assert {k: b"".join(x for _, x in sorted(v)) for k, v in parts.items()} == ids
    assert len(by) * 2048 - sum(p.length for p in got) < 2048 * (1 + len({s >> 40 for s in by}))


@pytest.mark.parametrize("limits", [V.Limits(512, 8, 128), V.Limits(256, 4, 200), V.Limits(128, 64, 128)])
def test_instruction_data(spark, limits):
    """Answers bear loss, prompts don't: with limits of which each binds somewhere."""
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").withColumn("key", F.lit("x"))
    pairs = V.exchanges(turns, "conv_id", "turn", "role", "text")
    rows = {(r.conv_id, r.turn): r for r in turns.collect()}
    want = {}
    for (c, t), r in rows.items():
        if r.role == "assistant":
            b = rows.get((c, t - 1))
            want[f"{c}:{t}"] = (b.text if b and b.role != "assistant" else None, r.text)
    assert {r.key: (r.prompt, r.text) for r in pairs.collect()} == want
    got = V.pack_documents(pairs, "key", "text", limits, prompt="prompt").collect()
    whole(got, limits)
    heads, tails = reference([p or "" for p, _ in want.values()]), reference([t or "" for _, t in want.values()])
    ids = {k: a + b + np.array([1], "<u4").tobytes() for k, a, b in zip(want, heads, tails)}
    free = {k: len(a) // 4 for k, a in zip(want, heads)}
    length = defaultdict(int)
    for p in got:
        assert zlib.crc32(ids[p.key][4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32
        assert p.loss_tokens == max(0, p.start + p.length - max(p.start, free[p.key]))
        length[p.key] += p.length
    assert length == {k: len(x) // 4 for k, x in ids.items()}
    by = whole(got, limits)
    assert any(sum(r.loss_tokens for r in rs) == limits.loss or len(rs) == limits.segments for rs in by.values())


def slow_best_fit(lengths, size):
    rows = [size - size for n in lengths for _ in range(n // size)]
    rooms = []
    for n in sorted((n % size for n in lengths if n % size), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(size - n)
    return sorted(rows + rooms)


def test_best_fit_against_plain_search():
    rng = random.Random(3)
    for size in (1, 7, 64, 100):
        lengths = [rng.randint(0, 3 * size) for _ in range(200)]
        rows = T.best_fit(lengths, size)
        assert sorted(size - sum(n for _, _, n in r) for r in rows) == slow_best_fit(lengths, size)
        seen = defaultdict(list)
        for r in rows:
            for i, s, n in r:
                seen[i] += range(s, s + n)
        assert all(sorted(seen[i]) == list(range(n)) for i, n in enumerate(lengths))


def test_matrices_round_trip(spark):
    df, rows = frame(spark)
    got = T.write_matrices(df.repartition(2), "doc_id", "text", row_tokens=128, positions=True).collect()
    parts = defaultdict(list)
    for r in got:
        line, pos = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u4")
        assert len(line) == 128 and r.cu_seqlens[-1] == r.n_tokens and not line[r.n_tokens :].any()
        for k, s, a, b in zip(r["keys"], r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            parts[k].append((s, line[a:b].astype("<u4").tobytes()))
            assert pos[a:b].tolist() == list(range(b - a))
        assert [i for i in range(128) if pos[i] == 0] == r.position_resets
    want = defaultdict(list)
    for (k, _), b in zip(rows, reference([t or "" for _, t in rows])):
        want[k].append(b + np.array([1], "<u4").tobytes())
    for k, whole in want.items():
        if len(whole) == 1:
            assert b"".join(x for _, x in sorted(parts[k])) == whole[0]
        else:
            assert sum(len(x) for _, x in parts[k]) == sum(map(len, whole))
    assert T.write_matrices(df.limit(0), "doc_id", "text").count() == 0
