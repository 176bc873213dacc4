import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.llm import suffix_dedup as S


def brute(rows, window):
    """rows: (id, text) with distinct ids, in corpus order."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - window + 1):
            w = raw[p : p + window]
            if w in seen:
                gone[p : p + window] = [True] * window
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df, key="doc_id"):
    return {r[key]: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_lpf_matches_definition():
    rng = random.Random(3)
    for n in (0, 1, 2, 17, 80):
        data = bytes(rng.choice(b"ab") for _ in range(n))
        length, source = S.lpf(data)
        for i in range(n):
            best = max((S.common_prefix(data, j, i) for j in range(i)), default=0)
            assert length[i] == best
            assert best == 0 or (0 <= source[i] < i and S.common_prefix(data, source[i], i) == best)
        assert sorted(S.suffix_array(data).tolist(), key=lambda i: data[i:]) == S.suffix_array(data).tolist()


@pytest.mark.parametrize("hot", [4096, 2])
def test_small_corpus_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SHARE", 16 if hot > 16 else 1)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    common, line = text(40), "the common line of sixty bytes stands here, more or less so: "
    rows = [(i, text(rng.randint(0, 60)) + (common if i % 3 == 0 else "") + line + text(20) + line * (i % 4)) for i in range(40)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (104, "x" * 1000), (105, "ab" * 400 + "x" * 150), (-5, rows[7][1][10:]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit(7)).repartition(5)
    assert found(S.remove_repeats(df, "doc_id", "text")) == brute(rows, 100)
    assert found(S.remove_repeats(df, "doc_id", "text", window=40, gram=16)) == brute(rows, 40)


def test_repeated_rows_empty_table_and_carried_columns(spark):
    text = "some words that stand in both rows " * 10
    df = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (2, text, None)], "doc_id long, text string, n_spans string")
    out = S.remove_repeats(df, "doc_id", "text", carry=["n_spans"]).collect()
    assert len(out) == 3 and {r.n_removed for r in out if r.doc_id == 2} == {len(text)}
    assert len({(r.n_removed, r.kept_sha256) for r in out if r.doc_id == 1}) == 1
    assert S.remove_repeats(df.limit(0), "doc_id", "text").count() == 0


def test_whole_table(spark):
    from quarrylight.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(QUERIES["op5_suffix_dedup"](spark, "/root/testdata/sf0.001")) == brute(rows, 100)


def test_windows_in_suffix_order_against_longest_factors():
    """The windows that the operator marks are those whose longest previous factor has a window's length at least."""
    rng = random.Random(9)
    for n, window in ((0, 16), (40, 16), (300, 16), (400, 40), (500, 100)):
        data = "".join(rng.choice("ab") for _ in range(n)).encode()
        data = data + data[n // 3 : n // 3 + 130] + b"zz" + data[: n // 2]
        count = max(0, len(data) - window + 1)
        if count:
            want = [i for i, length in enumerate(S.lpf(data)[0]) if length >= window]
            assert S._sorted_windows([data], np.array([count]), window).tolist() == want


def test_keys_met_once_a_flush_are_hot(spark, monkeypatch):
    """A line in ever new surroundings, one a flush: its key is found hot whatever the size of a flush, and results stay."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line = "the common line of more than sixty bytes stands here, more or less so in every one: "
    rows = [(i, text(120) + line + text(120)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    monkeypatch.setattr(S, "HOT", 160)
    for flush in (300, 1 << 20):
        monkeypatch.setattr(S, "FLUSH", flush)
        assert len(S._hot_keys(df, 100, 32)) >= 1
    monkeypatch.setattr(S, "HOT", 1 << 20)
    assert len(S._hot_keys(df, 100, 32)) == 0


def test_sql(spark):
    """The registered query beside its SQL."""
    import duckdb

    from quarrylight.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLES["op5_suffix_dedup"]).fetchall()
    assert sorted(map(tuple, queries.op5_suffix_dedup(spark, sf).collect())) == sorted(want)
