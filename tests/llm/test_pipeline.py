import random

import corpus_pipeline as P
import numpy as np
from pyspark.sql import functions as F
from test_golay_simhash import slow_components, slow_fingerprint
from test_near_copies import SCHEMA, similar
from test_suffix_dedup import brute

from quarrylight.llm import queries, tokens
from quarrylight.llm.common import cut, documents
from quarrylight.llm.ordinal_quality import Scorer

SF = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = queries.quality_model(docs, SF)
    scorer = Scorer(model)
    one = cut(P.quality(spark, docs, SF), "t")
    assert one.columns == columns
    want = {i for i, t in texts.items() if model.tails(np.array([scorer.score(t)]))[0, 1] >= queries.LEAST + 1e-5}
    got = {r.doc_id: r.text for r in one.collect()}
    assert want <= set(got) and all(texts[i] == t for i, t in got.items())

    two = cut(P.near_dedup(spark, one, SF), "t")
    # the stage's rule: similar documents among those whose fingerprints hang together
    ids = sorted(got)
    roots = slow_components([slow_fingerprint(got[i], P.SHINGLE) for i in ids], P.DISTANCE)
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if roots[i] == roots[j] and similar(got[ids[i]], got[ids[j]]):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    left = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == columns and set(left) == {i for n, i in enumerate(ids) if group[n] == n}

    three = cut(P.repeats(spark, two, SF), "t")
    assert three.columns == columns and three.schema == docs.schema
    kept = {r.doc_id: r for r in three.collect()}
    sizes = brute(list(left.items()), 100)
    for i, r in kept.items():
        n, gone, spans, _ = sizes[i]
        assert n - gone - 6 * spans <= len(r.text.encode()) <= n - gone and r.n_chars == len(r.text)
        assert gone or r.text == left[i]

    four = cut(P.mix(spark, three, SF), "t")
    again = [(r.doc_id, r.text) for r in four.collect()]
    assert four.columns == columns and {i for i, _ in again} == set(kept) and all(kept[i].text == t for i, t in again)

    pieces = P.packing(spark, four, SF).collect()
    enc = tokens.WordIds()
    assert sum(p.length for p in pieces) == sum(len(enc.encode(t)) // 4 + 1 for _, t in again)


def test_run(spark):
    assert P.run(spark, SF).count() > 0
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "repeats", "mix", "packing"]


def odd_documents():
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    shared = "passage é\u4e00 of " + words(20)
    one = words(80)
    rows = [(None, words(60)), (None, words(60)), (7, words(60)), (7, words(60)), (8, one), (8, one), (9, f"bad \ufffd char {shared} tail"), (10, f"{words(30)} \ufffd {shared[1:]} \u4e00end"),
            (11, None), (12, ""), (13, " \t"), (14, words(60_000))]
    return rows


def odd_frame(spark, rows):
    """With columns whose names the stages might use themselves."""
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(3)
    return docs.withColumns({"key": F.lit("k"), "id": F.lit(1), "spans": F.lit("x"), "rate": F.lit(2.5), "text_hash": F.lit("h"), "tokens": F.lit(0)})


def test_near_copies_of_odd_rows(spark):
    rows = odd_documents()
    docs = odd_frame(spark, rows)
    out = P.near_dedup(spark, docs, SF)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = sorted({(i, t) for i, t in rows if i not in (12, 13)}, key=str)  # 11, 12, 13 have no word: one class
    assert out.columns == docs.columns and got == want


def test_repeats_of_odd_rows(spark):
    rows = odd_documents()
    docs = odd_frame(spark, rows)
    out = P.repeats(spark, docs, SF)
    got = out.collect()
    assert out.columns == docs.columns and len(got) == len(rows)
    texts = dict(rows)
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 7, 8)}
    for i in (9, 11, 12, 13, 14):
        assert by[i].text == texts[i] and by[i].n_chars == (None if texts[i] is None else len(texts[i]))
    head, tail = texts[10].split(texts[9][11:-5][1:])
    assert "\ufffd" in by[10].text and by[10].text.startswith(head.strip()) and by[10].text.endswith("end")
    assert len(by[10].text) < len(texts[10]) - 90 and by[10].n_chars == len(by[10].text)
    assert sorted(r.text for r in got if r.doc_id is None) == sorted(t for i, t in rows if i is None)


def test_mix_and_packing_of_odd_rows(spark):
    rows = odd_documents()
    docs = odd_frame(spark, rows)
    out = P.mix(spark, docs, SF)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns and set(got) == set(rows) and len(got) >= len(rows)
    pieces = P.packing(spark, docs, SF).collect()
    enc = tokens.WordIds()
    assert sum(p.length for p in pieces) == sum(len(enc.encode(t or "")) // 4 + 1 for _, t in rows)


def test_quality_of_odd_rows(spark):
    rows = odd_documents()
    docs = odd_frame(spark, rows)
    out = P.quality(spark, docs, SF)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns and set(got) <= set(rows)
    assert {i for i, t in got} >= {11, 12, 13}  # no word, no evidence: they stay


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0
