import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarrylight.llm import mpeg_audio as M
from quarrylight.llm.queries import QUERIES


def test_round_trip_and_tags():
    rng = random.Random(0)
    for n in (0, 1, 63, 64, 936, 937, 938, 5000, 70000):
        payload = bytes(rng.choice((0xFF, 0xFB, 0xE0, rng.randrange(256))) for _ in range(n))
        media = M.store(payload)
        s = M.parse(media)
        assert M.read(media) == payload and all(s.checks) and not s.skipped and not s.truncated
        assert s.vbr["frames"] == len(s.headers) - 1 and s.vbr["bytes"] == len(media) - s.offsets[0] and len(s.vbr["toc"]) == 100
        assert s.duration == Fraction(1152 * (len(s.headers) - 1), 48000)
        for k, o in enumerate(s.offsets[1:]):
            assert M.seek(s, Fraction(1152 * k, 48000)) == o


def test_resynchronises_and_finds_damage():
    rng = random.Random(1)
    media = M.store(bytes(rng.randrange(256) for _ in range(5000)))
    whole = M.parse(media)
    at = whole.offsets[3]
    junk = media[:at] + b"\xff\xfbnoise\xff" * 9 + media[at:] + b"TAG" + b"Title".ljust(30, b"\0") + bytes(95)
    s = M.parse(junk)
    assert len(s.offsets) == len(whole.offsets) and s.resyncs == 1 and s.skipped == 72 and s.tags["v1.title"] == "Title"
    bad = bytearray(media)
    bad[at + 10] ^= 1  # side information
    assert [i for i, ok in enumerate(M.parse(bytes(bad)).checks) if not ok] == [3]
    with pytest.raises(ValueError):
        M.read(bytes(bad))
    assert M.parse(media[:-5]).truncated
    for foreign in (b"", b"\xff", b"plain text " * 50, b"ID3", bytes(1000)):
        assert M.parse(foreign).headers == [] and M.parse(foreign).duration == 0


def test_headers_of_all_layers():
    assert M.header(b"\xff\xfb\x90\x00").length == 417 and M.header(b"\xff\xfb\x92\x00").length == 418
    assert M.header(b"\xff\xf3\x40\xc0").samples == 576 and M.header(b"\xff\xfd\x80\x00").layer == 2
    one = M.header(b"\xff\xff\x10\x00")
    assert (one.layer, one.samples, one.length) == (1, 384, 32 * 12000 // 44100 * 4)
    assert M.header(b"\xff\xfb\xf0\x00") is None and M.header(b"\xff\xe9\x90\x00") is None
    assert M.crc16(b"123456789") == 0xAEE7


def test_layer_two_checksum_covers_allocation():
    h = M.header(b"\xff\xfc\x84\xc0")
    frame = bytearray(b"\xff\xfc\x84\xc0\0\0" + bytes(h.length - 6))
    part, bits = M._covered(h, bytes(frame))
    assert bits == 16 + sum(M.ALLOC["a"])
    frame[6] = 0x10
    assert M._covered(h, bytes(frame))[1] == bits + 2


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op1_media_columns"](spark, "/root/testdata/sf0.001").collect():
        raw = docs[r.doc_id].encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        media = M.store(p)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())


def test_edges_and_media_columns(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x" * 300_000)], "doc_id long, text string").withColumn("feature", F.lit(1))
    got = M.store_texts(df, "doc_id", "text", keep_media=True)
    rows = got.collect()
    assert sorted((r.n_bytes, r.payload_bytes) for r in rows) == [(0, 64)] * 3 + [(300_000, 300_032)]
    m = M.media_columns(got.unionByName(got.limit(1).withColumn("media", F.lit(None).cast("binary"))), "doc_id", "media").collect()
    assert len(m) == 5 and sum(r.frames is None for r in m) == 1 and all(r.crc_bad == 0 for r in m if r.frames)
    assert M.store_texts(df.limit(0), "doc_id", "text").count() == 0
