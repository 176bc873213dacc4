"""MPEG audio (layers I, II, III; versions 1, 2, 2.5) as media columns.

parse() resynchronises on frame headers, reads ID3v1/ID3v2 tags and Xing/Info/VBRI tables, verifies the 16-bit frame
checksums and gives exact durations (samples / rate) with the byte offset of every frame. store() puts any bytes
losslessly into a valid, silent, checksummed variable-bitrate layer III stream, as the frames' ancillary data (the
format's place for data of others); read() gets them back from the stored stream.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by (version 1?, layer), Hz by version bits, side-info bytes.
KBPS = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
# Layer II: bits of each subband's allocation field, by table (B.2a to B.2d and the low-rate table).
ALLOC = {"a": [4] * 11 + [3] * 12 + [2] * 4, "b": [4] * 11 + [3] * 12 + [2] * 7, "c": [4] * 2 + [3] * 6, "d": [4] * 2 + [3] * 10, "lsf": [4] * 4 + [3] * 7 + [2] * 19}


@dataclass(frozen=True)
class Header:
    version: int  # 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    layer: int
    protected: bool
    kbps: int
    rate: int
    padding: int
    mode: int  # 3: mono
    extension: int
    length: int  # bytes of the frame
    samples: int

    @property
    def side(self) -> int:
        """Bytes of layer III side information."""
        mono = self.mode == 3
        return (17 if mono else 32) if self.version == 3 else (9 if mono else 17)


@lru_cache(4096)
def header(b: bytes) -> Header | None:
    """The header in four bytes, None where they are none. Free format and reserved values count as none."""
    if len(b) < 4 or b[0] != 0xFF or b[1] & 0xE0 != 0xE0:
        return None
    version, layer = b[1] >> 3 & 3, 4 - (b[1] >> 1 & 3)
    k, r = b[2] >> 4, b[2] >> 2 & 3
    if version == 1 or layer == 4 or k in (0, 15) or r == 3 or b[3] & 3 == 2:
        return None
    kbps, rate, pad = KBPS[version == 3, layer][k], RATES[version][r], b[2] >> 1 & 1
    if layer == 1:
        samples, length = 384, (12000 * kbps // rate + pad) * 4
    else:
        samples = 576 if layer == 3 and version != 3 else 1152
        length = samples // 8 * 1000 * kbps // rate + pad
    return Header(version, layer, not b[1] & 1, kbps, rate, pad, b[3] >> 6, b[3] >> 4 & 3, length, samples)


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
        out.append(c)
    return out


_CRC = _crc_table()


@lru_cache(4096)
def crc16(data: bytes, n_bits: int = -1) -> int:
    """MPEG's frame checksum (polynomial 8005, start FFFF) of the first n_bits of data, or of all."""
    n_bits = 8 * len(data) if n_bits < 0 else n_bits
    crc = 0xFFFF
    for x in data[: n_bits // 8]:
        crc = (crc << 8 & 0xFFFF) ^ _CRC[crc >> 8 ^ x]
    for i in range(n_bits % 8):
        bit = data[n_bits // 8] >> 7 - i & 1
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if (crc >> 15) ^ bit else 0)
    return crc


def _covered(h: Header, frame: bytes) -> tuple[bytes, int] | None:
    """The bytes and number of bits that a protected frame's checksum covers."""
    if h.layer == 3:
        return frame[2:4] + frame[6 : 6 + h.side], -1
    channels, bound = (1 if h.mode == 3 else 2), 32
    if h.mode == 1:
        bound = 4 * (h.extension + 1)
    body = frame[6:]
    if h.layer == 1:
        n = 4 * (bound * channels + (32 - bound))if h.mode == 1 else 4 * 32 * channels
        return frame[2:4] + body, 16 + n
    each = h.kbps // channels
    if h.version != 3:
        table = ALLOC["lsf"]
    elif each >= 56 and (h.rate == 48000 or each <= 80):
        table = ALLOC["a"]
    elif each > 80:
        table = ALLOC["b"]
    else:
        table = ALLOC["d" if h.rate == 32000 else "c"]
    bits = int.from_bytes(body[:64].ljust(64, b"\0"), "big")
    at = used = 0
    for sb, n in enumerate(table):
        both = channels == 2 and not (h.mode == 1 and sb >= bound)
        for _ in range(2 if both else 1):
            if bits >> (512 - at - n) & ((1 << n) - 1):
                used += 1 if both else channels
            at += n
    return frame[2:4] + body, 16 + at + 2 * used


@dataclass
class Stream:
    offsets: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    checks: list[bool | None] = field(default_factory=list)  # None: frame without checksum
    skipped: int = 0  # bytes that belong to no frame and no tag
    resyncs: int = 0
    truncated: bool = False
    tags: dict[str, str] = field(default_factory=dict)
    private: dict[str, bytes] = field(default_factory=dict)
    vbr: dict[str, object] = field(default_factory=dict)

    @property
    def audio(self) -> int:
        """Index of the first frame that isn't the table's own."""
        return 1 if self.vbr else 0

    @property
    def samples(self) -> int:
        return sum(h.samples for h in self.headers[self.audio :])

    @property
    def duration(self) -> Fraction:
        """Exact seconds; the encoder's delay and padding, where a LAME table names them, are taken off."""
        if not self.headers:
            return Fraction(0)
        whole = sum((Fraction(h.samples, h.rate) for h in self.headers[self.audio :]), Fraction(0))
        cut = int(self.vbr.get("delay", 0)) + int(self.vbr.get("padding", 0))
        return max(Fraction(0), whole - Fraction(cut, self.headers[0].rate))


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _text(b: bytes) -> str:
    kinds = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}
    return b[1:].decode(kinds.get(b[0], "latin-1"), "replace").rstrip("\0") if b else ""


def _id3v2(data: bytes, at: int, out: Stream) -> int:
    """Bytes of the tag at this place, 0 if there is none."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10 or any(x & 0x80 for x in data[at + 6 : at + 10]):
        return 0
    major, flags, size = data[at + 3], data[at + 5], _syncsafe(data[at + 6 : at + 10])
    end, p = min(at + 10 + size, len(data)), at + 10
    if flags & 0x40 and major >= 3 and p + 4 <= end:  # extended header
        p += _syncsafe(data[p : p + 4]) if major == 4 else 4 + int.from_bytes(data[p : p + 4], "big")
    name, head = (3, 6) if major == 2 else (4, 10)
    while p + head <= end and data[p]:
        key = data[p : p + name].decode("latin-1")
        raw = data[p + name : p + 2 * name]
        n = _syncsafe(raw) if major == 4 else int.from_bytes(raw, "big")
        body = data[p + head : min(p + head + n, end)]
        if key.startswith("T"):
            out.tags[key] = _text(body)
        elif key == "PRIV":
            owner, _, rest = body.partition(b"\0")
            out.private[owner.decode("latin-1")] = rest
        p += head + n
    return 10 + size + (10 if major == 4 and flags & 0x10 else 0)


def _table(frame: bytes, h: Header, out: Stream) -> None:
    at = 4 + (2 if h.protected else 0) + h.side
    magic = frame[at : at + 4]
    if h.layer == 3 and magic in (b"Xing", b"Info"):
        flags, p = int.from_bytes(frame[at + 4 : at + 8], "big"), at + 8
        out.vbr["kind"] = magic.decode()
        for bit, key in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out.vbr[key] = int.from_bytes(frame[p : p + 4], "big")
                p += 4
        if flags & 4:
            out.vbr["toc"] = list(frame[p : p + 100])
            p += 100
        if flags & 8:
            out.vbr["quality"] = int.from_bytes(frame[p : p + 4], "big")
            p += 4
        if frame[p : p + 4] in (b"LAME", b"Lavf", b"Lavc") and len(frame) >= p + 24:
            three = int.from_bytes(frame[p + 21 : p + 24], "big")
            out.vbr |= {"delay": three >> 12, "padding": three & 0xFFF}
    elif h.layer == 3 and frame[36:40] == b"VBRI" and len(frame) >= 62:
        n_bytes, n_frames, entries, scale, each, per = struct.unpack(">IIHHHH", frame[46:62])
        raw = frame[62 : 62 + entries * each]
        out.vbr = {"kind": "VBRI", "bytes": n_bytes, "frames": n_frames, "frames_per_entry": per, "toc": [scale * int.from_bytes(raw[i : i + each], "big") for i in range(0, len(raw), each or 1)]}


def _same(a: Header, b: Header | None) -> bool:
    return b is not None and (a.version, a.layer, a.rate) == (b.version, b.layer, b.rate)


def parse(data: bytes) -> Stream:
    """All frames and tags of a byte string; never raises. Empty or foreign bytes give a stream without frames.

    After bytes that are no frame, a header counts only if another of the same version, layer and rate (or the end,
    or a tag) follows where its frame ends. A last frame that is cut off is left out, and truncated is set.
    """
    out, at, n, lost = Stream(), 0, len(data), 0
    if n >= 128 and data[-128:-125] == b"TAG":
        n -= 128
        for key, i, j in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97)):
            if value := data[n + i : n + j].split(b"\0")[0].decode("latin-1").strip():
                out.tags[f"v1.{key}"] = value
    while at < n:
        if k := _id3v2(data, at, out):
            at += k
            continue
        h = header(data[at : at + 4])
        if h and (lost or not out.headers or not _same(out.headers[-1], h)):
            after = at + h.length
            if after < n and not _same(h, header(data[after : after + 4])) and data[after : after + 3] != b"ID3":
                h = None
        if h is None:
            nxt = data.find(b"\xff", at + 1, n)
            tag = data.find(b"ID3", at + 1, n if nxt < 0 else nxt)
            to = tag if tag >= 0 else nxt if nxt >= 0 else n
            lost += to - at
            at = to
            continue
        if at + h.length > n:
            out.truncated = True
            lost += n - at
            break
        if lost:
            out.skipped, out.resyncs, lost = out.skipped + lost, out.resyncs + 1, 0
        frame = data[at : at + h.length]
        ok = None
        if h.protected:
            part, bits = _covered(h, frame)
            ok = crc16(part if h.layer == 3 else part[: (bits + 7) // 8], bits) == int.from_bytes(frame[4:6], "big")
        if not out.headers:
            _table(frame, h, out)
        out.offsets.append(at)
        out.headers.append(h)
        out.checks.append(ok)
        at += h.length
    out.skipped += lost
    return out


def seek(stream: Stream, seconds: Fraction) -> int:
    """Byte offset of the frame that plays at this time; the last one's beyond the end, -1 without frames."""
    t = Fraction(0)
    for o, h in zip(stream.offsets[stream.audio :], stream.headers[stream.audio :]):
        t += Fraction(h.samples, h.rate)
        if seconds < t:
            return o
    return stream.offsets[-1] if stream.offsets else -1


OWNER = "quarrylight.payload"
_SIDE = bytes(17)  # mono layer III: no main data, all gains and lengths zero, so silence


def _head(k: int) -> bytes:
    """MPEG-1 layer III, checksum, 48 kHz, mono; k: bitrate index."""
    b = bytes((0xFF, 0xFA, k << 4 | 1 << 2, 0xC0))
    return b + crc16(b[2:] + _SIDE).to_bytes(2, "big") + _SIDE


_HEADS = {k: _head(k) for k in range(1, 15)}
_ROOM = {k: 3 * KBPS[True, 3][k] - 23 for k in range(1, 15)}  # 48 kHz: a frame has exactly 3 bytes for each kbit/s
#: Time of one seek entry in features, in frames.
STRIDE = 16


def store(payload: bytes) -> bytes:
    """A valid stream that holds these bytes: ID3v2 tag with their number, Xing table, then frames with the bytes behind
    the side information. Every frame is of the largest bitrate but the last, which takes the least that will do."""
    frames, at, top = [], 0, _ROOM[14]
    whole = len(payload) // top
    frames = [_HEADS[14] + payload[i * top : i * top + top] for i in range(whole)]
    if rest := payload[whole * top :]:
        k = next(k for k in range(1, 15) if _ROOM[k] >= len(rest))
        frames.append(_HEADS[k] + rest.ljust(_ROOM[k], b"\0"))
    sizes = np.array([_ROOM[5] + 23, *map(len, frames)], np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = ends[(np.arange(100) * len(sizes)) // 100] * 256 // ends[-1]
    xing = b"Xing" + struct.pack(">III", 7, len(frames), int(ends[-1])) + at.astype(np.uint8).tobytes()
    priv = OWNER.encode() + b"\0" + len(payload).to_bytes(8, "big")
    body = b"PRIV" + len(priv).to_bytes(4, "big") + b"\0\0" + priv
    size = len(body)
    tag = b"ID3\x03\0\0" + bytes((size >> 21 & 127, size >> 14 & 127, size >> 7 & 127, size & 127)) + body
    return b"".join([tag, _HEADS[5], xing.ljust(_ROOM[5], b"\0"), *frames])


def read(media: bytes, stream: Stream | None = None) -> bytes:
    """The bytes that store() put in; ValueError where a checksum fails, frames are missing or no number is named."""
    s = stream or parse(media)
    n = int.from_bytes(s.private.get(OWNER, b""), "big") if OWNER in s.private else -1
    if n < 0 or s.skipped or s.truncated or not all(s.checks) or s.vbr.get("frames") != len(s.headers) - 1:
        raise ValueError("not a stored payload, or a damaged one")
    got = b"".join(media[o + 23 : o + h.length] for o, h in zip(s.offsets[1:], s.headers[1:]))
    if len(got) < n:
        raise ValueError("stored payload is too short")
    return got[:n]


def feature(s: Stream) -> str:
    d, kinds = s.duration, {h.kbps for h in s.headers[s.audio :]}
    return (
        f"mpeg1-layer3;frames={len(s.headers) - s.audio};samples={s.samples};duration={d.numerator}/{d.denominator};"
        f"kbps={min(kinds, default=0)}-{max(kinds, default=0)};crc_ok={sum(x is True for x in s.checks)};resyncs={s.resyncs};"
        f"seek={','.join(map(str, s.offsets[s.audio :: STRIDE]))}"
    )


COLUMNS = pa.schema([
    ("frames", pa.int64()), ("samples", pa.int64()), ("duration_num", pa.int64()), ("duration_den", pa.int64()),
    ("crc_ok", pa.int64()), ("crc_bad", pa.int64()), ("skipped_bytes", pa.int64()), ("resyncs", pa.int64()),
    ("truncated", pa.bool_()), ("tags", pa.map_(pa.string(), pa.string())), ("vbr_kind", pa.string()),
    ("vbr_frames", pa.int64()), ("seek_offsets", pa.list_(pa.int64())),
])
MEDIA_TYPES = "frames long, samples long, duration_num long, duration_den long, crc_ok long, crc_bad long, skipped_bytes long, resyncs long, truncated boolean, tags map<string,string>, vbr_kind string, vbr_frames long, seek_offsets array<long>"


def media_columns(df: DataFrame, key: str, media: str) -> DataFrame:
    """key and what parse() finds in a binary column: exact duration as a fraction, checksum counts, tags, offset of
    every frame. Null media: nulls but for the key. Other columns of df take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column(1).to_pylist():
                if x is None:
                    rows.append(dict.fromkeys(COLUMNS.names))
                    continue
                s = parse(x)
                d = s.duration
                rows.append({
                    "frames": len(s.headers) - s.audio, "samples": s.samples, "duration_num": d.numerator, "duration_den": d.denominator,
                    "crc_ok": sum(c is True for c in s.checks), "crc_bad": sum(c is False for c in s.checks), "skipped_bytes": s.skipped, "resyncs": s.resyncs,
                    "truncated": s.truncated, "tags": list(s.tags.items()), "vbr_kind": s.vbr.get("kind"), "vbr_frames": s.vbr.get("frames"), "seek_offsets": s.offsets[s.audio :],
                })
            t = pa.Table.from_pylist(rows, COLUMNS)
            yield from pa.table([b.column(0), *t.columns], names=[b.schema.names[0], *COLUMNS.names]).to_batches()

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("key"), df[media].alias("media")).mapInArrow(run, f"key {kind}, {MEDIA_TYPES}").withColumnRenamed("key", key)


def payload_of(text: str | None) -> tuple[bytes, int]:
    """A text's UTF-8 bytes with zeros up to a positive multiple of 64, and the number of bytes before."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0"), len(raw)


def store_texts(df: DataFrame, key: str, text: str, keep_media: bool = False) -> DataFrame:
    """Each text stored as an audio stream, read back from it, and described: digests of payload and stream, features.

    Null texts count as empty; empty texts give 64 zero bytes; repeated rows repeat. One pass without a shuffle, one text
    in memory at a time beside the batch. keep_media adds the stream itself.
    """
    names = ["key", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"] + ["media"] * keep_media

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in names[1:]]
            for x in b.column(1):
                payload, n = payload_of(x.as_py())
                media = store(payload)
                s = parse(media)
                back = read(media, s)
                if back != payload:
                    raise ValueError("a stored payload came back changed")
                values = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(s), media)
                for col, v in zip(rows, values):
                    col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.record_batch([b.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds))], names=names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", media binary" * keep_media
    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)
