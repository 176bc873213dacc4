"""Exact substring dedup by longest-previous-factor arrays.

In suffix order, a position's nearest neighbours with smaller positions (previous and next smaller values) hold the
longest match that starts earlier; where that factor has at least `window` bytes, the window is a later copy and goes,
while the first occurrence stays. lpf() does this for one byte string.

For a corpus, windows are dealt out so that equal ones meet: a window's key is the least hash of its K-byte grams (its
minimiser), and consecutive windows of one key travel as one string (a "run" of at most window - K + 1 starts). Runs
of equal bytes are settled by their hash: all but the first are later copies. Only keys with several different runs
need bytes: their runs are concatenated in corpus order, suffixes are sorted to the depth of a window, and previous /
next smaller positions mark the later windows. Keys that are shared by very many different runs (a common line in
ever new surroundings) are dealt out anew, each window by the hash of all its bytes, so that no key gathers many rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, cut, join_blobs, mix64, pack, split_blobs, total_bytes, unpack

WINDOW, GRAM = 100, 32
#: Bytes hashed at once, and bytes after which runs are sent.
SLICE, FLUSH = 1 << 20, 24 << 20
#: A key with about so many different runs is hot, or with the 2^-22nd part of all runs if that is more (so that the list of hot keys has 32 MB
#: at most). Runs are counted where their hash is a multiple of SHARE, wherever they stand.
HOT, SHARE = 4096, 16
#: Bytes whose suffixes are sorted at once.
SORT = 1 << 20
NULL_ID = np.iinfo(np.int64).max

# ---------------------------------------------------------------- one byte string


def suffix_array(data: bytes) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling."""
    n = len(data)
    rank = np.frombuffer(data, np.uint8).astype(np.int64)
    order, h = np.argsort(rank, kind="stable"), 1
    while n and h < 2 * n:
        key = rank * (max(n, 256) + 2)
        key[: n - h] += rank[h:] + 1 if h < n else 0
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            break
        h *= 2
    return order


def smaller_neighbours(values: list[int]) -> tuple[list[int], list[int]]:
    """Indices of the previous and the next smaller value of each, -1 where there is none."""
    before, after, stack = [-1] * len(values), [-1] * len(values), []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            after[stack.pop()] = i
        before[i] = stack[-1] if stack else -1
        stack.append(i)
    return before, after


def common_prefix(data: bytes, i: int, j: int) -> int:
    n = 0
    while max(i, j) + n < len(data) and data[i + n] == data[j + n]:
        n += 1
    return n


def lpf(data: bytes) -> tuple[list[int], list[int]]:
    """For each position: length of the longest factor that also starts earlier, and such an earlier start (-1: none)."""
    order = suffix_array(data).tolist()
    before, after = smaller_neighbours(order)
    length, source = [0] * len(data), [-1] * len(data)
    for k, i in enumerate(order):
        for near in (before[k], after[k]):
            if near >= 0 and (n := common_prefix(data, order[near], i)) > length[i]:
                length[i], source[i] = n, order[near]
    return length, source


# ---------------------------------------------------------------- windows of a corpus

_BYTES = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
_STEPS = list(mix64(np.arange(1, 17, dtype=np.uint64)) * np.uint64(4) + np.uint64(3))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k bytes on end (k a power of two)."""
    h, span, i = _BYTES[data], 1, 0
    while span < k:
        h = h[:-span] * _STEPS[i] + h[span:]
        h ^= h >> np.uint64(31)
        span, i = 2 * span, i + 1
    return mix64(h)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    n, span, m = len(h) - w + 1, 1, h
    while 2 * span <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[w - span : w - span + n])


def _highest(keys: np.ndarray, w: int) -> np.ndarray:
    """For each gram, the highest key of the windows that hold it."""
    padded = np.full(len(keys) + 2 * (w - 1), ~np.uint64(0))
    padded[w - 1 : w - 1 + len(keys)] = ~keys
    return ~sliding_min(padded, w)


#: Bit of a run's number of windows.
BENDS = 128


def runs_of(pieces: list[tuple[int, int, bytes]], window: int, gram: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, hash, document, start, number of windows with BENDS) of all runs in pieces (document, offset, bytes)."""
    width = window - gram + 1
    data = b"".join(p[2] for p in pieces)
    buf = np.frombuffer(data, np.uint8)
    grams = gram_hashes(buf, gram)
    keys = sliding_min(grams, width)
    # a run that holds its key's gram twice may repeat windows within itself (BENDS)
    chosen = np.flatnonzero(_highest(keys, width) == grams)
    twice = np.concatenate([[0], np.cumsum(grams[chosen][1:] == grams[chosen][:-1])]) if len(chosen) else np.zeros(1, np.int64)
    sizes = np.array([len(p[2]) for p in pieces], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    usable = np.zeros(len(buf) + 1, np.int8)
    np.add.at(usable, first, 1)
    np.add.at(usable, first + sizes - window + 1, -1)
    usable = np.cumsum(usable[: len(keys)], dtype=np.int8).astype(bool)
    new = np.empty(len(keys), bool)
    new[0], new[1:] = True, (keys[1:] != keys[:-1]) | ~usable[:-1]
    new[first[first < len(keys)]] = True
    start = np.flatnonzero(new & usable)
    edge = np.flatnonzero(new | ~usable)
    end = np.append(edge, len(keys))[np.searchsorted(edge, start, "right")]
    many = -(-(end - start) // width)  # a run of like windows is cut
    part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    begin = np.repeat(start, many) + part * width
    n = np.minimum(np.repeat(end, many) - begin, width)
    key = keys[begin]
    low, high = np.searchsorted(chosen, begin), np.searchsorted(chosen, begin + n + width - 1) - 1
    bends = twice[np.maximum(high, 0)] - twice[np.minimum(low, len(twice) - 1)] > 0
    if len(hot) and (is_hot := np.isin(key, hot)).any():
        b, c = begin[is_hot], n[is_hot]
        single = np.repeat(b, c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        seen = np.array([xxhash.xxh3_64_intdigest(data[i : i + window], 1) for i in single.tolist()], np.uint64)
        begin, n, key = np.concatenate([begin[~is_hot], single]), np.concatenate([n[~is_hot], np.ones(len(single), n.dtype)]), np.concatenate([key[~is_hot], seen])
        bends = np.concatenate([bends[~is_hot], np.zeros(len(single), bool)])
    stop = (begin + n + window - 1).tolist()
    digest = np.array([xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(begin.tolist(), stop)], np.uint64)
    at = np.searchsorted(first, begin, "right") - 1
    docs = np.array([p[0] for p in pieces], np.int64)
    offsets = np.array([p[1] for p in pieces], np.int64)
    return key, digest, docs[at], (offsets[at] + begin - first[at]).astype(np.int64), (n + BENDS * bends).astype(np.uint8)


def _pieces(doc: int, raw: bytes, window: int) -> Iterator[tuple[int, int, bytes]]:
    step = SLICE - window + 1
    for at in range(0, max(1, len(raw) - window + 1), step):
        if len(raw) - at >= window:
            yield doc, at, raw[at : at + SLICE]


def _flushes(batches: Iterator[pa.RecordBatch], window: int, gram: int, hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    """(ids, text hashes, runs) for about FLUSH bytes at a time; runs name documents by their place in the first two."""
    ids, hashes, got, chunk, n_chunk, n = [], [], [], [], 0, 0

    def hashed():
        if chunk:
            got.append(runs_of(chunk, window, gram, hot))
            chunk.clear()

    def out():
        return np.array(ids, np.int64), np.array(hashes, np.uint64), tuple(np.concatenate(c) for c in zip(*got))

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if len(raw) < window:
                continue
            for p in _pieces(len(ids), raw, window):
                if n_chunk + len(p[2]) > SLICE:
                    hashed()
                    n_chunk = 0
                chunk.append(p)
                n_chunk += len(p[2])
            ids.append(NULL_ID if key is None else key)
            hashes.append(xxhash.xxh3_64_intdigest(raw))
            n += len(raw)
            if n >= FLUSH:
                hashed()
                yield out()
                ids, hashes, got, n_chunk, n = [], [], [], 0, 0
    hashed()
    if got:
        yield out()


def _split(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    columns = [c[order] for c in columns]
    edges = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])).tolist() if len(b) else []
    for i, j in zip(edges, [*edges[1:], len(b)]):
        yield int(b[i]), join_blobs([pack(c[i:j]) for c in columns])


def _frame(rows: list[tuple[int, bytes]], kind: int) -> pd.DataFrame:
    return pd.DataFrame({"bucket": pd.Series([r[0] for r in rows], dtype="int32"), "kind": pd.Series([kind] * len(rows), dtype="int32"), "blob": pd.Series([r[1] for r in rows], dtype=object)})


def _doc_bucket(ids: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    return (mix64(ids.view(np.uint64) ^ hashes) % np.uint64(n)).astype(np.int32)


def _later(key: np.ndarray, digest: np.ndarray, ids: np.ndarray, hashes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, digest, document, start) without rows of equal places; whether each begins a group; whether it is a later copy."""
    order = np.lexsort((start, hashes, ids, digest, key))
    k, d, i, h, s = (c[order] for c in (key, digest, ids, hashes, start))
    if not len(order):
        return order, np.empty(0, bool), np.empty(0, bool)
    group = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
    same = np.concatenate([[False], ~group[1:] & (i[1:] == i[:-1]) & (h[1:] == h[:-1]) & (s[1:] == s[:-1])])
    order, group = order[~same], group[~same]
    return order, group, ~group


RUNS, MARKS, WANTED, TEXTS = 0, 1, 2, 3
_ROW = "bucket int, kind int, blob binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])


def _hot_keys(rows: DataFrame, window: int, gram: int) -> np.ndarray:
    """Keys shared by very many different runs, wherever these stand: each flush counts the runs of its keys of which the hash is a
    multiple of SHARE, and the counts are summed over all. This only says how windows are dealt out."""

    def run(batches):
        for _, _, (key, digest, *_) in _flushes(batches, window, gram, np.empty(0, np.uint64)):
            some = digest % np.uint64(SHARE) == 0
            order = np.lexsort((digest[some], key[some]))
            k, d = key[some][order], digest[some][order]
            k, c = np.unique(k[np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])] if len(k) else k, return_counts=True)
            yield pa.record_batch([pa.array(np.append(k.view(np.int64), 0)), pa.array(np.append(c, 0)), pa.array(np.append(np.zeros(len(k), np.int64), len(key)))], names=["key", "n", "runs"])

    sums = rows.mapInArrow(run, "key long, n long, runs long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("runs").alias("runs"))
    sums = cut(sums.filter((F.col("n") >= max(1, HOT // SHARE)) | (F.col("runs") > 0)), "hot")
    total = sums.agg(F.sum("runs")).first()[0] or 0
    hot = sums.filter((F.col("n") >= max(1, HOT // SHARE, (total >> 22) // SHARE)) & (F.col("n") > 0)).select("key").toPandas()["key"]
    return np.sort(hot.to_numpy(np.int64).view(np.uint64))


def _sorted_windows(strings: list[bytes], counts: np.ndarray, window: int) -> np.ndarray:
    """Places, in the strings' concatenation, of windows that also start earlier in it. counts: windows of each string."""
    data = b"".join(strings) + bytes(window + 8)
    buf = np.frombuffer(data, np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    first = np.cumsum(sizes) - sizes
    starts = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    word = np.lib.stride_tricks.sliding_window_view(buf, 8)[: len(buf) - 8].copy().view(">u8").reshape(-1).astype(np.uint64)
    rank, depth = np.unique(word, return_inverse=True)[1].astype(np.uint64), 8
    while 2 * depth <= window:  # ranks of twice the depth, from pairs
        rank = np.unique((rank[:-depth] << np.uint64(32)) | rank[depth:], return_inverse=True)[1].astype(np.uint64)
        depth *= 2
    suffix = (rank[starts] << np.uint64(32)) | rank[starts + window - depth]
    order = np.argsort(suffix, kind="stable")  # suffixes in order, to the depth of a window
    s = suffix[order]
    same = np.concatenate([[False], s[1:] == s[:-1]])
    shared = same | np.append(same[1:], False)  # with a neighbour that agrees over a whole window
    place, edge = starts[order][shared], ~same[shared]
    # smaller positions count within stretches of such neighbours only: each stretch is raised above those before it
    stretch = np.cumsum(edge) - 1
    lifted = (place - stretch * len(data)).tolist()
    before, after = smaller_neighbours(lifted)
    st = stretch.tolist()
    factor = [(b >= 0 and st[b] == g) or (a >= 0 and st[a] == g) for b, a, g in zip(before, after, st)]
    return np.sort(place[np.array(factor, bool)]) if len(place) else place


def _settle(frames: pd.DataFrame, window: int, n_docs: int) -> pd.DataFrame:
    """Runs of one bucket: later copies of equal runs, and the runs whose bytes are wanted."""
    runs, marks = [], []
    for kind, blob in zip(frames["kind"], frames["blob"]):
        (runs if kind == RUNS else marks).append([unpack(x) for x in split_blobs(blob)])
    out = []
    if marks:
        ids, hashes, start, end = (np.concatenate(c) for c in zip(*marks))
        out.append(_frame(list(_split(_doc_bucket(ids, hashes, n_docs), [ids, hashes, start, end])), MARKS))
    if runs:
        key, digest, doc, start, n = ([] for _ in range(5))
        ids, hashes = [], []
        for a, b, table_ids, table_hashes, d, s, c in runs:
            key.append(a), digest.append(b), ids.append(table_ids[d]), hashes.append(table_hashes[d]), start.append(s), n.append(c)
        key, digest, ids, hashes, start, n = (np.concatenate(c) for c in (key, digest, ids, hashes, start, n))
        order, group, later = _later(key, digest, ids, hashes, start)
        key, ids, hashes, start, n = (c[order] for c in (key, ids, hashes, start, n))
        at = _doc_bucket(ids, hashes, n_docs)
        out.append(_frame(list(_split(at[later], [ids[later], hashes[later], start[later], start[later] + n[later] % BENDS + (window - 1)])), MARKS))
        firsts = key[group]
        _, which, several = np.unique(firsts, return_inverse=True, return_counts=True)
        want = np.flatnonzero(group)[(several[which] > 1) | (n[group] >= BENDS)]
        out.append(_frame(list(_split(at[want], [ids[want], hashes[want], start[want], n[want] % BENDS, key[want]])), WANTED))
    return pd.concat(out) if out else _frame([], 0)


def _places(ids: np.ndarray, hashes: np.ndarray, own_ids: list[int], own_hashes: list[int]) -> list[int]:
    where = {x: i for i, x in enumerate(zip(own_ids, own_hashes))}
    return [where[x] for x in zip(ids.tolist(), hashes.tolist())]


def _fetch(docs: pd.DataFrame, wanted: pd.DataFrame, window: int, n_keys: int) -> pd.DataFrame:
    """Bytes of wanted runs, dealt out by key."""
    if not len(wanted) or not len(docs):
        return _frame([], TEXTS)
    ids, hashes, start, n, key = (np.concatenate(c) for c in zip(*([unpack(x) for x in split_blobs(b)] for b in wanted["blob"])))
    order = np.lexsort((start, hashes, ids))
    ids, hashes, start, n, key = (c[order] for c in (ids, hashes, start, n, key))
    own = docs.drop_duplicates(["id", "hash"])
    place = _places(ids, hashes, own["id"].tolist(), own["hash"].to_numpy(np.int64).view(np.uint64).tolist())
    texts, plain, last = own["text"].tolist(), b"", -1
    strings = []
    for p, s, c in zip(place, start.tolist(), n.tolist()):
        if p != last:
            plain, last = zstandard.ZstdDecompressor().decompress(texts[p]), p
        strings.append(plain[s : s + c + window - 1])
    bucket = (mix64(key) % np.uint64(n_keys)).astype(np.int32)
    rows = []
    for b in np.unique(bucket).tolist():
        i = np.flatnonzero(bucket == b)
        text = zstandard.ZstdCompressor(level=1).compress(b"".join([strings[k] for k in i.tolist()]))
        rows.append((b, join_blobs([*(pack(c[i]) for c in (ids, hashes, start, n, key)), text])))
    return _frame(rows, TEXTS)


def _compare(frames: pd.DataFrame, window: int, n_docs: int) -> pd.DataFrame:
    """Suffix order over the runs of a bucket: marks for windows that also start earlier."""
    parts, strings = [], []
    for blob in frames["blob"]:
        *columns, text = split_blobs(blob)
        columns = [unpack(c) for c in columns]
        plain = zstandard.ZstdDecompressor().decompress(text, max_output_size=1 << 31)
        end = np.cumsum(columns[3].astype(np.int64) + (window - 1)).tolist()
        strings += [plain[i:j] for i, j in zip([0, *end], end)]
        parts.append(columns)
    ids, hashes, start, n, key = (np.concatenate(c) for c in zip(*parts))
    n = n.astype(np.int64)
    order = np.argsort(key, kind="stable")
    size = np.cumsum(n[order] + (window - 1))
    k = key[order]
    last = np.flatnonzero(np.append(k[1:] != k[:-1], True))  # keys stay whole
    found, used, at = [], 0, 0
    for e in last.tolist():
        if size[e] - used < SORT and e != len(k) - 1:
            continue
        some = order[at : e + 1]
        some = some[np.lexsort((start[some], hashes[some], ids[some]))]  # concatenated in corpus order
        places = _sorted_windows([strings[i] for i in some.tolist()], n[some], window)
        begin = np.cumsum(n[some] + (window - 1)) - (n[some] + (window - 1))
        which = np.searchsorted(begin, places, "right") - 1
        if len(places):
            split = np.concatenate([[True], (places[1:] != places[:-1] + 1) | (which[1:] != which[:-1])])
            i = np.flatnonzero(split)
            j = np.append(i[1:], len(places)) - 1
            rows = some[which[i]]
            found.append((ids[rows], hashes[rows], start[rows] + places[i] - begin[which[i]], start[rows] + places[j] - begin[which[i]] + window))
        at, used = e + 1, size[e]
    if not found:
        return _frame([], MARKS)
    ids, hashes, start, end = (np.concatenate(c) for c in zip(*found))
    return _frame(list(_split(_doc_bucket(ids, hashes, n_docs), [ids, hashes, start, end])), MARKS)


def spans_of(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes under intervals (touching ones are one)."""
    out: list[list[int]] = []
    for i in np.argsort(starts, kind="stable").tolist():
        s, e = int(starts[i]), int(ends[i])
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of UTF-8 bytes without the spans and without the characters of which a span takes a part."""
    keep, at = [], 0
    for s, e in spans:
        while s > at and raw[s] & 0xC0 == 0x80:
            s -= 1
        keep.append(raw[at:s])
        while e < len(raw) and raw[e] & 0xC0 == 0x80:
            e += 1
        at = e
    keep.append(raw[at:])
    return b"".join(keep)


def remove_repeats(df: DataFrame, key: str, text: str, carry: list[str] = (), window: int = WINDOW, gram: int = GRAM, characters: bool = False) -> DataFrame:
    """For each row: key, n_bytes, n_removed, n_spans, kept_sha256, spans (array of start, end in UTF-8 bytes), kept (the
    bytes that stay), then the carried columns but those that have the name of one of these.

    A byte goes if it lies in a string of `window` bytes that also starts earlier: in a row of smaller key, or in the
    same row further ahead. The key must be a whole number; null keys come last. Rows of one key and different texts
    come in the order of a hash of the text; rows of one key and text are one document and share a result. Null and empty texts, and
    those shorter than a window, lose nothing. With characters, kept leaves out the characters of which a part goes (the other columns
    stay as they are) and is null for null texts. window must exceed gram, a power of two. Nothing is sampled or capped: the
    list of hot keys only says how windows are dealt out.
    """
    if gram & (gram - 1) or not 8 <= gram < window or window - gram + 1 >= BENDS:
        raise ValueError("gram must be a power of two from 8 to below window, window - gram below 127")
    carry = list(carry)
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    n_buckets = buckets_for(total_bytes(rows))
    hot = _hot_keys(rows, window, gram)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, (key, digest, doc, start, n) in _flushes(batches, window, gram, hot):
            order, group, later = _later(key, digest, ids[doc], hashes[doc], start)
            key, digest, doc, start, n = (c[order] for c in (key, digest, doc, start, n))
            out = []
            d = doc[later]
            out.append(_frame(list(_split(_doc_bucket(ids[d], hashes[d], n_buckets), [ids[d], hashes[d], start[later], start[later] + n[later] % BENDS + (window - 1)])), MARKS))
            key, digest, doc, start, n = (c[group] for c in (key, digest, doc, start, n))
            bucket = (mix64(key) % np.uint64(n_buckets)).astype(np.int32)
            rank = np.argsort(bucket, kind="stable")
            edges = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=n_buckets))])
            blobs = []
            for b in range(n_buckets):
                i = rank[edges[b] : edges[b + 1]]
                if len(i):
                    i = i[np.lexsort((start[i], doc[i]))]
                    own, at = np.unique(doc[i], return_inverse=True)
                    blobs.append((b, join_blobs([pack(x) for x in (key[i], digest[i], ids[own], hashes[own], at.astype(np.uint32), start[i].astype(np.uint32) if start.max() < 1 << 32 else start[i], n[i])])))
            out.append(_frame(blobs, RUNS))
            for f in out:
                yield pa.RecordBatch.from_pandas(f, _ARROW, preserve_index=False)

    dealt = rows.mapInArrow(deal, _ROW)
    settled = cut(dealt.groupBy("bucket").applyInPandas(lambda p: _settle(p, window, n_buckets), _ROW), "settled")

    carried = df.select(*carry).schema

    def docs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts, ids, hashes, rest = [], [], [], []
            raw_ids = b.column(0).to_pylist()
            for x in b.column(1):
                raw = (x.as_py() or "").encode("utf-8", "surrogatepass")
                texts.append(zip_.compress(raw))
                hashes.append(xxhash.xxh3_64_intdigest(raw))
            ids = np.array([NULL_ID if x is None else x for x in raw_ids], np.int64)
            hashes = np.array(hashes, np.uint64)
            more = zip(*(b.column(2 + i).to_pylist() for i in range(len(carry)))) if carry else [()] * len(ids)
            rest = [pickle.dumps((x, t.is_valid, *v), 5) for x, t, v in zip(raw_ids, b.column(1), more)]
            yield pa.record_batch([pa.array(_doc_bucket(ids, hashes, n_buckets)), pa.array(ids), pa.array(hashes.view(np.int64)), pa.array(texts, pa.binary()), pa.array(rest, pa.binary())], names=["bucket", "id", "hash", "text", "rest"])

    def docs(with_rest: bool) -> DataFrame:
        extra = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
        out = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), *extra).mapInArrow(docs_of, "bucket int, id long, hash long, text binary, rest binary")
        return out if with_rest else out.select("bucket", "id", "hash", "text")

    texts = docs(False).groupBy("bucket").cogroup(settled.filter(F.col("kind") == WANTED).groupBy("bucket")).applyInPandas(lambda a, b: _fetch(a, b, window, n_buckets), _ROW)
    compared = texts.groupBy("bucket").applyInPandas(lambda p: _compare(p, window, n_buckets), _ROW)
    marks = settled.filter(F.col("kind") == MARKS).unionByName(compared)

    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]

    def finish(d: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        by: dict[tuple[int, int], tuple[int, int]] = {}
        if len(m):
            ids, hashes, start, end = (np.concatenate(c) for c in zip(*([unpack(x) for x in split_blobs(b)] for b in m["blob"])))
            order = np.lexsort((start, hashes, ids))
            ids, hashes, start, end = (c[order] for c in (ids, hashes, start, end))
            edge = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])])) if len(ids) else np.empty(0, int)
            for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(ids)]):
                by[int(ids[i]), int(hashes[i])] = (i, j)
        rows = []
        unzip = zstandard.ZstdDecompressor()
        for i, h, z, rest in zip(d["id"].tolist(), d["hash"].to_numpy(np.int64).view(np.uint64).tolist(), d["text"], d["rest"]):
            raw = unzip.decompress(z)
            found = spans_of(start[slice(*by[i, h])], end[slice(*by[i, h])]) if (i, h) in by else []
            at, keep = 0, []
            for s, e in found:
                keep.append(raw[at:s])
                at = e
            keep.append(raw[at:])
            kept = b"".join(keep)
            n_kept, digest = len(kept), hashlib.sha256(kept).hexdigest()
            own, given, *other = pickle.loads(rest)
            if characters:
                kept = whole_characters(raw, found) if given else None
            rows.append((own, len(raw), len(raw) - n_kept, len(found), digest, [{"start": s, "end": e} for s, e in found], kept, *other))
        return pd.DataFrame(rows, columns=[*names, *(f"c{i}" for i in range(len(carry)))])

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary" + "".join(f", c{i} {f.dataType.simpleString()}" for i, f in enumerate(carried.fields))
    out = docs(True).groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInPandas(finish, schema)
    return out.select(F.col("id").alias(key), *names[1:], *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry) if c not in (key, *names[1:])))
