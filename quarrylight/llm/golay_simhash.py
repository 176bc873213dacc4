"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is cut into segments, each padded to the 23 bits of the perfect binary Golay code. All codewords within 4
bits of a segment are its keys: one, or six where the nearest is 3 away; two segments within 2 bits of one another share one,
as the word halfway between lies within 3 of a codeword. Pigeonhole says how many segments have few errors:

* distance up to 2: of three segments one is equal and each other has at most 2 errors, so a key is an equal segment
  with a codeword of another;
* distance up to 8: of four segments two have at most 2 errors each, so a key is a pair of codewords.

Fingerprints that share a key are compared bit by bit; of those that agree, each bucket sends a spanning forest only.
Components come from alternating stars on these links. Copies collapse to one fingerprint before any of this.

keep_one() takes such components as candidates only: documents are near copies where their sets of word shingles have a Jaccard
similarity of 0.8 or more, counted exactly, and groups are the components of these links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut

SEED = 42
#: Generator polynomial of the (23, 12) Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Near copies: sets of so many words in a row with a similarity of so many parts in so many; sets in a block of a large component, and
#: about how many of its sets meet all of its blocks.
WORDS, PARTS, WHOLE = 5, 4, 5
BLOCK, HUBS = 256, 16


def _remainder(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= GENERATOR << bit - 11
    return v


_HIGH = np.array([_remainder(i << 11) for i in range(4096)], np.int64)


def _patterns() -> np.ndarray:
    """For each syndrome, the error patterns of weight 4 or less that have it, -1 where there are no more."""
    out: list[list[int]] = [[] for _ in range(2048)]
    for w in range(5):
        for bits in combinations(range(23), w):
            e = sum(1 << b for b in bits)
            out[_remainder(e)].append(e)
    table = np.full((2048, max(map(len, out))), -1, np.int64)
    for s, es in enumerate(out):
        table[s, : len(es)] = es
    return table


_ERRORS = _patterns()


def codewords(v: np.ndarray) -> np.ndarray:
    """12-bit indices of all codewords within 4 bits of each 23-bit value, one row each, -1 where there are no more."""
    v = v.astype(np.int64)
    e = _ERRORS[_HIGH[v >> 11] ^ (v & 2047)]
    return np.where(e < 0, -1, (v[:, None] ^ e) >> 11)


def keys(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, key) such that any two fingerprints within this distance share a key."""
    if not 0 <= distance <= 8:
        raise ValueError("distance must be from 0 to 8")
    widths = (22, 21, 21) if distance <= 2 else (16, 16, 16, 16)
    at = np.cumsum((0, *widths[:-1]))
    seg = [(fp >> np.uint64(a)).astype(np.int64) & ((1 << w) - 1) for a, w in zip(at.tolist(), widths)]
    codes = [codewords(s) for s in seg]
    rows, out = [], []
    if distance <= 2:
        for i in range(3):
            c = codes[(i + 1) % 3]
            r, k = np.nonzero(c >= 0)
            rows.append(r)
            out.append((i << 34) | (seg[i][r] << 12) | c[r, k])
    else:
        for t, (i, j) in enumerate(combinations(range(4), 2)):
            both = (codes[i][:, :, None] << 12 | codes[j][:, None, :]).reshape(len(fp), -1)
            ok = ((codes[i] >= 0)[:, :, None] & (codes[j] >= 0)[:, None, :]).reshape(len(fp), -1)
            r, k = np.nonzero(ok)
            rows.append(r)
            out.append((t << 24) | both[r, k])
    return np.concatenate(rows), np.concatenate(out)


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """64-bit SimHash: A-Z lower-cased, words between ASCII white space, shingles joined by blanks (fewer words: all of
    them), XXH64; a bit is set where over half the shingles have it. No word: 0."""
    words = raw.lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:n].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        h = np.array([digest(plain[i:j], SEED) for i, j in zip(starts[at : at + 8192], stops[at : at + 8192])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str, text: str, shingle: int = 3) -> DataFrame:
    """key and fp (the 64 bits as a long). Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint((x.as_py() or "").encode("utf-8", "surrogatepass"), shingle) for x in b.column(1)], np.uint64)
            yield pa.record_batch([b.column(0), pa.array(fp.view(np.int64))], names=["key", "fp"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, f"key {kind}, fp long")


def forest(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within one bucket: each member is reached from one that is linked to it."""
    out, left = [], np.arange(len(fp))
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[i]) <= distance
            if near.any():
                new = left[near].tolist()
                left = left[~near]
                queue += new
                out += [(i, j) for j in new]
    return out


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) in the order of keys -> links; a bucket that goes over a batch's end is kept for the next."""
    held_k, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)

    def bucket_links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
        size = np.diff(np.append(edge, len(k)))
        pair = edge[size == 2]
        pair = pair[np.bitwise_count(f[pair] ^ f[pair + 1]) <= distance] if len(pair) else pair
        a, b = [f[pair]], [f[pair + 1]]
        more = []
        for s, n in zip(edge[size > 2].tolist(), size[size > 2].tolist()):
            more += [(s + i, s + j) for i, j in forest(f[s : s + n], distance)]
        if more:
            m = np.array(more)
            a.append(f[m[:, 0]])
            b.append(f[m[:, 1]])
        x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        low, high = np.minimum(x, y), np.maximum(x, y)
        if len(low):
            both = np.unique(np.stack([low, high], 1), axis=0)
            low, high = both[:, 0], both[:, 1]
        return pa.record_batch([pa.array(high), pa.array(low)], names=["a", "b"])

    for batch in batches:
        k = np.concatenate([held_k, batch.column(0).to_numpy()])
        f = np.concatenate([held_f, batch.column(1).to_numpy().view(np.uint64)])
        if not len(k):
            continue
        last = int(np.searchsorted(k, k[-1])) if k[-1] == k.max() else len(k)
        held_k, held_f = k[last:], f[last:]
        yield bucket_links(k[:last], f[:last])
    yield bucket_links(held_k, held_f)


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b), a > b: links that connect all fp of a table without repeats that lie within this distance."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.column(0).to_numpy()
            for at in range(0, len(f), 4096):
                part = f[at : at + 4096]
                r, k = keys(part.view(np.uint64), distance)
                yield pa.record_batch([pa.array(k), pa.array(part[r])], names=["key", "fp"])

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.select("fp").mapInArrow(emit, "key long, fp long").repartition(n, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda it: _links(it, distance), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of edges (a, b), by alternating large and small stars; root is the least node.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    e, before = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"), None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select("a", F.col("m").alias("b")))
        seen = Observation()  # counted while it is written
        e = cut(small.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "stars")
        state = seen.get
        if state == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state


def near_groups(df: DataFrame, key: str, text: str, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row for each row of df: key, fp, component_id (the smallest key reachable over fingerprints within `distance`).

    Null and empty texts have fingerprint 0 and link like any other; a null key is never a component's id unless it has
    no other; rows of one key keep their own fingerprints. Any group size and any number of repeated rows will do: links are looked
    for between different fingerprints only. An empty table gives no rows.
    """
    docs = cut(fingerprints(df, key, text, shingle), "fingerprints")
    own = cut(docs.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    stars = components(links(own, distance))
    member = own.join(stars, own["fp"] == stars["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut(member.join(least, "root").select("fp", "component_id"), "components")
    return docs.join(named, "fp").select(F.col("key").alias(key), "fp", "component_id")


def shingle_set(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted XXH64 of the distinct shingles of a text; words as in fingerprint (fewer words: all of them; no word: none)."""
    w = raw.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), SEED) for i in range(max(1, len(w) - words + 1))], np.uint64))


def similar_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of sets whose Jaccard similarity is PARTS / WHOLE or more."""
    sets = [np.asarray(s, np.uint64) for s in sets]
    size = np.array([len(s) for s in sets], np.int64)
    out, left = [], np.flatnonzero(size)  # an empty set is like no other
    _, at = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True)
    ends = np.cumsum(size)
    own = [at[e - n : e] for e, n in zip(ends.tolist(), size.tolist())]
    has = np.zeros(int(at.max()) + 1 if len(at) else 0, bool)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            fit = np.flatnonzero(WHOLE * np.minimum(size[left], size[i]) >= PARTS * np.maximum(size[left], size[i]))
            if not len(fit):
                continue
            has[own[i]] = True
            n = size[left[fit]]
            both = np.add.reduceat(has[np.concatenate([own[j] for j in left[fit].tolist()])].astype(np.int64), np.cumsum(n) - n)
            has[own[i]] = False
            near = fit[WHOLE * both >= PARTS * (n + size[i] - both)]
            new = left[near].tolist()
            left = np.delete(left, near)
            queue += new
            out += [(i, j) for j in new]
    return out


def _sketches(df: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """key, id (SHA-256 of the text), fp, same (128 bits of the set of shingles) of each row; null texts count as empty, their id is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in b.column(2)]
            fp = np.array([fingerprint(x, shingle) for x in raw], np.uint64)
            same = [xxhash.xxh3_128_digest(shingle_set(x).tobytes(), SEED) for x in raw]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fp.view(np.int64)), pa.array(same, pa.binary())], names=["key", "id", "fp", "same"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("key"), F.sha2(df[text], 256).alias("id"), df[text].alias("text")).mapInArrow(run, f"key {kind}, id string, fp long, same binary")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, n, same, text) -> (root, n, same, s): the text's set of shingles, 8 bytes each."""
    for b in batches:
        s = [shingle_set((x.as_py() or "").encode("utf-8", "surrogatepass")).tobytes() for x in b.column(3)]
        yield pa.record_batch([*b.columns[:3], pa.array(s, pa.binary())], names=["root", "n", "same", "s"])


def _classes_of(p: pd.DataFrame) -> pd.DataFrame:
    """(root, a, b): each set that isn't the least of its class in this group, with that least one."""
    same = p["same"].tolist()
    least = list(range(len(same)))

    def find(i: int) -> int:
        while least[i] != i:
            least[i] = least[least[i]]
            i = least[i]
        return i

    for i, j in similar_forest([np.frombuffer(x, np.uint64) for x in p["s"]]):
        i, j = find(i), find(j)
        if i != j:
            i, j = sorted((i, j), key=same.__getitem__)
            least[j] = i
    out = [(same[i], same[find(i)]) for i in range(len(same)) if find(i) != i]
    return pd.DataFrame(out, columns=["a", "b"]).assign(root=p["root"].iloc[0])[["root", "a", "b"]].astype({"root": "int64"})


_SET = "root long, i int, j int, same binary, s binary"


def _dealt(rows: DataFrame, places) -> DataFrame:
    """A copy of each row of `rows` (root, same, s, more) for each (i, j) that places(own number, *more) gives; (root, a, b) of the
    classes within each (root, i, j)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for root, same, s, *more in zip(*(c.to_pylist() for c in b.columns)):
                to = places(int.from_bytes(same[:8], "little"), *more)
                for at in range(0, len(to), 64):
                    part = to[at : at + 64]
                    cols = [pa.array([root] * len(part), pa.int64()), pa.array([x for x, _ in part], pa.int32()), pa.array([y for _, y in part], pa.int32()), pa.array([same] * len(part), pa.binary()), pa.array([s] * len(part), pa.binary())]
                    yield pa.record_batch(cols, names=["root", "i", "j", "same", "s"])

    return rows.mapInArrow(deal, _SET).groupBy("root", "i", "j").applyInPandas(_classes_of, "root long, a binary, b binary")


def similar_classes(members: DataFrame) -> DataFrame:
    """(node, root): the least set of each class of similar sets, for all sets that aren't alone. members: root, n (members of the root),
    same, s (the set); sets are linked within one root only.

    A root of up to BLOCK members is compared as a whole. A larger one is cut into blocks, and each is compared together with about HUBS
    members of the root (hubs, picked by their hashes): what hangs together around a hub, as the copies of one document do, is then
    linked at a cost in proportion to its members. Only members whose classes are still apart are compared further, by pairs of
    blocks that hold different classes, so that no link is lost and none is looked for within a class.
    """

    def first(own: int, n: int) -> list[tuple[int, int]]:
        blocks = -(-n // BLOCK)
        if blocks > 1 and (own >> 20) % max(1, n // HUBS) == 0:
            return [(x, x) for x in range(blocks)]
        return [(own % blocks,) * 2]

    near = cut(_dealt(members.select("root", "same", "s", "n"), first), "near")
    large = members.filter(F.col("n") > BLOCK)
    roots = large.select("root").distinct()
    done = near.join(roots, "root", "left_anti")
    if not large.isEmpty():
        linked = near.join(roots, "root", "left_semi")
        more = cut(_dealt(_apart(large, components(linked)), _between), "apart")
        linked = linked.unionByName(more)
        stars = components(linked)
        done = done.select("a", "b").unionByName(stars.filter("node <> root").toDF("a", "b"))
    return done.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(done.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _apart(large: DataFrame, stars: DataFrame) -> DataFrame:
    """Members of roots with several classes, and how their root is cut: root, same, s, lo and m (first block and number of blocks of its
    class, null for small classes), shared (blocks of the small classes), all (blocks of the root)."""
    classed = large.join(stars.select("node", F.col("root").alias("star")), large["same"] == F.col("node"), "left").select("root", "same", "s", F.coalesce("star", "same").alias("class"))
    sizes = cut(classed.groupBy("root", "class").agg(F.count(F.lit(1)).alias("c")), "classes")
    # a class of BLOCK members or more has blocks of its own, the others share some: no list has more than a root's blocks
    big = F.collect_list(F.when(F.col("c") >= BLOCK, F.struct("class", F.ceil(F.col("c") / BLOCK).cast("int").alias("m"))))
    plan = sizes.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum(F.when(F.col("c") < BLOCK, F.col("c"))), F.lit(0)).alias("rest"), F.array_sort(big).alias("big")).filter("k > 1")
    rest = F.ceil(F.col("rest") / BLOCK).cast("int")
    before = F.aggregate(F.filter("big", lambda x: x["class"] < F.col("class")), F.lit(0), lambda t, x: t + x["m"])
    own = F.get(F.filter("big", lambda x: x["class"] == F.col("class")), 0)["m"]
    total = F.aggregate("big", F.lit(0), lambda t, x: t + x["m"])
    return classed.join(plan, "root").select("root", "same", "s", F.when(own.isNotNull(), rest + before).alias("lo"), own.alias("m"), rest.alias("shared"), (rest + total).alias("all"))


def _between(number: int, lo: int | None, m: int | None, shared: int, blocks: int) -> list[tuple[int, int]]:
    """Pairs of blocks in which a member meets all that aren't of its class."""
    if m is None:  # shares its block with other small classes
        at = number % shared
        return [(min(at, x), max(at, x)) for x in range(blocks)]
    at = lo + number % m
    return [(min(at, x), max(at, x)) for x in range(blocks) if not lo <= x < lo + m]


def keep_one(df: DataFrame, key: str, text: str, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of each group of near copies, with the columns of df: that of the smallest key (null is the greatest), of equal keys that
    of the least SHA-256 of the text. Key and text name a row: rows of one key or none with different texts are rows of their own, and
    of rows that share both one stays.

    Rows whose fingerprints (over `shingle` words) hang together within `distance` are candidates; two of them are linked where their
    sets of WORDS words in a row are similar by PARTS / WHOLE or more, and groups are the components of these links. Texts with
    equal sets are linked everywhere; an empty table gives no rows.
    """
    rows = cut(_sketches(df, key, text, shingle), "sketches")
    stars = components(links(cut(rows.select("fp").distinct(), "distinct"), distance))
    pairs = rows.select("fp", "same").distinct()
    member = cut(pairs.join(stars, pairs["fp"] == stars["node"], "left").select(F.coalesce("root", "fp").alias("root"), "same").distinct(), "candidates")
    many = member.join(member.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "root")
    # nulls last: of equal keys the least text
    who = F.min(F.struct(F.col("key").isNull().alias("none"), "key", F.col("id").isNull().alias("blank"), "id")).alias("who")
    first = cut(rows.groupBy("same").agg(who), "firsts")
    wanted = many.join(first, "same").select("root", "n", "same", F.col("who.key").alias("__key"), F.col("who.id").alias("__id"))
    texts = df.select(df[key].alias("__k"), F.sha2(df[text], 256).alias("__i"), df[text].alias("text"))
    here = texts.join(wanted, texts["__k"].eqNullSafe(wanted["__key"]) & texts["__i"].eqNullSafe(wanted["__id"])).select("root", "n", "same", "text")
    sets = cut(here.mapInArrow(_sets, "root long, n long, same binary, s binary").dropDuplicates(["root", "same"]), "sets")
    groups = similar_classes(sets)
    named = first.join(groups, first["same"] == groups["node"], "left").select("same", F.coalesce(groups["root"], first["same"]).alias("group"), "who")
    best = named.join(named.groupBy("group").agg(F.min("who").alias("best")), "group").select("same", "best")
    times = rows.groupBy("key", "id", "same").agg((F.count(F.lit(1)) > 1).alias("again"))
    judged = times.join(best, "same").select(F.col("key").alias("__key"), F.col("id").alias("__sha"), "again", (F.col("key").eqNullSafe(F.col("best.key")) & F.col("id").eqNullSafe(F.col("best.id"))).alias("stays"))
    # what goes is a small part, and few rows share key and text: neither moves the other texts
    judged = cut(judged.filter("again or not stays"), "judged")
    marked = df.withColumn("__id", F.sha2(df[text], 256))

    def at(t: DataFrame):
        return marked[key].eqNullSafe(t["__key"]) & marked["__id"].eqNullSafe(t["__sha"])

    repeated = judged.filter("again and stays")
    out = marked.join(judged, at(judged), "left_anti")
    return out.unionByName(marked.join(repeated, at(repeated), "left_semi").dropDuplicates([key, "__id"])).drop("__id")
