"""Exact top-k inner-product search by dual cover trees.

Queries and data are both indexed. A cover tree's node holds a centre and a covering radius; its children lie within
the node's scale of it and more than half that scale apart. For a query node (centre q, radius a) and a data node
(centre r, radius b) no score is above q.r + a|r| + b|q| + ab; the pair goes if that is below the worst kth score that
any query of the node has so far.

At scale the top of the data's tree is a layer of pivots: every vector belongs to the cell of its nearest pivot, a cell
splits into blocks of bounded size (so copies of one vector don't gather), and query groups go, in blocks, only to the cells
that their bound doesn't exclude after a first search at home.

Bounds are doubles with room for their rounding, scores are integers: by floating-point products where these are exact (all sums below
2^53), by 64-bit integer products beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64

#: Vectors of a block and queries of a group; vectors for each pivot; pivots at most (this bounds what the driver holds).
BLOCK, GROUP, PER_PIVOT, PIVOTS = 4096, 512, 2048, 512
LEAF = 96
#: No score yet; the range of scores and of components.
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Share of |q||r| by which a bound or a product of doubles may be off.
OFF = 1e-9


def products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two int64 matrices, as int64; those beyond its range are the nearest in range."""
    if not len(q) or not len(r):
        return np.empty((len(q), len(r)), np.int64)
    if float(np.abs(q.astype(np.float64)).max()) * float(np.abs(r.astype(np.float64)).max()) * q.shape[1] < 2.0**62:
        return q @ r.T
    exact = q.astype(object) @ r.astype(object).T  # Python's integers
    return np.clip(exact, -MOST, MOST).astype(np.int64)


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    norm: float
    begin: int  # the node's points: a stretch of the tree's order
    end: int
    children: list[Node]
    packed: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def below(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centres, norms and radii of the children, as arrays."""
        if self.packed is None:
            c = self.children
            self.packed = np.array([x.centre for x in c]), np.array([x.norm for x in c]), np.array([x.radius for x in c])
        return self.packed


class CoverTree:
    """Batch-built; order lists the points so that each node's are consecutive."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.whole, points = points, points.astype(np.float64)
        self.points, self.leaf, self.order = points, leaf, []
        self.most = float(np.abs(points).max()) if points.size else 0.0
        if len(points):
            d = np.linalg.norm(points - points.mean(0), axis=1)
            start = int(np.argmin(d))
            self.root = self._node(start, np.arange(len(points)), np.linalg.norm(points - points[start], axis=1))
        self.order = np.array(self.order, np.int64)

    def _node(self, centre: int, members: np.ndarray, far: np.ndarray) -> Node:
        c, radius, begin = self.points[centre], float(far.max()), len(self.order)
        children: list[Node] = []
        if len(members) <= self.leaf or radius == 0:
            self.order += members.tolist()
        else:
            half = 2.0 ** (np.ceil(np.log2(radius)) - 1)  # children's scale: they cover the node's points
            at, d, left = centre, far, members
            while len(left):
                near = d <= half
                children.append(self._node(at, left[near], d[near]))
                left = left[~near]
                if len(left):
                    at = int(left[0])
                    d = np.linalg.norm(self.points[left] - self.points[at], axis=1)
        return Node(c, radius, float(np.linalg.norm(c)), begin, len(self.order), children)


class Search:
    """Queries of one group against blocks of data, one after another; keeps each query's k best."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.tree, self.k = CoverTree(vectors, 16), k
        self.ids, self.q, self.q_plain = ids[self.tree.order], vectors[self.tree.order], self.tree.points[self.tree.order]
        self.score = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), -1, np.int64)
        self.pairs = self.pruned = 0

    def known(self, least: np.ndarray) -> None:
        """Scores of which each query has k elsewhere (NONE: it has fewer): lower ones are of no use."""
        self.floor = least[self.tree.order]

    floor: np.ndarray | None = None

    def _worst(self, n: Node) -> float:
        kth = self.score[n.begin : n.end, -1]
        if self.floor is not None:
            kth = np.maximum(kth, self.floor[n.begin : n.end])
        least = int(kth.min())
        return -np.inf if least == NONE else float(least) * (1 - OFF) - 1 if least > 0 else float(least) * (1 + OFF) - 1

    def against(self, ids: np.ndarray, tree: CoverTree) -> None:
        """ids: of the tree's points."""
        if not len(ids) or not len(self.ids):
            return
        self.r, self.r_ids, self.r_plain = tree.whole[tree.order], ids[tree.order], tree.points[tree.order]
        self.plain = self.tree.most * tree.most * self.q.shape[1] < 2.0**53  # doubles are exact
        todo = [(self.tree.root, tree.root, np.inf)]
        while todo:
            q, r, bound = todo.pop()
            if bound < self._worst(q):
                self.pruned += 1
                continue
            if not q.children and not r.children:
                self._base(q, np.arange(r.begin, r.end))
                continue
            qs = q.children or [q]
            rs = r.children or [r]
            centres, norms, radii = r.below() if r.children else (r.centre[None, :], np.array([r.norm]), np.array([r.radius]))
            for a in qs:
                top = centres @ a.centre + a.radius * norms + radii * a.norm + a.radius * radii
                top += OFF * (1 + (a.norm + a.radius) * (norms + radii))
                open_ = np.flatnonzero(top >= self._worst(a))
                self.pruned += len(top) - len(open_)
                order = open_[np.argsort(top[open_], kind="stable")].tolist()  # the most promising pair is taken first
                if not a.children:  # leaves that are left are compared at one go
                    ends = [np.arange(rs[i].begin, rs[i].end) for i in order if not rs[i].children]
                    if ends:
                        self._base(a, np.concatenate(ends))
                    order = [i for i in order if rs[i].children]
                for i in order:
                    todo.append((a, rs[i], float(top[i])))

    def _base(self, q: Node, points: np.ndarray) -> None:
        self.pairs += (q.end - q.begin) * len(points)
        s = (self.q_plain[q.begin : q.end] @ self.r_plain[points].T).astype(np.int64) if self.plain else products(self.q[q.begin : q.end], self.r[points])
        ids = self.r_ids[points]
        s[self.ids[q.begin : q.end, None] == ids[None, :]] = NONE
        kth = self.score[q.begin : q.end, -1]
        if self.floor is not None:
            kth = np.maximum(kth, self.floor[q.begin : q.end])
        for i in np.flatnonzero((s >= kth[:, None]).any(1)).tolist():
            take = (s[i] >= kth[i]) & (s[i] != NONE)
            score = np.concatenate([self.score[q.begin + i], s[i][take]])
            found = np.concatenate([self.found[q.begin + i], ids[take]])
            best = np.lexsort((found, ~score))  # descending: ~ turns the order round without overflow
            best = best[np.sort(np.unique(found[best], return_index=True)[1])][: self.k]  # an id counts once, with its best vector
            self.score[q.begin + i], self.found[q.begin + i] = NONE, -1
            self.score[q.begin + i, : len(best)], self.found[q.begin + i, : len(best)] = score[best], found[best]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, found, score) of all that was found."""
        i, j = np.nonzero(self.score != NONE)
        return self.ids[i], self.found[i, j], self.score[i, j]


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    """Vectors of whole numbers, 4 or 8 bytes a component by their length."""
    out = np.empty((len(blobs), dim), np.int64)
    for i, b in enumerate(blobs):
        out[i] = np.frombuffer(b, np.int32 if len(b) == 4 * dim else np.int64)
    return out


def whole_numbers(x: np.ndarray, scale: float) -> bytes | None:
    """floor(scale * x), 4 bytes a component where that will do, else 8; components beyond 8 bytes are the nearest in range; null for
    vectors with a component that isn't finite."""
    if not np.isfinite(x).all():
        return None
    with np.errstate(over="ignore"):
        v = np.floor(scale * x)
    if (np.abs(v) < 2.0**31).all():
        return v.astype(np.int32).tobytes()
    return np.array([min(max(int(y), -MOST), MOST) if np.isfinite(y) else (MOST if y > 0 else -MOST) for y in v.tolist()], np.int64).tobytes()


def _fewest(ids: np.ndarray, blobs: list[bytes], k: int) -> np.ndarray:
    """Rows to keep: of equal vectors one row of each of the k + 1 smallest ids (more can't be among anyone's k best)."""
    seen: dict[bytes, tuple[int, int]] = {}  # ids kept, the last of them
    keep = []
    for i in np.argsort(ids, kind="stable").tolist():
        n, last = seen.get(blobs[i], (0, None))
        if n <= k and ids[i] != last:
            keep.append(i)
            seen[blobs[i]] = n + 1, ids[i]
    return np.array(keep, np.int64)


def top_k(df: DataFrame, key: str, vector: str, is_query: str, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows where the SQL predicate is_query holds: the k largest inner products of
    floor(scale * x) over all other rows, ties to the smaller key; all there are, if fewer.

    Vectors that are null, empty, or hold null or non-finite components take no part; vectors meet only those of their own
    length. Keys must be whole numbers, null keys take no part; rows of one key and the query's own key count as the query's own.
    Where a key has several vectors, the score of two keys is the largest of their pairs. Repeated rows and vectors and an empty
    table will do; further columns take no part. Components and scores beyond 64-bit integers count as the nearest in range.
    """

    def valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for key_, x, q in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                if key_ is None or not x.is_valid or not len(x) or x.values.null_count:
                    continue
                v = whole_numbers(x.values.to_numpy(zero_copy_only=False).astype(np.float64), scale)
                if v is not None:
                    for c, y in zip(out, (key_, len(x), v, bool(q))):
                        c.append(y)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.bool_()))], names=["id", "dim", "v", "q"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.expr(is_query).alias("q"))
    rows = rows.mapInArrow(valid, "id long, dim int, v binary, q boolean")
    rows = cut(rows.groupBy("id", "dim", "v").agg(F.max("q").alias("q")), "vectors")  # repeated rows say nothing more
    n = rows.count()
    n_pivots = max(1, min(PIVOTS, n // PER_PIVOT))
    sample = rows.select("dim", "v").orderBy(F.xxhash64("id"), "v").limit(n_pivots).toPandas()
    pivots = {int(d): _matrix(p["v"].tolist(), int(d)).astype(np.float64) for d, p in sample.drop_duplicates("v").groupby("dim")}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, v = b.column(1).to_numpy(), b.column(2).to_pylist()
            cell, far = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                i = np.flatnonzero(dims == d)
                x = _matrix([v[j] for j in i.tolist()], d).astype(np.float64)
                p = pivots.get(d, np.zeros((1, d)))
                with np.errstate(over="ignore", invalid="ignore"):
                    square = (x**2).sum(1)[:, None] - 2 * x @ p.T + (p**2).sum(1)[None, :]
                cell[i] = np.nan_to_num(square, nan=np.inf).argmin(1)  # any cell will do
                far[i] = np.linalg.norm(x - p[cell[i]], axis=1)
            yield pa.record_batch([*b.columns, pa.array(cell), pa.array(far)], names=["id", "dim", "v", "q", "cell", "far"])

    placed = cut(rows.mapInArrow(cells, "id long, dim int, v binary, q boolean, cell int, far double"), "cells")
    # at most PIVOTS rows, and one for each further dimension
    stats = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).toPandas()
    info = {(int(r.dim), int(r.cell)): (-(-int(r.n) // BLOCK), float(r.far)) for r in stats.itertuples()}

    def parts(batches: Iterator[pa.RecordBatch], each: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.to_pandas()
            many = np.array([info[d, c][0] if each == BLOCK else max(1, info[d, c][0] * BLOCK // (50 * each)) for d, c in zip(t["dim"].tolist(), t["cell"].tolist())], np.uint64)
            t["part"] = (mix64(t["id"].to_numpy(np.int64).view(np.uint64)) % np.maximum(many, np.uint64(1))).astype(np.int32) if len(t) else np.empty(0, np.int32)
            yield pa.RecordBatch.from_pandas(t[["dim", "cell", "part", "id", "v"]], preserve_index=False)

    shape = "dim int, cell int, part int, id long, v binary"
    data = placed.mapInArrow(lambda it: parts(it, BLOCK), shape)
    groups = placed.filter("q").mapInArrow(lambda it: parts(it, GROUP), shape)

    def joined(vs: pd.Series, dim: int) -> bytes:
        """Vectors of a group, all of one width."""
        blobs = vs.tolist()
        return b"".join(blobs) if len({len(b) for b in blobs}) == 1 else _matrix(blobs, dim).tobytes()

    def pack_group(p: pd.DataFrame) -> pd.DataFrame:
        ids = p["id"].to_numpy(np.int64)
        d, c, part = int(p["dim"].iloc[0]), int(p["cell"].iloc[0]), int(p["part"].iloc[0])
        return pd.DataFrame({"dim": [d], "cell": [c], "part": [part], "ids": [ids.tobytes()], "vs": [joined(p["v"], d)]})

    packed = cut(groups.groupBy("dim", "cell", "part").applyInPandas(pack_group, "dim int, cell int, part int, ids binary, vs binary"), "groups")

    def search(g: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(g) and len(d):
            ids, blobs = d["id"].to_numpy(np.int64), d["v"].tolist()
            keep = _fewest(ids, blobs, k)
            dim = int(d["dim"].iloc[0])
            tree = CoverTree(_matrix([blobs[i] for i in keep.tolist()], dim))  # one for all groups that come here
            for row in g.itertuples():
                q = np.frombuffer(row.ids, np.int64)
                width = np.int32 if len(row.vs) == 4 * dim * len(q) else np.int64
                s = Search(q, np.frombuffer(row.vs, width).reshape(len(q), dim).astype(np.int64), k)
                if len(row.floor):
                    s.known(np.frombuffer(row.floor, np.int64))
                s.against(ids[keep], tree)
                out.append(pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), s.results()))))
        return pd.concat(out).astype("int64") if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    by, hits = ["dim", "cell", "part"], "query_id long, vec_id long, score long"
    home = packed.select("dim", "cell", F.lit(0).alias("part"), "ids", "vs", F.lit(b"").alias("floor"))
    first = cut(home.groupBy(*by).cogroup(data.filter("part = 0").groupBy(*by)).applyInPandas(search, hits), "home")
    once = lambda h: h.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # noqa: E731  (an id may have several vectors)
    kth = once(first).groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select("query_id", F.get("s", k - 1).alias("kth"))

    queries = placed.filter("q").mapInArrow(lambda it: parts(it, GROUP), shape).join(kth, F.col("id") == F.col("query_id"), "left").select(*by, "id", "v", F.coalesce("kth", F.lit(NONE)).alias("kth"))

    def send(p: pd.DataFrame) -> pd.DataFrame:
        d, c = int(p["dim"].iloc[0]), int(p["cell"].iloc[0])
        v, ids = _matrix(p["v"].tolist(), d).astype(np.float64), p["id"].to_numpy(np.int64)
        floor = p["kth"].to_numpy(np.int64)
        centre = v.mean(0)
        radius, norm = float(np.linalg.norm(v - centre, axis=1).max()), float(np.linalg.norm(centre))
        worst = -np.inf if floor.min() == NONE else float(floor.min()) - OFF * abs(float(floor.min())) - 1
        out = []
        for (dim, cell), (many, far) in info.items():
            if dim != d:
                continue
            pivot = pivots[dim][cell] if dim in pivots else np.zeros(dim)
            top = float(pivot @ centre) + radius * float(np.linalg.norm(pivot)) + far * norm + radius * far
            if top + OFF * (1 + (norm + radius) * (float(np.linalg.norm(pivot)) + far)) >= worst:
                out += [(dim, cell, part, ids.tobytes(), joined(p["v"], d), floor.tobytes()) for part in range(many) if (cell, part) != (c, 0)]
        return pd.DataFrame(out, columns=["dim", "cell", "part", "ids", "vs", "floor"])

    away = queries.groupBy(*by).applyInPandas(send, "dim int, cell int, part int, ids binary, vs binary, floor binary")
    rest = away.groupBy(*by).cogroup(data.groupBy(*by)).applyInPandas(search, hits)
    best = once(first.unionByName(rest)).groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("rank", "b")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))
