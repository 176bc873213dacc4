"""Shared plumbing of the training-data operators: lineage cuts, byte packing, partition-local helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: list[str] = []
_RUNS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it. Where it is unset a local session (tests) gets a folder of this process, a
    cluster is refused: its executors would write to disks of their own."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="quarrylight-"))
        atexit.register(shutil.rmtree, _OWN_DIR[0], ignore_errors=True)
    return f"file://{_OWN_DIR[0]}"


def _removed(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 (the session is gone: nothing can be done)
        pass


def run_dir(spark: SparkSession) -> str:
    """The folder of this process's tables below the shared one, removed when the process ends."""
    base = shared_dir(spark)
    if base not in _RUNS:
        _RUNS[base] = f"{base}/quarrylight-{uuid.uuid4().hex}"
        atexit.register(_removed, spark, _RUNS[base])
    return _RUNS[base]


def settled(df: DataFrame, label: str) -> DataFrame:
    """df, cut unless it only reads, filters and projects files: so that each reading gives the same rows in the same order."""
    todo, plain = [df._jdf.queryExecution().optimizedPlan()], True
    while todo:
        node = todo.pop()
        plain = plain and node.nodeName() in ("Project", "Filter", "LogicalRelation", "Relation", "DataSourceV2Relation", "DataSourceV2ScanRelation")
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return df if plain and df._jdf.queryExecution().optimizedPlan().deterministic() else cut(df, label)


def cut(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: the plan is cut, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def total_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of the whole text column; sizes buckets, decides nothing about results."""
    return int(df.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def buckets_for(n_bytes: int, each: int = 16 << 20, least: int = 8) -> int:
    return max(least, -(-n_bytes // each))


_pack = zstandard.ZstdCompressor(level=1)


def pack(a: np.ndarray) -> bytes:
    """Lossless: byte planes of the array, compressed (equal high bytes of sorted or small numbers vanish)."""
    a = np.ascontiguousarray(a)
    head = f"{a.dtype.str},{len(a)};".encode()
    if not len(a):
        return head
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return head + _pack.compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes) -> np.ndarray:
    head, _, body = b.partition(b";")
    kind, n = head.decode().split(",")
    n, dt = int(n), np.dtype(kind)
    if not n:
        return np.empty(0, dt)
    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=n * dt.itemsize)
    planes = np.frombuffer(raw, np.uint8).reshape(dt.itemsize, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dt)


def pack_sorted(a: np.ndarray) -> bytes:
    """For ascending unsigned 64-bit keys: differences, then pack."""
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def join_blobs(parts: list[bytes]) -> bytes:
    """Several byte strings as one: count, lengths, bodies."""
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def split_blobs(b: bytes) -> list[bytes]:
    n = int(np.frombuffer(b, "<u4", 1)[0])
    sizes = np.frombuffer(b, "<u4", n, 4).astype(np.int64)
    at = 4 + 4 * n + np.concatenate([[0], np.cumsum(sizes)])
    return [b[i:j] for i, j in zip(at[:-1], at[1:])]


_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser over unsigned 64-bit arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x
