"""Lineage cuts: a table written to the folder that all executors share, so that lost executors and later jobs don't compute it anew."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 (the session is gone: nothing can be done)
        pass


def shared_folder(spark: SparkSession) -> str:
    """A folder of this process below spark.checkpoint.dir, removed when it ends. Where the setting is missing a local session gets a
    temporary one, and a cluster is refused: its executors would write to disks of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base not in _FOLDERS:
        if base:
            _FOLDERS[base] = f"{base.rstrip('/')}/evidence-{uuid.uuid4().hex}"
            atexit.register(_remove, spark, _FOLDERS[base])
        elif spark.sparkContext.master.split("[")[0] == "local":
            own = tempfile.mkdtemp(prefix="evidence-")
            _FOLDERS[base] = f"file://{own}"
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _FOLDERS[base]


def cut(df: DataFrame, label: str) -> DataFrame:
    """df, written once and read back."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
