"""Master collections that a profile names: where each is now, and what it holds, by reference."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions import text as X
from quarrylight.operators.assertions import EvidenceError
from quarrylight.plans.profile import Profile, inside

# The arrays of records a master may have.
ARRAYS = {"records": "$.records", "composition_only_records": "$.composition_only_records", "screened_literature_records": "$.screened_literature_extracted_data.records"}
MODE = "authoritative_existing_json_referenced_without_copying"


def file_sha256(path: Path) -> str:
    with path.open("rb") as s:
        return hashlib.file_digest(s, "sha256").hexdigest().upper()


def pointed_at(root: Path, source: dict) -> Path | None:
    """What the pointer file of a master says under its keys, if that is a file."""
    pointer = source.get("pointer")
    if not pointer or not inside(root, pointer).exists():
        return None
    found = json.loads(inside(root, pointer).read_text("utf-8"))
    for key in source.get("pointer_keys", ()):
        if not isinstance(found, dict):
            return None
        found = found.get(key)
    there = inside(root, found) if isinstance(found, str) and found else None
    return there if there is not None and there.exists() else None


def indexed(root: Path, kind: str | None, index: list[dict]) -> Path | None:
    """The entry of an earlier run's index with this database_type; two of them, or other bytes than the entry says, raise."""
    heads = [e for e in index if kind and e.get("database_type") == kind]
    if len(heads) > 1:
        raise EvidenceError(f"several masters of type {kind} in the index")
    if not heads:
        return None
    path = inside(root, heads[0]["path"])
    if file_sha256(path) != heads[0]["sha256"].upper():
        raise EvidenceError(f"the bytes of {heads[0]['path']} have changed")
    return path


def master_paths(profile: Profile, root: Path, index: list[dict] = ()) -> list[Path]:
    """A path for each master source: from the index, else from its pointer, else as the profile states it. A few files, on the driver."""
    return [indexed(root, s.get("existing_index_type"), list(index)) or pointed_at(root, s) or inside(root, s["path"]) for s in profile.master_sources]


def master_profiles(spark: SparkSession, paths: list[Path], root: Path) -> DataFrame:
    """collection_id, path, sha256, size_bytes, schema_version, database_type, statistics (JSON text), record_counts, integration_mode.
    Each file is read by one executor; only its counts come back."""
    from collections.abc import Iterator

    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path in f["path"]:
                whole = Path(root, path)
                data = json.loads(whole.read_text("utf-8-sig"))
                n = []
                for place in ARRAYS.values():
                    part = data
                    for key in place.split(".")[1:]:
                        part = part.get(key) if isinstance(part, dict) else None
                    n.append(len(part or []))
                shown = [None if data.get(k) is None else str(data[k]) for k in ("schema_version", "database_type")]
                rows.append((path, file_sha256(whole), whole.stat().st_size, *shown, json.dumps(data.get("statistics"), ensure_ascii=False), *n))
            yield pd.DataFrame(rows, columns=["path", "sha256", "size_bytes", "schema_version", "database_type", "statistics", *ARRAYS])

    names = spark.createDataFrame([(p.relative_to(root).as_posix(),) for p in paths], "path string")
    got = names.mapInPandas(run, "path string, sha256 string, size_bytes long, schema_version string, database_type string, statistics string, " + ", ".join(f"{c} long" for c in ARRAYS))
    return got.select(X.stable_id("collection", F.col("path")).alias("collection_id"), "path", "sha256", "size_bytes", "schema_version", "database_type", "statistics", F.struct(*ARRAYS).alias("record_counts"), F.lit(MODE).alias("integration_mode"))


def latest(names: list[str], current: str = "evidence_fact_dispositions.json", stem: str = "evidence_fact_dispositions_") -> str | None:
    """Which file of decisions counts: the current one, else the snapshot of the greatest name, else none."""
    return current if current in names else max((n for n in names if n.startswith(stem) and n.endswith(".json")), default=None)
