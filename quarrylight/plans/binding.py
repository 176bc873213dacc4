"""Binding of conclusions to the facts of a finished run: sources are hashed anew, outputs can't overwrite inputs, and a binding that is
older than its inputs is told from a fresh one."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.operators import context
from quarrylight.operators.assertions import EvidenceError, none_of
from quarrylight.plans import corpus
from quarrylight.plans.masters import file_sha256
from quarrylight.plans.profile import Profile, inside

# Fixed values.
VERSION = "1.0.0"
TRUST = "References and source bytes validated; semantic support, conflicts and conclusions require review."
INPUT = "conclusion_id string, text string, claim_type string, rationale string, evidence array<struct<fact_id:string,relation:string>>, conflicts array<struct<fact_ids:array<string>,description:string>>"


def digest(value: object) -> str:
    """Of canonical JSON, upper case."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest().upper()


def table_digest(df: DataFrame, key: str) -> str:
    """Of a table, whatever the order and the partitions of its rows: the count and the 128 bits of two sums of row hashes."""
    row = F.to_json(F.struct(*sorted(df.columns)))
    x = F.conv(F.left(F.sha2(row, 256), F.lit(15)), 16, 10).cast("decimal(38,0)")
    y = F.conv(F.substring(F.sha2(row, 256), 16, 15), 16, 10).cast("decimal(38,0)")
    n, a, b = df.select(key, x.alias("x"), y.alias("y")).agg(F.count(key), F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    return digest([n, str(a), str(b)])


def protect(destination: Path, inputs: list[Path], roots: list[Path]) -> None:
    """Raises unless destination is a JSON file of its own: none of the inputs, in none of the roots, and new or an earlier binding."""
    if destination.suffix.lower() != ".json" or destination in inputs or any(destination.is_relative_to(r) for r in roots):
        raise EvidenceError(f"{destination} is an input or no JSON file")
    if destination.exists():
        old = json.loads(destination.read_text("utf-8"))
        if not isinstance(old, dict) or old.get("schema_version") != VERSION or "input_sha256" not in old or not isinstance(old.get("conclusions"), list):
            raise EvidenceError(f"{destination} is there and is no binding")


def changed_sources(documents: DataFrame, used: DataFrame, root: str) -> DataFrame:
    """source_id, path of the documents (source_id, path, sha256) in use (source_id) whose bytes have changed or are gone. Only these are
    read, each once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            same = []
            for path, want in zip(f["path"], f["sha256"]):
                try:
                    same.append(file_sha256(Path(root, path)) == want.upper())
                except OSError:
                    same.append(False)
            yield f[["source_id", "path"]][[not s for s in same]]

    wanted = documents.select("source_id", "path", "sha256").join(used.select("source_id").distinct(), "source_id", "left_semi")
    return wanted.mapInPandas(run, "source_id string, path string")


def stale(bound: DataFrame, fresh: DataFrame, key: str = "conclusion_id") -> DataFrame:
    """key, change (missing, unknown, changed) of the rows in which a binding differs from one made anew (columns of the same names)."""
    as_text = lambda df, name: df.select(key, F.sha2(F.to_json(F.struct(*sorted(fresh.columns))), 256).alias(name))
    both = as_text(bound, "old").join(as_text(fresh, "new"), key, "full")
    change = F.when(F.col("old").isNull(), "missing").when(F.col("new").isNull(), "unknown").when(F.col("old") != F.col("new"), "changed")
    return both.select(key, change.alias("change")).filter("change IS NOT NULL")


def bind(spark: SparkSession, profile: Profile, root: str, output: str, conclusions: str, destination: str | None = None, validate_only: bool = False) -> dict:
    """Binds the conclusions of a JSON file (schema_version, conclusions) to the current run and writes the binding; with validate_only
    raises if the binding that is there isn't what would be written. Conclusions are written by people, so that the file is small; facts
    and documents stay distributed. Paths of conclusions and destination are relative to root."""
    base = Path(root).resolve()
    source = inside(base, conclusions)
    target = inside(base, destination) if destination else Path(output).resolve() / "conclusion_bindings.json"
    masters = [inside(base, m[k]) for m in profile.master_sources for k in ("path", "pointer") if m.get(k)]
    protect(target, [source, Path(output).resolve() / corpus.POINTER, *masters], [inside(base, p) for p in profile.canonical_roots.values()])
    payload = json.loads(source.read_text("utf-8"))
    if not isinstance(payload, dict) or payload.get("schema_version") != VERSION or not isinstance(payload.get("conclusions"), list):
        raise EvidenceError("conclusions need schema_version 1.0.0 and a list")
    given = spark.createDataFrame([json.dumps(c) for c in payload["conclusions"]], "string").select(F.from_json("value", INPUT).alias("c")).select("c.*")
    facts, documents = corpus.table(spark, output, "facts"), corpus.table(spark, output, "documents")
    links = given.select("conclusion_id", F.explode("evidence").alias("e")).select("conclusion_id", "e.fact_id", "e.relation")
    named = facts.join(F.broadcast(links.select("fact_id").distinct()) if len(payload["conclusions"]) < 10_000 else links.select("fact_id").distinct(), "fact_id", "left_semi")
    none_of(changed_sources(documents, named, root), "source bytes have changed; refresh the corpus first")
    checks = context.context_checks(context.locate(named, corpus.table(spark, output, "pages")), profile)
    conflicts = given.select("conclusion_id", F.explode("conflicts").alias("x")).select("conclusion_id", "x.fact_ids", "x.description")
    bound = context.bind_conclusions(given.drop("evidence", "conflicts"), links, conflicts, named, checks)
    rows = {json.loads(r)["conclusion_id"]: json.loads(r) for (r,) in bound.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()}
    result = {
        "schema_version": VERSION, "profile_sha256": profile.sha256, "input_sha256": digest(payload), "facts_sha256": table_digest(facts, "fact_id"), "documents_sha256": table_digest(documents, "source_id"),
        "trust_boundary": TRUST, "conclusions": [rows[c["conclusion_id"]] for c in payload["conclusions"]],
    }
    if validate_only:
        if not target.exists() or json.loads(target.read_text("utf-8")) != result:
            raise EvidenceError("the binding is stale or modified")
    else:
        corpus.write_atomic(target, json.dumps(result, ensure_ascii=False, indent=2) + "\n")
    return {"conclusions": len(rows), "binding_status": "references_validated_not_conclusion_verified", "output": str(target), "validate_only": validate_only}
