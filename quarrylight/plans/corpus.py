"""The whole run over a corpus folder: inventory, canonical sources, pages, facts, preserved evidence, dispositions, context, profiles,
manifest; written as Parquet tables of one run, which become current only when all are there."""

from __future__ import annotations

import datetime
import json
import os
import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.operators import context, datasets, documents, facts, inventory, merge
from quarrylight.operators.assertions import EvidenceError, none_of
from quarrylight.plans import masters
from quarrylight.plans.profile import Profile
from quarrylight.sources import files

POINTER = "current.json"
# What a manifest holds, and where.
SCHEMA = "1.0.0"
REQUIRED = {
    "": ("schema_version", "generated_at", "scope", "statistics", "artifacts", "quality_model"), "scope": ("root", "canonical_categories", "policy"), "statistics": (),
    "artifacts": ("source_inventory", "deduplication", "documents", "evidence_facts", "datasets", "tabular_data", "master_collections"),
    "quality_model": ("document_text", "fact_candidates", "dataset_profiles", "human_verification"),
}
ARTIFACTS = {"source_inventory": "inventory", "deduplication": "duplicates", "documents": "documents", "evidence_facts": "facts", "datasets": "datasets", "tabular_data": "cells", "master_collections": "masters"}
POLICY = "All files are listed; files of equal bytes count once, with the paths of the others."
QUALITY = {"document_text": "by page, from the file or from OCR", "fact_candidates": "found by machine, not verified", "dataset_profiles": "by machine", "human_verification": "kept where people have decided"}


def manifest_faults(manifest: object) -> list[str]:
    """What a manifest lacks."""
    if not isinstance(manifest, dict):
        return ["the manifest is no object"]
    out = []
    for part, keys in REQUIRED.items():
        held = manifest.get(part) if part else manifest
        if not isinstance(held, dict):
            out.append(f"{part} is missing or no object")
        else:
            out += [f"{part + '.' if part else ''}{k} is missing" for k in keys if k not in held]
    if "schema_version" in manifest and manifest["schema_version"] != SCHEMA:
        out.append(f"schema_version isn't {SCHEMA}")
    if "generated_at" in manifest and not isinstance(manifest["generated_at"], str):
        out.append("generated_at is no string")
    return out


def current(output: str) -> dict | None:
    p = Path(output, POINTER)
    return json.loads(p.read_text("utf-8")) if p.exists() else None


def table(spark: SparkSession, output: str, name: str) -> DataFrame:
    run = current(output)
    if run is None:
        raise FileNotFoundError(f"no finished run in {output}")
    return spark.read.parquet(f"{output}/{run['run']}/{name}")


def write_atomic(path: Path, text: str) -> None:
    pending = path.with_name(f".{path.name}.{uuid.uuid4().hex}.tmp")
    try:
        pending.write_text(text, "utf-8")
        os.replace(pending, path)
    finally:
        pending.unlink(missing_ok=True)


def refresh(spark: SparkSession, profile: Profile, root: str, output: str, overlays: list[DataFrame] = (), full: bool = False, inventory_only: bool = False, ocr: DataFrame | None = None) -> dict:
    """One incremental run. Pages of contents that an earlier run has are reused (unless full); facts are screened again with the
    present profile; facts and decisions of earlier runs stay. Nothing of an earlier run is touched; a failure leaves it current.

    ocr (sha256, page, ocr_text, as files.ocr_pages() reads it) stands in for thin pages of PDFs; documents that waited for it are read
    again. Tables of datasets, too, are read once for each content. Paths, categories and aliases are those of this run."""
    before = current(output)
    run = f"run-{uuid.uuid4().hex}"
    put = lambda df, name: (df.write.parquet(f"{output}/{run}/{name}"), spark.read.schema(df.schema).parquet(f"{output}/{run}/{name}"))[1]
    rows = put(files.inventory(spark, profile, root), "inventory")
    sources = put(inventory.canonical_sources(rows), "sources")
    put(inventory.duplicates(rows), "duplicates")
    if inventory_only:
        return {"run": run, "sources": sources.count()}
    old = {n: table(spark, output, n) for n in ("pages", "errors", "facts", "dispositions", "documents", "datasets", "cells")} if before else {}
    if old:
        none_of(old["facts"].join(sources, "source_id", "left_anti").select("fact_id"), "sources of preserved facts are missing")
    routed = inventory.route(sources)
    docs = routed.filter("is_document")
    reuse = bool(old) and not full
    kept = old["documents"].select("source_id") if reuse else None
    if reuse and ocr is not None:
        kept = kept.join(documents.awaiting_ocr(old["documents"], ocr), "source_id", "left_anti")
    new = docs.join(kept, "source_id", "left_anti") if reuse else docs
    read = files.contents(new.select("source_id", "path", "extension"), root)
    pdf = put(files.pdf_pages(read), "pdf_pages")  # parsed once
    errors = pdf.filter("error IS NOT NULL").select("source_id", "page", "error")
    found = pdf.filter("page > 0").join(docs.select("source_id", "sha256"), "source_id").select("source_id", F.upper("sha256").alias("sha256"), "page", "text")
    found = files.substitute_ocr(found, ocr) if ocr is not None else found.withColumn("text_source", F.lit("embedded"))
    pages = files.text_pages(read).unionByName(found.select("source_id", "page", "text", "text_source"))
    if reuse:
        stays = docs.join(kept, "source_id", "left_semi").select("source_id")
        pages, errors = (old[n].join(stays, "source_id", "left_semi").unionByName(x) for n, x in (("pages", pages), ("errors", errors)))
    errors = put(errors, "errors")
    pages = put(pages, "pages")
    made = facts.fact_candidates(pages, profile)
    previous = old["facts"].drop("origin") if old else made.limit(0)
    merged = put(merge.merge_preserved(made, merge.load_preserved(previous, list(overlays))), "facts")
    decisions = old["dispositions"] if old else merge.merge_dispositions(merged.limit(0), merged.limit(0).select("fact_id", "source_id", "page", "verification_status"))
    decisions = put(merge.merge_dispositions(merged, decisions), "dispositions")
    checks = put(context.context_checks(context.locate(merged, pages), profile), "context_checks")
    records = put(documents.document_records(docs, pages, merged, errors), "documents")
    put(documents.ocr_targets(records), "ocr_targets")
    tabular = routed.filter("is_dataset")
    fresh = tabular.join(old["datasets"].unionByName(old["cells"], allowMissingColumns=True).select("source_id").distinct(), "source_id", "left_anti") if reuse else tabular
    data = files.contents(fresh.select("source_id", "path", "extension"), root)
    read_now = {"datasets": files.dataset_profiles(data), "cells": files.cells(data)}
    if reuse:
        read_now = {n: old[n].join(tabular, "source_id", "left_semi").unionByName(x) for n, x in read_now.items()}
    profiles, cells = (put(x, n) for n, x in read_now.items())
    shapes = put(datasets.table_shapes(cells), "dataset_tables")
    put(datasets.table_columns(cells), "dataset_columns")
    index = [r.asDict() for r in table(spark, output, "masters").select("path", "sha256", "database_type").collect()] if before and "masters" in before["statistics"] else []  # a few
    heads = put(masters.master_profiles(spark, masters.master_paths(profile, Path(root), index), Path(root)), "masters")
    n = merge.merge_counts(merged).first().asDict()
    stats = {
        "files": rows.count(), "sources": sources.count(), "unreadable": rows.filter("sha256 IS NULL").count(), "pages": pages.count(), "documents": records.count(), "documents_reextracted": new.count(), "datasets_reprofiled": fresh.count(),
        "documents_awaiting_ocr": documents.ocr_targets(records).count(), "tables": shapes.count(), "malformed_rows": shapes.agg(F.coalesce(F.sum("malformed_row_count"), F.lit(0))).first()[0], "facts": merged.count(),
        "facts_needing_review": checks.filter("needs_review").count(), "dispositions": decisions.count(), "profile_failures": profiles.filter("distillation_status <> 'profiled'").count() + cells.filter("error IS NOT NULL").count(),
        "masters": heads.count(), "cells": cells.filter("row_no > 0").agg(F.coalesce(F.sum(F.size("cells")), F.lit(0))).first()[0], **n,
    }
    scope = {"root": str(root), "canonical_categories": sorted(profile.canonical_roots), "policy": POLICY}
    manifest = {"schema_version": SCHEMA, "scope": scope, "artifacts": ARTIFACTS, "quality_model": QUALITY, "run": run, "generated_at": datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), "fact_extraction_version": profile.version, "statistics": stats}
    write_atomic(Path(output, POINTER), json.dumps(manifest, ensure_ascii=False, indent=2) + "\n")
    return manifest


def recorded_sources(*records: DataFrame) -> DataFrame:
    """source_id of all records, once each."""
    ids = [r.select("source_id") for r in records]
    return reduce(DataFrame.union, ids).distinct()


def validate(spark: SparkSession, profile: Profile, output: str, root: str | None = None) -> list[str]:
    """What doesn't hold in the current run, as sentences; empty if all does. With root, the bytes of masters are hashed anew."""
    run = current(output)
    if run is None:
        return ["there is no finished run"]
    t = {n: table(spark, output, n) for n in ("inventory", "sources", "pages", "facts", "dispositions", "context_checks", "documents", "datasets", "cells")}
    stats, out = run["statistics"], manifest_faults(run)
    for name, key in (("inventory", "files"), ("sources", "sources"), ("pages", "pages"), ("facts", "facts"), ("dispositions", "dispositions")):
        if t[name].count() != stats[key]:
            out.append(f"{name} doesn't have the {stats[key]} rows of the manifest")
    if t["facts"].count() != t["facts"].select("fact_id").distinct().count():
        out.append("fact ids repeat")
    if not t["facts"].join(t["sources"], "source_id", "left_anti").isEmpty():
        out.append("facts name unknown sources")
    recorded = recorded_sources(t["documents"], t["datasets"], t["cells"])
    if not recorded.join(t["sources"], "source_id", "left_anti").isEmpty():
        out.append("records name unknown sources")
    routed = inventory.route(t["sources"]).filter("is_document or is_dataset")
    if not routed.join(recorded, "source_id", "left_anti").isEmpty():
        out.append("sources have no document or dataset record")
    if stats["unreadable"] or stats["profile_failures"]:
        out.append("some files can't be read")
    again = context.context_checks(context.locate(t["facts"], t["pages"]), profile).withColumn("fields", F.to_json("fields"))
    kept = t["context_checks"].withColumn("fields", F.to_json("fields"))
    if not again.exceptAll(kept).isEmpty() or not kept.exceptAll(again).isEmpty():
        out.append("context checks are stale")
    for m in table(spark, output, "masters").select("path", "sha256").collect() if root else ():
        path = Path(root, m.path)
        if not path.exists() or masters.file_sha256(path) != m.sha256:
            out.append(f"the master {m.path} has changed")
    if run["fact_extraction_version"] != profile.version:
        out.append("the profile has changed since")
    return out


def migrate(spark: SparkSession, profile: Profile, output: str, staging: str, apply: bool = False) -> dict:
    """Screens cached pages again into a new folder; without apply only counts. Old facts stay."""
    if os.path.exists(staging):
        raise EvidenceError(f"{staging} exists")
    merged = merge.merge_preserved(facts.fact_candidates(table(spark, output, "pages"), profile), table(spark, output, "facts").drop("origin"))
    if apply:
        merged.write.mode("errorifexists").parquet(f"{staging}/facts")
        merge.merge_dispositions(merged, table(spark, output, "dispositions")).write.mode("errorifexists").parquet(f"{staging}/dispositions")
    return merge.merge_counts(merged).first().asDict()


def export_json(df: DataFrame, path: str, order: list[str]) -> int:
    """An ordered JSON array, written row by row (nothing is gathered) and put in place when complete."""
    target, n = Path(path), 0
    pending = target.with_name(f".{target.name}.{uuid.uuid4().hex}.tmp")
    try:
        with pending.open("w", encoding="utf-8") as out:
            out.write("[")
            for row in df.orderBy(*order).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
                body = json.dumps(json.loads(row.j), ensure_ascii=False, indent=2).replace("\n", "\n  ")
                out.write(("," if n else "") + "\n  " + body)
                n += 1
            out.write("\n]\n" if n else "]\n")
        os.replace(pending, target)
    finally:
        pending.unlink(missing_ok=True)
    return n

