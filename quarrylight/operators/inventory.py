"""Inventory: one canonical source for each content, aliases and duplicates beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.functions import text as X

PRIORITY = {"paper": 0, "thesis": 1, "patent": 2, "dataset": 3}


def _ranked(rows: DataFrame) -> DataFrame:
    order = F.struct(F.coalesce(*(F.when(F.col("category") == c, F.lit(i)) for c, i in PRIORITY.items()), F.lit(9)).alias("p"), F.length("path").alias("n"), F.lower("path").alias("l"), F.col("path").alias("path"))
    return rows.filter(F.col("sha256").isNotNull()).withColumn("o", order)


def canonical_sources(rows: DataFrame) -> DataFrame:
    """rows: category, path, sha256 (null: unreadable), ... Of each content the row of the first category, shortest path, least
    path; with source_id, all_categories and alias_paths (in the same order). One aggregation, no window over a hot content's rows
    but for its list of aliases."""
    r = _ranked(rows)
    first = r.groupBy("sha256").agg(F.min_by(F.struct(*rows.columns), "o").alias("c"), F.array_sort(F.collect_set("category")).alias("all_categories"), F.array_sort(F.collect_list("o")).alias("os"))
    return first.select("c.*", X.source_id(F.col("sha256")).alias("source_id"), "all_categories", F.transform(F.slice("os", F.lit(2), F.greatest(F.size("os"), F.lit(1))), lambda o: o["path"]).alias("alias_paths"))


def duplicates(rows: DataFrame) -> DataFrame:
    """One row for each copy that isn't canonical (a repeated row is a copy), then the unreadable rows. Copies are compared with their
    content's first row; no window sorts the rows of a content that many files share."""
    r = _ranked(rows).groupBy("sha256", "o", "category").agg(F.count(F.lit(1)).cast("int").alias("times"))
    first = r.groupBy("sha256").agg(F.min(F.struct("o", "category")).alias("m"))
    own = F.struct("o", "category") == F.col("m")
    more = r.join(first, "sha256").withColumn("more", F.col("times") - F.when(own, 1).otherwise(0)).filter("more > 0")
    copies = more.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("more"))))
    out = copies.select("sha256", F.col("o.path").alias("duplicate_path"), F.col("category").alias("duplicate_category"), X.source_id(F.col("sha256")).alias("canonical_source_id"), F.col("m.o.path").alias("canonical_path"), F.lit("byte_identical_sha256").alias("reason"))
    return out.unionByName(rows.filter(F.col("sha256").isNull()), allowMissingColumns=True)


def route(rows: DataFrame) -> DataFrame:
    """Which branches take a source: documents by extension, every file of a dataset root as a dataset too."""
    return rows.withColumn("is_document", F.lower("extension").isin(".pdf", ".md", ".txt")).withColumn("is_dataset", F.col("category") == "dataset")
