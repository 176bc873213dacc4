"""Document records of a run: metadata, sections, coverage, counters over facts, OCR targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.functions import text as X

# Headings, statuses.
ABSTRACT = ([r"^\s*abstract\s*[:—-]?", r"^\s*摘要\s*[:：]?"], [r"^\s*(?:keywords?|key words|关键词)\s*[:：]", r"^\s*(?:1\.?\s*)?introduction\b", r"^\s*引言\b"])
CONCLUSION = (
    [r"^\s*(?:\d+(?:\.\d+)*\.?\s*)?(?:conclusions?|summary and conclusions?|结论与展望|结论|总结与展望)\s*$"],
    [r"^\s*(?:acknowledg|author contribution|conflict|references|参考文献)"],
)
MOST_FORMULAS = 200
NOT_VERIFIED = "not_complete"


def _counted(facts: DataFrame, column: str) -> DataFrame:
    """source_id, all: array of (value, n, first), by frequency, ties to the one seen first. Counted before any list is made."""
    seen = facts.select("source_id", "page", "ord", F.posexplode(column).alias("i", "value"))
    n = seen.groupBy("source_id", "value").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page", "ord", "i")).alias("first"))
    return n.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "first", "value", "n"))).alias("all"))


def document_records(sources: DataFrame, pages: DataFrame, facts: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One record for each document of sources (source_id, category, path, alias_paths, sha256, size_bytes, extension).

    pages: source_id, page, text, text_source; facts: source_id, page, ord, themes, material_formula_candidates; errors: source_id, page, error.
    PDFs have sections, DOIs, themes and formulas by frequency (200 formulas at most) and count as extracted with 200 characters and 20 a page;
    text files have no sections, themes in the order seen and all formulas by name, and count as extracted with any text. Sources without
    pages have empty texts.
    """
    s = sources.withColumn("__pdf", F.lower("extension") == ".pdf")
    whole = pages.groupBy("source_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("t")))), lambda p: p["t"]), "\n").alias("__text"),
        F.count(F.lit(1)).alias("__pages"), F.count_if(F.col("text_source") == "ocr").alias("__ocr"),
    )
    themes = _counted(facts, "themes").withColumnRenamed("all", "__themes")
    formulas = _counted(facts, "material_formula_candidates").withColumnRenamed("all", "__formulas")
    n_facts = facts.groupBy("source_id").agg(F.count(F.lit(1)).alias("__facts"))
    failed = (errors if errors is not None else pages.select("source_id", "page", F.lit(None).cast("string").alias("error"))).filter("error IS NOT NULL")
    failed = failed.groupBy("source_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "error"))), lambda e: e["error"]).alias("__errors"))
    j = s
    for part in (whole, themes, formulas, n_facts, failed):
        j = j.join(part, "source_id", "left")
    pdf, text, count = F.col("__pdf"), F.coalesce("__text", F.lit("")), F.coalesce("__pages", F.lit(0))
    chars, ocr = F.length(text), F.coalesce("__ocr", F.lit(0))
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    coverage = F.when(pdf, X.pdf_coverage(chars, count)).when(chars > 0, "text_extracted").otherwise("unreadable")
    none = F.array().cast("array<string>")
    seen_first = F.array_sort(F.transform("__themes", lambda t: F.struct(t["first"].alias("first"), t["value"].alias("value"), t["n"].alias("n"))))
    by_count = F.transform("__themes", lambda t: F.struct(t["value"].alias("theme"), t["n"].alias("n")))
    in_order = F.transform(seen_first, lambda t: F.struct(t["value"].alias("theme"), t["n"].alias("n")))
    names = F.transform("__formulas", lambda t: t["value"])
    status = (
        F.when(pdf & (ocr > 0), "machine_distilled_with_ocr_page_provenance").when(pdf & (chars > 0), "machine_distilled_with_page_provenance").when(pdf, "unreadable_requires_ocr")
        .when(chars > 0, "machine_distilled_with_line_level_text").otherwise("unreadable")
    )
    return j.select(
        "source_id", "category", "path", "alias_paths", "sha256", "size_bytes",
        F.struct(X.filename_metadata(stem, F.col("category")).alias("file_name"), F.when(pdf, X.dois(text)).otherwise(none).alias("doi_candidates")).alias("bibliographic_metadata"),
        F.struct(count.alias("page_count"), chars.alias("text_chars"), coverage.alias("text_coverage_status"), F.coalesce("__errors", none).alias("errors"), ocr.alias("ocr_pages_used")).alias("extraction"),
        F.struct(F.when(pdf, X.section(text, *ABSTRACT)).alias("abstract_or_summary"), F.when(pdf, X.section(text, *CONCLUSION)).alias("conclusion_or_outlook")).alias("distilled_sections"),
        F.struct(
            F.coalesce(F.when(pdf, by_count).otherwise(in_order), F.array().cast("array<struct<theme:string,n:bigint>>")).alias("themes"),
            F.coalesce(F.when(pdf, F.slice(names, 1, MOST_FORMULAS)).otherwise(F.array_sort(names)), none).alias("material_formula_candidates"), F.coalesce("__facts", F.lit(0)).alias("fact_count"),
        ).alias("distilled_index"),
        status.alias("distillation_status"), F.lit(NOT_VERIFIED).alias("human_verification_status"),
    )


def ocr_targets(documents: DataFrame) -> DataFrame:
    """Documents for which OCR is wanted: their text is thin or missing."""
    return documents.filter(F.col("extraction.text_coverage_status").startswith("ocr") | F.col("distillation_status").startswith("unreadable")).select("source_id", "path", "sha256", "extraction", "distillation_status")


def awaiting_ocr(documents: DataFrame, ocr: DataFrame) -> DataFrame:
    """source_id of earlier records with thin text for which OCR output is there now (sha256 of either case)."""
    there = ocr.select(F.upper("sha256").alias("h")).distinct()
    return documents.filter(F.col("extraction.text_coverage_status").startswith("ocr")).withColumn("h", F.upper("sha256")).join(there, "h", "left_semi").select("source_id")
