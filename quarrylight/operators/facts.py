"""Fact candidates: page-located sentences and table rows that a profile's patterns single out.

Everything is a Column expression over pages (source_id, page, text); no shuffle but the one that drops repeats within a page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.functions import text as X
from quarrylight.plans.profile import CANDIDATE, Profile

# Fixed values.
SENTENCE = "deterministic_full_text_sentence_screening"
TABLE_ROW = "deterministic_pdf_table_row_screening"
AHEAD, LABEL, PAGE_HEAD = 8, 60, 2500


def _table_lines(text: Column, profile: Profile) -> Column:
    """Nonempty lines with raw offsets, f: has a formula with a digit, l: a short label without number."""
    lines = F.filter(F.transform(X.pieces(text, F.lit(X.LINE_BREAK)), lambda p: F.struct(X.clean(p["piece"]).alias("t"), (p["start"] + F.length(F.regexp_extract(p["piece"], r"(?U)^\s*", 0))).alias("a"), (p["start"] + F.length(F.regexp_replace(p["piece"], r"(?U)\s+$", ""))).alias("z"))), lambda p: p["t"] != "")
    return F.transform(lines, lambda p: p.withField("f", F.exists(X.find_all(p["t"], profile.formula_pattern, False, profile.formula_group), lambda m: F.regexp_like(m, F.lit(r"(?U)\d")))).withField("l", (F.length(p["t"]) < LABEL) & ~X.matches(p["t"], X.TABLE_NUMBER)))


def _table_rows(flagged: Column) -> Column:
    """Rows of a table page: a line with a numbered formula and up to eight lines that belong to it; with raw offsets."""

    def block(all_lines: Column, i: Column) -> Column:
        after = F.slice(all_lines, i + 2, F.lit(AHEAD))
        stops = F.transform(after, lambda p, j: p["f"] | (p["l"] & F.coalesce(F.get(after, j + 1)["f"], F.lit(False))))
        first = F.array_position(stops, F.lit(True))
        n = F.when(first > 0, first.cast("int") - 1).otherwise(F.size(after))
        own = F.slice(all_lines, i + 1, n + 1)
        return F.struct(X.clean(F.array_join(F.transform(own, lambda p: p["t"]), " ")).alias("piece"), own[0]["a"].alias("start"), F.element_at(own, -1)["z"].alias("end"))

    rows = F.transform(flagged, lambda p, i: F.when(p["f"], block(flagged, i)))
    return F.filter(rows, lambda r: r.isNotNull() & X.matches(r["piece"], X.TABLE_NUMBER))


def fact_candidates(pages: DataFrame, profile: Profile) -> DataFrame:
    """pages: source_id, page, text. One row for each candidate: fact_id, source_id, page, evidence_text, themes,
    material_formula_candidates, numeric_value_candidates, temperature_candidates, extraction_method, verification_status,
    confidence, source_span (null where the text isn't unique on its page), ord.

    Null texts count as empty. Of equal sentences on a page the first stays, sentences before table rows.
    """
    p = pages.select("source_id", "page", F.coalesce("text", F.lit("")).alias("text")).withColumn("is_table", X.is_table_page(F.col("text")))
    # once a page, not once a candidate
    p = p.withColumn("dense", X.compact(F.col("text"))).withColumn("page_hash", F.sha2("text", 256))
    text, table = F.col("text"), F.col("is_table")
    rule = F.when(table, F.lit(X.java(X.SPLIT_TABLE))).otherwise(F.lit(X.java(X.SPLIT_PROSE)))
    no_rows = F.array().cast("array<struct<piece:string,start:int,end:int>>")
    found = F.struct(
        F.split(text, rule, -1).alias("said"), F.when(table, X.let(_table_lines(text, profile), _table_rows)).otherwise(no_rows).alias("rows"),
        F.coalesce(F.when(table, X.themes(F.left(text, F.lit(PAGE_HEAD)), profile.keyword_groups)), F.array().cast("array<string>")).alias("themes"),
    )

    def screened(f: Column) -> Column:
        """Candidates of one page, so that only these are copied out of it."""
        nowhere = F.lit(None).cast("int")
        said = F.transform(f["said"], lambda x, i: F.struct(F.lit(False).alias("row"), x.alias("piece"), nowhere.alias("start"), nowhere.alias("end"), i.alias("ord")))
        rows = F.transform(f["rows"], lambda x, i: F.struct(F.lit(True).alias("row"), x["piece"].alias("piece"), x["start"].alias("start"), x["end"].alias("end"), (F.size(f["said"]) + i).alias("ord")))
        # a piece never grows when it is put on one line
        long = F.filter(F.concat(said, rows), lambda x: F.length(x["piece"]) >= X.SHORTEST)
        clean = F.transform(long, lambda x: x.withField("s", X.one_line(x["piece"])))
        fits = F.filter(clean, lambda x: F.length(x["s"]).between(X.SHORTEST, X.LONGEST))

        def singled_out(x: Column) -> Column:
            own = reduce(lambda a, b: a | b, (X.matches(x["s"], t, True) for t in profile.keyword_groups.values()), F.lit(False))
            value = X.matches(x["s"], profile.value_unit_pattern, True) | (x["row"] & X.matches(x["s"], X.TABLE_NUMBER))
            return own | (x["row"] & (F.size(f["themes"]) > 0)) | (value & X.matches(x["s"], profile.formula_pattern))

        return F.transform(F.filter(fits, singled_out), lambda x: x.withField("page_themes", f["themes"]))

    c = p.select("source_id", "page", "text", "dense", "page_hash", F.explode(X.let(found, screened)).alias("c"))
    c = c.select("source_id", "page", "text", "dense", "page_hash", "c.ord", "c.row", "c.s", "c.piece", "c.start", "c.end", "c.page_themes")
    s, row, piece = F.col("s"), F.col("row"), F.col("piece")
    values = F.transform(X.find_all(s, profile.value_unit_pattern, True), X.strip)
    c = c.select(
        "source_id", "page", "text", "dense", "page_hash", "ord", "s", "row", "piece", "start", "end", X.themes(s, profile.keyword_groups).alias("own"), "page_themes", values.alias("values"),
        X.sorted_set(X.find_all(s, profile.formula_pattern, False, profile.formula_group)).alias("formulas"),
    )
    c = c.withColumn("themes", F.when(row, X.sorted_set(F.concat("own", "page_themes"))).otherwise(F.col("own")))
    c = c.withColumn("values", F.when(row, X.sorted_set(F.concat("values", F.transform(X.find_all(s, X.TABLE_NUMBER), X.strip)))).otherwise(F.col("values")))
    temperatures = F.when(row, X.sorted_set(F.transform(X.find_all(s, X.TABLE_TEMPERATURE, True), X.strip))).otherwise(F.transform(X.find_all(s, X.TEMPERATURE, True), X.strip))
    c = c.withColumn("temperatures", temperatures)

    # a span is given only where the text without white space occurs once on its page; the piece then occurs once too, so that a sentence's place is found by its text
    stripped = F.regexp_replace(F.regexp_replace(piece, r"(?U)\s+$", ""), r"(?U)^\s+", "")
    raw, needle, dense, at, page_hash = (F.col(n) for n in ("raw", "needle", "dense", "at", "page_hash"))
    c = c.withColumn("needle", X.compact(s)).withColumn("at", F.position(F.col("needle"), dense))
    c = c.withColumn("unique", (at > 0) & (F.position(needle, dense, at + 1) == 0))
    c = c.withColumn("raw", F.when(F.col("unique"), F.when(row, F.substr(text, F.col("start") + 1, F.col("end") - F.col("start"))).otherwise(stripped)))
    c = c.withColumn("located", F.coalesce(X.compact(raw) == needle, F.lit(False)))
    c = c.withColumn("a", F.when(F.col("located"), X.utf16_length(F.left(text, F.when(row, F.col("start")).otherwise(F.position(raw, text) - 1)))))
    a, z = F.col("a"), F.col("a") + X.utf16_length(raw)
    span = F.struct(
        X.stable_id("span", F.col("source_id"), F.col("page").cast("string"), page_hash, a.cast("string"), z.cast("string")).alias("span_id"),
        "source_id", "page", page_hash.alias("page_sha256"), a.alias("start"), z.alias("end"), F.lit("utf16_code_units").alias("offset_unit"), F.sha2(raw, 256).alias("raw_text_sha256"),
    )
    out = c.select(
        X.fact_id(F.col("source_id"), F.col("page"), s).alias("fact_id"), "source_id", "page", s.alias("evidence_text"), "themes",
        F.col("formulas").alias("material_formula_candidates"), F.col("values").alias("numeric_value_candidates"), F.col("temperatures").alias("temperature_candidates"),
        F.when(row, TABLE_ROW).otherwise(SENTENCE).alias("extraction_method"), F.lit(CANDIDATE).alias("verification_status"),
        X.confidence(F.col("values"), F.col("themes"), F.col("formulas")).alias("confidence"), F.when(F.col("located"), span).alias("source_span"), "ord",
    )
    # without the pages' texts
    first = Window.partitionBy("source_id", "page", "evidence_text").orderBy("ord")
    return out.withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn")


def theme_counts(facts: DataFrame, *by: str) -> DataFrame:
    return facts.select(*by, F.explode("themes").alias("theme")).groupBy(*by, "theme").agg(F.count(F.lit(1)).alias("n"))


def top_formulas(facts: DataFrame, *by: str, most: int = 200) -> DataFrame:
    """The most frequent formulas of each group, ties to the one seen first."""
    seen = facts.select(*by, "page", "ord", F.posexplode("material_formula_candidates").alias("i", "formula"))
    counts = seen.groupBy(*by, "formula").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page", "ord", "i")).alias("first"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), "first")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).drop("first")
