"""Strict promotion of page-anchored measurements: one CASE chain rejects sentences, the rest are paired with temperatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.functions import text as X

# The number pattern, the properties' patterns and units, and the rejecting patterns, in the order they apply.
NUMBER = r"(\d+(?:\.\d+)?(?:\s*[×x]\s*10\s*[−-]?\s*\d+|[eE][+-]?\d+)?)"
OHM = r"(?:Ω|Ω|ohm|U)\s*(?:[·⋅ ]?cm(?:²|2|\^2))"
PROPERTIES = {
    "ASR": (r"(?:\bASR\b|area[- ]specific resistance|polarization resistance|polarisation resistance|\bR[pP]\b)[^.;:]{0,180}?" + NUMBER + r"\s*" + OHM, "Ω·cm²"),
    "electrical_conductivity": (r"(?:electrical|electronic|total)?\s*conductivit(?:y|ies)[^.;:]{0,180}?" + NUMBER + r"\s*S\s*(?:cm\s*(?:[−-]?1|\^-?1)|/\s*cm)", "S/cm"),
    "peak_power_density": (r"(?:peak|max(?:imum)?)\s+power densit(?:y|ies)[^.;:]{0,180}?" + NUMBER + r"\s*(m?W)\s*(?:cm\s*(?:[−-]?2|\^-?2)|/\s*cm(?:²|2))", None),
    "oxygen_surface_exchange_coefficient": (r"(?:surface exchange coefficient|\bk(?:chem|ex|\*)\b)[^.;:]{0,180}?" + NUMBER + r"\s*cm\s*(?:s\s*(?:[−-]?1|\^-?1)|/\s*s)", "cm/s"),
    "oxygen_diffusion_coefficient": (r"(?:diffusion coefficient|\bD(?:chem|\*)\b)[^.;:]{0,180}?" + NUMBER + r"\s*cm(?:²|2|\^2)\s*(?:s\s*(?:[−-]?1|\^-?1)|/\s*s)", "cm²/s"),
    "thermal_expansion_coefficient": (r"(?:thermal expansion coefficient|\bTEC\b)[^.;:]{0,180}?" + NUMBER + r"\s*(?:×|x)?\s*10\s*[−-]?6\s*K\s*(?:[−-]?1|\^-?1)", "10⁻⁶ K⁻¹"),
}
REVIEW = r"\b(review|perspective|overview|past \d+ years|bibliometric)\b"
REFERENCES = r"(?m)^\s*(references|bibliography)\s*$"
REJECT = (
    ("secondary_or_cited_statement", r"\b(reported(?: by| that)?|previous(?:ly)?|literature|other studies|according to|it was known|e\.g\.)\b", True),
    ("ambiguous_or_cited_sentence", r"\[[^\]]*\d[^\]]*\]", False),
    ("ambiguous_or_cited_sentence", r"\b(respectively|versus|values? are|increases? to|decreases? to|from .+ to)\b", True),
    ("range_approximate_or_inequality", r"\b\d+(?:\.\d+)?\s*[e–−-]\s*\d+(?:\.\d+)?\b", False),
    ("range_approximate_or_inequality", r"\b(exceed(?:s|ed|ing)?|more than|less than|approximately|about|around|ca\.)\b|[<>~≈]", True),
    ("composite_material_not_single_formula", r"\b(?:composite|mixture)\b|\b[A-Z][A-Za-z0-9-]*\s*\+\s*[A-Z]", True),
    ("relative_change_not_absolute_measurement", r"\b(?:enhancement|increase|decrease)\s+of\s+(?:the\s+)?(?:electrical\s+)?conductivity\b", True),
    ("unresolved_ocr_scientific_notation", r"/C[02]", False),
)
CODED, KNOWN_CODES = r"\b[A-Z]{2,}[A-Z0-9-]*\d+[A-Z0-9-]*\b", ("YSZ", "GDC", "SDC", "CGO91", "CSO82")
BAD_POWER = r"\b\d+\s+3\s+10\d{2}\s*cm"
ELECTROLYTE = r"\b(?:for|of)\s+(?:YSZ|GDC|SDC|CGO|CSO|electrolyte)\b"
COOLEST, HOTTEST = 200, 1200


def sentences(text: Column) -> Column:
    """Sentences of an OCR text after the usual repairs."""
    t = F.regexp_replace(text, r"/C(?:14|176)\s*C", "°C")
    for a, b in (("/C15", ". "), ("/C0 d", "-δ"), ("/C0δ", "-δ")):
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(F.regexp_replace(t, r"/C0\s*([12])", "-$1"), r"\b(\d{2,3})8C\b", "$1 °C")
    return F.filter(F.split(X.squeeze(t), r"(?<=[.!?])\s+(?=[A-Z0-9])"), lambda s: s != "")


def reject_reason(sentence: Column) -> Column:
    """First reason that applies, null for sentences that may hold a measurement."""
    out = F.when(F.lit(False), F.lit(""))
    for reason, pattern, ignore in REJECT:
        out = out.when(X.matches(sentence, pattern, ignore), reason)
    codes = F.array_except(F.array_distinct(X.find_all(sentence, CODED)), F.array(*map(F.lit, KNOWN_CODES)))
    return out.when(F.size(codes) > 1, "multiple_material_abbreviations").when(X.matches(sentence, BAD_POWER), "suspicious_ocr_scientific_notation")


def references_flag(pages: DataFrame) -> DataFrame:
    """in_references: a heading stood at the top of this page or of an earlier one of the source."""
    here = F.regexp_like(F.left(F.coalesce("text", F.lit("")), F.lit(500)), F.lit("(?i)" + REFERENCES))
    w = Window.partitionBy("source_id").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return pages.withColumn("in_references", F.max(here).over(w))


def pair_measurements(rows: DataFrame, temperature_pattern: str = X.TEMPERATURE) -> DataFrame:
    """rows: source_id, page, sentence, formula, perhaps ord (the sentence's place on its page). One row for each property that occurs: reason (null if paired) and, paired by position,
    value, unit and temperature_c. Sentences without temperature, with one outside the window, or without formula give nothing."""
    s = F.col("sentence")
    t = F.transform(X.find_all(s, temperature_pattern, True, 1), lambda x: x.try_cast("double"))
    r = rows.filter(F.col("formula").isNotNull()).withColumn("t", t).filter((F.size("t") > 0) & ~F.exists("t", lambda x: (x < COOLEST) | (x > HOTTEST)))
    own = ["source_id", "page", "sentence", "formula", *(c for c in ("ord",) if c in rows.columns)]

    def measured(name: str, pattern: str, unit: str | None):
        def body(v: Column) -> Column:
            units = F.transform(X.find_all(s, pattern, True, 2), lambda u: F.when(F.lower(u) == "mw", "mW/cm²").otherwise("W/cm²")) if unit is None else F.transform(v, lambda _: F.lit(unit))
            reason = F.when(F.size(v) != F.size("t"), "unpaired_value_temperature")
            if name == "ASR":
                reason = F.when(F.size(X.find_all(s, OHM, True)) != F.size(v), "multiple_unpaired_property_values").otherwise(reason)
            if name == "electrical_conductivity":
                reason = F.when(X.matches(s, ELECTROLYTE, True), "electrolyte_property_not_cathode").otherwise(reason)
            return F.when(F.size(v) > 0, F.struct(F.lit(name).alias("property"), reason.alias("reason"), v.alias("v"), units.alias("u")))

        return X.let(F.transform(X.find_all(s, pattern, True, 1), X.parse_number), body)

    found = [measured(name, *rule) for name, rule in PROPERTIES.items()]
    p = r.withColumn("x", F.explode(F.array_compact(F.array(*found)))).select(*own, "t", "x.*")
    # one pass for both: a rejected property gives one row without a value
    nothing = F.struct(F.lit(None).cast("double").alias("v"), F.lit(None).cast("string").alias("u"), F.lit(None).cast("double").alias("t"))
    z = F.explode(F.when(F.col("reason").isNull(), F.arrays_zip("v", "u", "t")).otherwise(F.array(nothing)))
    return p.select(*own, "property", "reason", z.alias("z")).select(*own, "property", "reason", F.col("z.v").alias("value"), F.col("z.u").alias("unit"), F.col("z.t").alias("temperature_c"))


KEY = ("formula_key", "property", "value", "unit", "temperature_c")


def new_measurements(paired: DataFrame, existing: DataFrame) -> DataFrame:
    """First of each fingerprint within a source, by page and place on the page (column ord, where there is one; else by sentence), without
    those that the master has (whatever their source). Nulls are equal."""
    p = paired.filter("reason IS NULL").withColumn("formula_key", X.formula_key(F.col("formula")))
    shown = ["page", "sentence", "formula", *(c for c in ("formula_method",) if c in p.columns)]
    first = p.groupBy("source_id", *KEY).agg(F.min_by(F.struct(*shown), F.struct("page", *(c for c in ("ord",) if c in p.columns), "sentence")).alias("f")).select("source_id", *KEY, "f.*")
    same = [first[c].eqNullSafe(existing[c]) for c in KEY]
    return first.join(existing.select(*KEY).distinct(), same, "left_anti")


#: Temperatures of measurements.
DEGREES = r"(\d{2,4}(?:\.\d+)?)\s*(?:°|º|/C14\s*)?\s*C\b"


def promote(pages: DataFrame, titles: DataFrame, batch: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages: source_id, page, text; titles: source_id, title, sha256, category; batch: sha256; existing: the master's fingerprints.

    (new measurements, counts of rejections by reason). Only papers, theses and patents of the batch take part; nothing is written.
    """
    from .formulas import OPENING_PAGES, resolve_formulas

    chosen = titles.filter(F.col("category").isin("paper", "thesis", "patent")).withColumn("h", F.upper("sha256"))
    chosen = chosen.join(batch.select(F.upper("sha256").alias("h")).distinct(), "h", "left_semi")
    review = X.matches(F.coalesce("title", F.lit("")), REVIEW, True)
    kept = pages.join(chosen.filter(~review).select("source_id"), "source_id", "left_semi")
    flagged = references_flag(kept)
    said = flagged.filter(~F.col("in_references")).select("source_id", "page", F.posexplode(sentences(F.coalesce("text", F.lit("")))).alias("ord", "sentence")).withColumn("reason", reject_reason(F.col("sentence")))
    first = kept.groupBy("source_id").agg(F.array_sort(F.collect_list(F.when(F.col("page") <= OPENING_PAGES, F.struct("page", "text")))).alias("p"))
    openings = chosen.select("source_id", "title").join(first, "source_id", "left").select("source_id", "title", F.transform("p", lambda x: x["text"]).alias("pages"))
    paired = pair_measurements(resolve_formulas(said.filter("reason IS NULL"), openings), DEGREES)
    new = new_measurements(paired, existing)
    one = lambda df, reason: df.select(F.lit(reason).alias("reason"))
    reasons = one(chosen.filter(review), "review_or_perspective_document").unionByName(one(flagged.filter("in_references"), "references_section"))
    reasons = reasons.unionByName(said.filter("reason IS NOT NULL").select("reason")).unionByName(paired.filter("reason IS NOT NULL").select("reason"))
    fresh = paired.filter("reason IS NULL").withColumn("formula_key", X.formula_key(F.col("formula"))).select("source_id", *KEY).distinct()
    known = fresh.join(existing.select(*KEY).distinct(), [fresh[c].eqNullSafe(existing[c]) for c in KEY], "left_semi")
    return new, reasons.unionByName(one(known, "already_in_master")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# What a promoted measurement says of itself.
STATUS, GRADE, REVIEWED = "directly_reported", "B_primary_locator_or_quote_unverified", "not_human_verified"
ROLE = "local_primary_fulltext_page_anchored_machine_extraction"
EVIDENCE = "page_anchored_machine_extracted"
TARGET_C = 650


def _json_id(prefix: str, *parts: Column) -> Column:
    """prefix and a hash of the parts (null: left out as null)."""
    return F.concat(F.lit(prefix), F.left(F.sha2(F.to_json(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(parts))), {"ignoreNullFields": "false"}), 256), F.lit(20)))


def records(new: DataFrame, sources: DataFrame, batch_date: str) -> DataFrame:
    """new: see new_measurements(); sources: source_id, title, doi, path. One record for each source and formula: experimental_record_id,
    source_id, formula_key, formula (of its first measurement), external_source, measurements in the order of property, temperature,
    value and page. A formula's measurements are those of one document, so a record is small however many documents there are.
    Nothing is said to be verified; fields that the sentence doesn't give are null and listed as missing."""
    s = F.coalesce("sentence", F.lit(""))
    method, air = X.matches(s, r"\b(EIS|impedance)\b", True), X.matches(s, r"\bin air\b", True)
    at_target = F.coalesce(F.col("temperature_c") == TARGET_C, F.lit(False))
    how = F.col("formula_method") if "formula_method" in new.columns else F.lit(None).cast("string")
    one = F.struct(
        F.col("property"), F.col("temperature_c"), F.col("value"), F.col("page"), F.col("unit"),
        _json_id("pagefact_", F.col("source_id"), F.col("formula_key"), F.col("property"), F.col("value"), F.col("unit"), F.col("temperature_c"), F.col("page"), F.col("sentence")).alias("evidence_id"),
        F.lit(STATUS).alias("data_status"), F.struct(F.lit(None).cast("string").alias("electrolyte"), F.when((F.col("property") == "ASR") & method, "EIS").alias("test_method"), F.when(air, "air").alias("atmosphere")).alias("test_context"),
        F.lit(None).cast("string").alias("synthesis_method"),
        F.struct(F.col("page"), *(F.lit(None).cast("string").alias(c) for c in ("figure", "table", "sheet", "row")), F.col("path").alias("local_source_path"), F.lit(False).alias("human_verified")).alias("source_location"),
        F.struct(F.col("sentence").alias("exact_original_sentence"), F.lit(EVIDENCE).alias("evidence_status")).alias("evidence"), how.alias("formula_method"), F.col("doi"),
        F.when(at_target, "target_temperature").otherwise("supporting_other_temperature").alias("priority_role"), F.lit(GRADE).alias("evidence_grade"), F.lit(REVIEWED).alias("verification_status"),
        F.array_compact(F.array(F.lit("electrolyte"), F.when(~method, "test_method"), F.lit("synthesis_method"))).alias("missing_fields"),
    )
    about = sources.select("source_id", "title", "doi", "path")
    rows = new.join(about, "source_id", "left").withColumn("m", one)
    first = F.min_by("formula", F.struct("page", "sentence", "property"))
    grouped = rows.groupBy("source_id", "formula_key").agg(first.alias("formula"), F.first(F.struct("title", "doi", "path")).alias("external_source"), F.array_sort(F.collect_list("m")).alias("measurements"))
    rid = _json_id("exp_", F.col("source_id"), F.col("formula_key"), F.lit(batch_date))
    return grouped.select(rid.alias("experimental_record_id"), "source_id", "formula_key", "formula", F.lit(ROLE).alias("source_role"), "external_source", "measurements")


def review_queue(made: DataFrame) -> DataFrame:
    """made: see records(). What people should look at: one row a measurement, those at the target temperature first in rank."""
    m = made.select("experimental_record_id", "source_id", "formula", F.explode("measurements").alias("m"))
    high = F.coalesce(F.col("m.temperature_c") == TARGET_C, F.lit(False))
    return m.select(
        "m.evidence_id", "experimental_record_id", "source_id", "formula", "m.property", "m.value", "m.unit", "m.temperature_c", "m.page", F.when(high, "high").otherwise("normal").alias("priority"),
        F.when(high, 1).otherwise(2).alias("priority_rank"), F.col("m.evidence.exact_original_sentence").alias("evidence_text"),
    )


def coverage_counts(made: DataFrame) -> DataFrame:
    """One row over records(): records, measurements, and how many measurements have each of eight fields."""
    m = made.select("experimental_record_id", F.explode_outer("measurements").alias("m"))
    there = lambda c: F.count_if(F.col(c).isNotNull())
    return m.agg(
        F.count_distinct("experimental_record_id").alias("records"), there("m.property").alias("measurements"), F.count_if(F.col("m.data_status") == STATUS).alias(STATUS),
        there("m.test_context.electrolyte").alias("electrolyte"), there("m.test_context.test_method").alias("test_method"), there("m.synthesis_method").alias("synthesis_method"), there("m.source_location.page").alias("page"),
        there("m.source_location.figure").alias("figure"), there("m.source_location.table").alias("table"), F.count_if(F.col("m.source_location.sheet").isNotNull() & F.col("m.source_location.row").isNotNull()).alias("sheet_row"),
        F.count_if(F.coalesce("m.evidence.exact_original_sentence", F.lit("")) != "").alias("exact_original_sentence"),
    )


def snapshot(master: DataFrame, made: DataFrame) -> DataFrame:
    """The master's records and the new ones, as a table of its own; raises where an id would stand twice."""
    from .assertions import unique_ids

    out = master.unionByName(made, allowMissingColumns=True)
    unique_ids(out, "experimental_record_id")
    return out


def audit(master: DataFrame, made: DataFrame, rejected: DataFrame) -> dict:
    """Counts of a promotion: what the master had, what is added, what it has now, and rejections by reason."""
    counted = lambda df: df.agg(F.count_distinct("source_id").alias("sources"), F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.size("measurements")), F.lit(0)).alias("measurements")).first().asDict()
    fresh = made.select("source_id").distinct().join(master, "source_id", "left_anti").count()
    before, added = counted(master), counted(made)
    after = {"sources": before["sources"] + fresh, **{c: before[c] + added[c] for c in ("records", "measurements")}}
    return {"input_counts": before, "added_record_count": added["records"], "added_measurement_count": added["measurements"], "added_source_count": fresh, "output_counts": after, "rejection_counts": {r.reason: r.n for r in rejected.orderBy("reason").collect()}}
