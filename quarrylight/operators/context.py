"""Context screening of facts, locator checks, and binding of conclusions to facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.functions import text as X
from quarrylight.plans.profile import Profile

from .assertions import none_of_any, repeated_ids, unique_ids
from .lineage import cut

LOCATED, REVIEW = "located_in_cached_page", "locator_needs_review"


def locate(facts: DataFrame, pages: DataFrame) -> DataFrame:
    """facts with locator_status: exactly one page of that number, the text (white space aside) on it, and a span, if there is one,
    of right identity, unit, bounds and hashes that holds that text."""
    key = ["source_id", "page"]
    n = pages.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    f = facts.groupBy(*key).agg(F.collect_list(F.struct(*facts.columns)).alias("__facts")).join(n, key, "left")
    # only pages that have facts and stand once bring their text, and each is normalised once for all its facts
    p = pages.select(F.col("source_id").alias("__source"), F.col("page").alias("__page"), F.coalesce("text", F.lit("")).alias("__text"))
    f = f.join(p, (F.col("source_id") == F.col("__source")) & (F.col("page") == F.col("__page")) & (F.col("__n") == 1), "left")
    text = F.col("__text")
    page = F.struct(X.compact(text).alias("dense"), F.sha2(text, 256).alias("hash"), F.encode(text, "UTF-16LE").alias("wide"))

    def located(g: Column, x: Column) -> Column:
        s, evidence = x["source_span"], X.compact(F.coalesce(x["evidence_text"], F.lit("")))
        raw = F.decode(F.substring(g["wide"], (s["start"] * 2 + 1).cast("int"), ((s["end"] - s["start"]) * 2).cast("int")), "UTF-16LE")
        bounds = (s["start"] >= 0) & (s["start"] < s["end"]) & (s["end"] * 2 <= F.octet_length(g["wide"]))
        same = (s["source_id"] == x["source_id"]) & (s["page"] == x["page"]) & (s["offset_unit"] == "utf16_code_units") & (F.lower(s["page_sha256"]) == g["hash"])
        span_ok = s.isNull() | F.coalesce(same & bounds & F.when(bounds, (F.sha2(raw, 256) == F.lower(s["raw_text_sha256"])) & (X.compact(raw) == X.compact(x["evidence_text"]))), F.lit(False))
        return (x["page"] >= 1) & (evidence != "") & F.contains(g["dense"], evidence) & span_ok

    checked = X.let(page, lambda g: F.transform("__facts", lambda x: F.struct(x.alias("f"), F.when(F.coalesce(located(g, x), F.lit(False)), LOCATED).otherwise(REVIEW).alias("locator_status"))))
    rest = [F.col(f"x.f.{c}") for c in facts.columns if c not in key]
    return f.select(F.explode(checked).alias("x")).select(*(F.col(f"x.f.{c}") for c in key), *rest, "x.locator_status")


def context_checks(located: DataFrame, profile: Profile) -> DataFrame:
    """located: result of locate(). One row for each fact with fields (field, status, matches) and needs_review."""
    located = cut(located, "located")
    unique_ids(located, "fact_id")
    none = F.array().cast("array<struct<text:string,start:int,end:int>>")
    fields = []
    for name in profile.required_context:
        if name == "source_page":
            status, found = F.col("locator_status"), none
        elif name not in profile.context_patterns:
            status, found = F.lit("not_configured"), none
        else:
            found = X.match_offsets(F.coalesce("evidence_text", F.lit("")), profile.context_patterns[name])
            status = F.when(F.size(found) > 0, "located_in_candidate").otherwise("not_located_in_candidate")
        fields.append(F.struct(F.lit(name).alias("field"), status.alias("status"), found.alias("matches")))
    kind = "array<struct<field:string,status:string,matches:array<struct<text:string,start:int,end:int>>>>"
    out = located.withColumn("fields", F.array(*fields).cast(kind))
    bad = (F.col("locator_status") != LOCATED) | F.exists("fields", lambda x: ~x["status"].isin("located_in_candidate", LOCATED))
    return out.select("fact_id", "source_id", "page", "verification_status", "locator_status", "fields", bad.alias("needs_review"))


def status_counts(checks: DataFrame) -> DataFrame:
    return checks.select(F.explode("fields").alias("f")).groupBy(F.col("f.field").alias("field"), F.col("f.status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def support_state(all_human, all_agent, all_machine):
    return F.when(all_human, "supporting_facts_human_verified").when(all_agent, "supporting_facts_agent_verified").when(all_machine, "supporting_facts_machine_candidates").otherwise("supporting_facts_mixed_or_project_specific_status")


def bind_conclusions(conclusions: DataFrame, links: DataFrame, conflicts: DataFrame, facts: DataFrame, checks: DataFrame) -> DataFrame:
    """conclusions: conclusion_id, text, claim_type, rationale; links: conclusion_id, fact_id, relation; conflicts: conclusion_id,
    fact_ids, description. Raises on unknown, repeated or unlocated references, missing support, wrong claim types or relations,
    claims without rationale, and conflicts without two distinct bound facts and a description. Nothing is promoted."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    named = conclusions.select("conclusion_id", "text", "claim_type", "rationale")
    bound = links.join(facts.select("fact_id", "source_id", "page", "evidence_text"), "fact_id").join(checks.select("fact_id", "verification_status", "locator_status", "needs_review"), "fact_id")
    bound = cut(bound, "bound")
    own = links.groupBy("conclusion_id").agg(F.collect_set("fact_id").alias("bound"))
    few = (F.size("fact_ids") < 2) | (F.size(F.array_distinct("fact_ids")) < F.size("fact_ids")) | (F.size(F.array_except("fact_ids", F.coalesce("bound", F.array().cast("array<string>")))) > 0)
    none_of_any(
        repeated_ids(conclusions, "conclusion_id"),
        (named.filter(blank("text")).select("conclusion_id"), "conclusion text is required"),
        (named.filter(~F.coalesce(F.col("claim_type").isin("source_fact", "inference", "recommendation"), F.lit(False))).select("conclusion_id"), "unknown claim type"),
        (named.filter((F.col("claim_type") != "source_fact") & blank("rationale")).select("conclusion_id"), "rationale is required"),
        (links.filter(~F.coalesce(F.col("relation").isin("supports", "contradicts", "context"), F.lit(False))).select("conclusion_id"), "unknown relation"),
        (links.join(facts, "fact_id", "left_anti").select("conclusion_id", "fact_id"), "unknown fact reference"),
        (links.groupBy("conclusion_id", "fact_id").count().filter("count > 1"), "repeated fact reference"),
        (named.join(links.filter("relation = 'supports'"), "conclusion_id", "left_anti").select("conclusion_id"), "a supporting fact is required"),
        (bound.filter(F.col("locator_status") != LOCATED).select("conclusion_id", "fact_id"), "a bound fact isn't located"),
        (conflicts.join(own, "conclusion_id", "left").filter(few | blank("description")).select("conclusion_id"), "a conflict needs two distinct bound facts and a description"),
    )
    s, supports = F.col("verification_status"), F.col("relation") == "supports"
    human, agent = F.regexp_like(s, F.lit("^human_verified(_|$)")), F.regexp_like(s, F.lit("^agent_verified(_|$)"))
    state = bound.groupBy("conclusion_id").agg(
        F.bool_and(~supports | human).alias("h"), F.bool_and(~supports | agent).alias("a"), F.bool_and(~supports | (s == "source_located_not_human_verified")).alias("m"),
        F.bool_or(F.col("relation") == "contradicts").alias("c"), F.bool_or("needs_review").alias("context_needs_review"),
        F.array_sort(F.collect_list(F.struct("fact_id", "relation", "source_id", "page", "evidence_text", "verification_status"))).alias("evidence"),
    )
    disputed = conflicts.groupBy("conclusion_id").agg(F.collect_list(F.struct("fact_ids", "description")).alias("conflicts"))
    out = conclusions.join(state, "conclusion_id").join(disputed, "conclusion_id", "left")
    return out.select(
        "conclusion_id", "text", "claim_type", "rationale", F.lit("references_validated_not_conclusion_verified").alias("binding_status"),
        support_state(F.col("h"), F.col("a"), F.col("m")).alias("support_state"), (F.col("c") | F.col("conflicts").isNotNull()).alias("has_conflicting_evidence"), "context_needs_review", "conflicts", "evidence",
    )
