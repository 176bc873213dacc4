"""Preserved facts, overlays and dispositions: old identities and decisions survive every refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.functions import text as X

from .assertions import none_of_any, repeated_ids
from .lineage import cut

IDENTITY = ("source_id", "page", "evidence_text")


def _differs(a: str, b: str, columns: tuple[str, ...]):
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def load_preserved(base: DataFrame, overlays: list[DataFrame]) -> DataFrame:
    """base upserted by verified overlays, one after another. A verified record can't be changed, and no record's source, page or
    text; overlays hold verified records only; ids are complete and unique in each."""
    merged = base
    for i, part in enumerate([base, *overlays]):
        checks = [(part.filter(F.col(c).isNull()).select("fact_id"), f"incomplete preserved fact ({c})") for c in ("fact_id", "source_id", "page", "verification_status")]
        checks.append(repeated_ids(part, "fact_id"))
        if not i:
            none_of_any(*checks)
            continue
        checks.append((part.filter(~X.is_verified(F.col("verification_status"))).select("fact_id"), "overlay holds an unverified candidate"))
        rest = [c for c in base.columns if c not in ("fact_id", *IDENTITY)]
        both = merged.alias("a").join(part.alias("b"), F.col("a.fact_id") == F.col("b.fact_id"))
        changed = _differs("a", "b", (*IDENTITY, *rest))
        checks.append((both.filter(changed & (X.is_verified(F.col("a.verification_status")) | _differs("a", "b", IDENTITY))).select("a.fact_id"), "conflicting preserved fact"))
        none_of_any(*checks)
        merged = merged.join(part, "fact_id", "left_anti").unionByName(part)
    return merged


def merge_preserved(generated: DataFrame, previous: DataFrame) -> DataFrame:
    """All previous facts as they are, then generated ones whose id and whose (source, page, text without white space) are new;
    of generated facts that agree in these the first by ord stays. Column origin: preserved or new."""
    # both are read several times: candidates aren't extracted anew for each
    g = cut(generated.withColumn("__t", X.compact(F.coalesce("evidence_text", F.lit("")))), "generated")
    previous = cut(previous, "previous")
    p = previous.withColumn("__t", X.compact(F.coalesce("evidence_text", F.lit(""))))
    both = g.alias("a").join(p.alias("b"), F.col("a.fact_id") == F.col("b.fact_id"))
    none_of_any(repeated_ids(previous, "fact_id"), (both.filter(_differs("a", "b", IDENTITY)).select("a.fact_id"), "fact id collision"))
    key = ["source_id", "page", "__t"]
    new = g.join(p.select("fact_id"), "fact_id", "left_anti").join(p.select(*key).distinct(), key, "left_anti")
    first = new.groupBy(*key).agg(F.min_by(F.struct(*generated.columns), F.struct(F.col("ord") if "ord" in generated.columns else F.lit(0), F.col("fact_id"))).alias("f")).select("f.*")
    return previous.withColumn("origin", F.lit("preserved")).unionByName(first.withColumn("origin", F.lit("new")), allowMissingColumns=True)


def merge_counts(merged: DataFrame) -> DataFrame:
    old = F.col("origin") == "preserved"
    return merged.agg(F.count_if(old).alias("preserved_fact_ids"), F.count_if(old & X.is_verified(F.col("verification_status"))).alias("preserved_verified_facts"), F.count_if(~old).alias("new_machine_candidates"))


def merge_dispositions(facts: DataFrame, old: DataFrame) -> DataFrame:
    """Each fact's earlier decision with its present verification status, or the default for that status. No decision may lose its
    fact, and no fact its source or page."""
    lost = old.join(facts, "fact_id", "left_anti").select("fact_id")
    both = facts.alias("a").join(old.alias("b"), F.col("a.fact_id") == F.col("b.fact_id"))
    conflict = both.filter(_differs("a", "b", ("source_id", "page"))).select("a.fact_id")
    none_of_any(repeated_ids(old, "fact_id"), (lost, "disposition references would be lost"), (conflict, "disposition identity conflict"))
    extra = [c for c in old.columns if c not in ("fact_id", "source_id", "page", "verification_status")]
    o = old.select("fact_id", F.lit(True).alias("__old"), *extra)
    status = F.col("verification_status")
    verified = X.is_verified(status)
    formal = F.when(status == "human_verified", "human_verified_evidence_fact").when(verified, "verified_evidence_fact").otherwise("machine_context_candidate_not_strict_formal_measurement")
    reason = F.when(verified, "retained_in_verified_knowledge_layer").otherwise("not_selected_or_reviewed_as_a_formal_measurement")
    rows = facts.select("fact_id", "source_id", "page", "verification_status").join(o, "fact_id", "left")
    default = {"formal_disposition": formal, "reason": reason}
    for c, value in default.items():
        rows = rows.withColumn(c, F.when(F.col("__old"), F.col(c) if c in extra else F.lit(None)).otherwise(value))
    return rows.drop("__old")


def disposition_counts(rows: DataFrame) -> DataFrame:
    """Counts by formal_disposition, and their total in the row "total"."""
    n = rows.rollup("formal_disposition").agg(F.count(F.lit(1)).alias("n"), F.grouping("formal_disposition").alias("g"))
    return n.select(F.when(F.col("g") == 1, "total").otherwise(F.col("formal_disposition")).alias("formal_disposition"), "n")
