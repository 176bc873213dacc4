"""Steps of the evidence engine whose cost grows with their input alone: what a page or an extraction costs is paid once."""

from pyspark.sql import functions as F

from quarrylight.operators import context, facts
from quarrylight.plans import profile
from quarrylight.plans import queries as Q

SF = "/root/testdata/sf0.001"
LETTERS = profile.from_dict({
    "schema_version": 1, "material_system": "x", "canonical_roots": {"paper": "papers"}, "keyword_groups": {"w": "word"}, "formula_pattern": "Li", "value_unit_pattern": r"\d+ %",
    "evidence_rules": {"required_context": ["source_page"]},
})


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def page(spark, *rows):
    return spark.createDataFrame([(f"s{i}", 1, t) for i, t in enumerate(rows)], "source_id string, page int, text string")


def test_both_halves_of_a_merge_read_one_extraction(spark):
    for half in Q._halves(spark, SF):
        assert "split(" not in plan(half) and "regexp" not in plan(half)


def test_locating_moves_a_text_once_and_normalises_it_once_a_page(spark):
    said = [f"This is word number {i} of a page that has many." for i in range(30)]
    pages = page(spark, " ".join(said), said[0], "")
    found = facts.fact_candidates(pages, LETTERS)
    located = context.locate(found, pages.union(page(spark, "", said[0]).filter("source_id = 's1'")))
    assert "min(text" not in plan(located) and "SortAggregate" not in plan(located, "executedPlan")
    assert {r.source_id: (r.n, r.st) for r in located.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("locator_status").alias("st")).collect()} == {"s0": (30, ["located_in_cached_page"]), "s1": (1, ["locator_needs_review"])}


def test_extraction_normalises_and_hashes_a_page_once(spark):
    said = ["😀 The first word of this page stands alone here.", "The second word of this page is said twice.", "The second word of this page is said twice.\xa0"]
    text = "\n\n".join(said)
    found = facts.fact_candidates(page(spark, text), LETTERS)
    assert plan(found).count("sha2(cast(text") == 1
    got = {r.evidence_text: r.source_span for r in found.collect()}
    assert len(got) == 2 and got[said[1]] is None
    span = got[said[0]]
    assert text.encode("utf-16-le")[2 * span.start : 2 * span.end].decode("utf-16-le") == said[0]


def test_sentences_are_dealt_over_cores_and_paired_once(spark):
    from quarrylight.operators import promotion

    kept = Q._sentences(spark, SF).filter(promotion.reject_reason(F.col("sentence")).isNull())
    assert kept.rdd.getNumPartitions() > 1
    paired = plan(promotion.pair_measurements(kept))
    assert "Union" not in paired and paired.count("Relation") == 1
