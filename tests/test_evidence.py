import gzip
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quarrylight.functions import text as X
from quarrylight.functions.register import register
from quarrylight.operators import assertions, context, datasets, facts, inventory, literature, merge, promotion
from quarrylight.plans import corpus, profile
from quarrylight.sources import files

BATTERY = {
    "schema_version": 1, "material_system": "battery", "canonical_roots": {"paper": "papers", "dataset": "data"},
    "keyword_groups": {"capacity": "specific capacity|discharge capacity"}, "formula_pattern": r"\b(?:LiFePO4|LiCoO2)\b", "value_unit_pattern": r"\d+(?:\.\d+)?\s*(?:mAh\s*g-1|%)",
    "evidence_rules": {"required_context": ["temperature", "atmosphere", "source_page"], "context_patterns": {"temperature": r"\d+\s*K\b"}},
}
HEAD = "SYNTHETIC TEST FIXTURE. These are invented values, not scientific evidence.\n\n"
SENTENCE = "LiFePO4 delivered a specific capacity of 155 mAh g-1 in an illustrative half-cell measurement."


def pages(spark, *texts):
    return spark.createDataFrame([("src_1", i + 1, t) for i, t in enumerate(texts)], "source_id string, page int, text string")


def screened(spark, *texts, p=BATTERY):
    return sorted(facts.fact_candidates(pages(spark, *texts), profile.from_dict(p)).collect(), key=lambda r: (r.page, r.ord))


def test_fact_identity_and_span(spark):
    (f,) = screened(spark, HEAD + SENTENCE)
    assert f.evidence_text == SENTENCE and f.themes == ["capacity"] and f.numeric_value_candidates == ["155 mAh g-1"] and f.confidence == "high"
    assert f.fact_id == "fact_" + hashlib.sha256(f"src_1|1|{SENTENCE}".encode()).hexdigest()[:20]
    assert (f.source_span.start, f.source_span.end) == (len(HEAD), len(HEAD) + len(SENTENCE))


def test_reflow_keeps_identity_and_blank_lines_split(spark):
    a, b = screened(spark, SENTENCE), screened(spark, SENTENCE.replace(" of ", " of\n"))
    assert a[0].fact_id == b[0].fact_id
    assert all(f.evidence_text != SENTENCE for f in screened(spark, SENTENCE.replace(" of ", " of\n\n")))


def test_repeated_sentence_has_no_span_and_pages_differ(spark):
    two = screened(spark, SENTENCE + " " + SENTENCE, SENTENCE)
    assert len(two) == 2 and two[0].source_span is None and two[1].source_span is not None and two[0].fact_id != two[1].fact_id


def test_utf16_span_round_trip(spark):
    text = "😀\n" + SENTENCE
    (f,) = screened(spark, text)
    wide = text.encode("utf-16-le")
    assert wide[2 * f.source_span.start : 2 * f.source_span.end].decode("utf-16-le") == text and f.evidence_text == "😀 " + SENTENCE


def test_table_rows(spark):
    p = BATTERY | {"formula_pattern": r"[A-Z][a-z]?\d+O\d"}
    text = "Table 2 discharge capacity\nLi1O2 with a value of\n155 in some units 20-30 °C\nLabel\nNa1O2 and more words to reach the length 77"
    got = screened(spark, text, p=p)
    rows = [f for f in got if f.extraction_method == facts.TABLE_ROW]
    assert [r.evidence_text for r in rows] == ["Li1O2 with a value of 155 in some units 20-30 °C", "Na1O2 and more words to reach the length 77"]
    assert rows[0].themes == ["capacity"] and "20-30 °C" in rows[0].temperature_candidates and "Label" not in rows[0].evidence_text


def test_null_text_and_empty_table(spark):
    assert screened(spark, None, "") == []
    assert facts.fact_candidates(pages(spark, "x").limit(0), profile.from_dict(BATTERY)).count() == 0


@pytest.mark.parametrize("change", [
    {"schema_version": 2}, {"canonical_roots": {"paper": "../x"}}, {"canonical_roots": {"paper": "a", "dataset": "a/b"}}, {"formula_pattern": "("}, {"value_unit_pattern": ""},
    {"evidence_rules": {"candidate_status": "human_verified"}}, {"evidence_rules": {"required_context": ["a", "a"]}}, {"evidence_rules": {"required_context": "a"}},
    {"evidence_rules": {"required_context": ["a"], "context_patterns": {"b": "x"}}}, {"evidence_rules": {"required_context": ["a"], "context_patterns": {"a": "x*"}}},
    {"evidence_rules": {"required_context": ["source_page"], "context_patterns": {"source_page": "x"}}},
])
def test_bad_profiles(change):
    with pytest.raises(ValueError):
        profile.from_dict(BATTERY | change)


def test_canonical_sources(spark):
    rows = spark.createDataFrame([("dataset", "a", "H1"), ("paper", "long/path", "H1"), ("paper", "Path", "H1"), ("thesis", "t", "H2"), ("paper", "broken", None)], "category string, path string, sha256 string")
    got = {r.sha256: r for r in inventory.canonical_sources(rows).collect()}
    assert got["H1"].path == "Path" and got["H1"].alias_paths == ["long/path", "a"] and got["H1"].all_categories == ["dataset", "paper"]
    dup = inventory.duplicates(rows).collect()
    assert sorted(str(r.duplicate_path) for r in dup) == ["None", "a", "long/path"]
    assert sorted(str(r.duplicate_path) for r in inventory.duplicates(rows.union(rows)).collect()) == ["None", "None", "Path", "a", "a", "long/path", "long/path", "t"]


def test_merge_and_dispositions(spark):
    made = facts.fact_candidates(pages(spark, HEAD + SENTENCE), profile.from_dict(BATTERY)).select("fact_id", "source_id", "page", "evidence_text", "verification_status")
    old = made.withColumn("fact_id", F.lit("legacy")).withColumn("evidence_text", F.replace("evidence_text", F.lit(" "), F.lit("  "))).withColumn("verification_status", F.lit("human_verified"))
    merged = merge.merge_preserved(made, old)
    assert [(r.fact_id, r.origin) for r in merged.collect()] == [("legacy", "preserved")]
    assert merge.merge_counts(merged).first().asDict() == {"preserved_fact_ids": 1, "preserved_verified_facts": 1, "new_machine_candidates": 0}
    with pytest.raises(assertions.EvidenceError):
        merge.merge_preserved(made.withColumn("evidence_text", F.lit("other")), made)
    with pytest.raises(assertions.EvidenceError):
        merge.load_preserved(old, [old.withColumn("page", F.lit(2))])
    with pytest.raises(assertions.EvidenceError):
        merge.load_preserved(made, [made])
    lost = spark.createDataFrame([("gone", "s", 1, "x", "d", "r")], "fact_id string, source_id string, page int, verification_status string, formal_disposition string, reason string")
    with pytest.raises(assertions.EvidenceError):
        merge.merge_dispositions(made, lost)
    (d,) = merge.merge_dispositions(merged, lost.limit(0)).collect()
    assert d.formal_disposition == "human_verified_evidence_fact"


def test_context_and_binding(spark):
    p = profile.from_dict(BATTERY)
    text = "😀 LiFePO4 delivered a specific capacity of 155 mAh g-1 at\n298 K.\n\nThe apparatus was kept in air."
    pg = pages(spark, text)
    f = facts.fact_candidates(pg, p).drop("ord")
    (c,) = context.context_checks(context.locate(f, pg), p).collect()
    got = {x.field: x for x in c.fields}
    assert c.needs_review and got["atmosphere"].status == "not_configured" and got["source_page"].status == "located_in_cached_page"
    m = got["temperature"].matches[0]
    assert f.first().evidence_text[m.start : m.end] == m.text == "298 K"
    stale = context.locate(f, pages(spark, "other text")).first()
    assert stale.locator_status == "locator_needs_review"
    checks = context.context_checks(context.locate(f, pg), p)
    fid = f.first().fact_id
    claim = lambda kind, why: spark.createDataFrame([("c1", "claim", kind, why)], "conclusion_id string, text string, claim_type string, rationale string")
    link = lambda *xs: spark.createDataFrame([("c1", *x) for x in xs], "conclusion_id string, fact_id string, relation string")
    none = spark.createDataFrame([], "conclusion_id string, fact_ids array<string>, description string")
    (b,) = context.bind_conclusions(claim("source_fact", None), link((fid, "supports")), none, f, checks).collect()
    assert b.support_state == "supporting_facts_machine_candidates" and b.binding_status == "references_validated_not_conclusion_verified"
    for bad in ((claim("inference", None), link((fid, "supports")), none), (claim("source_fact", None), link(("x", "supports")), none), (claim("source_fact", None), link((fid, "context")), none), (claim("source_fact", None), link((fid, "supports"), (fid, "context")), none), (claim("source_fact", None), link((fid, "supports")), spark.createDataFrame([("c1", [fid], "d")], none.schema))):
        with pytest.raises(assertions.EvidenceError):
            context.bind_conclusions(*bad, f, checks)


def test_corpus_run_refresh_and_validation(spark, tmp_path):
    root, out = tmp_path / "corpus", tmp_path / "out"
    for d in ("papers", "data"):
        (root / d).mkdir(parents=True)
    (root / "papers/_one.txt").write_text(HEAD + SENTENCE + "\n\nLiFePO4 retained its cycling response for 90 % in an illustrative test.")
    (root / "papers/copy.txt").write_text((root / "papers/_one.txt").read_text())
    (root / "data/m.csv").write_bytes("material;value\nLiFePO4;155\nragged\n".encode("gb18030"))
    (root / "data/x.json").write_text('{"a": [1, 2], "b": {"c": null}}')
    p = profile.from_dict(BATTERY, root)
    assert profile.preflight(p, root)["ready"]
    one = corpus.refresh(spark, p, str(root), str(out))["statistics"]
    assert (one["files"], one["sources"], one["facts"], one["documents_reextracted"]) == (4, 3, 2, 1)
    assert (one["documents"], one["datasets_reprofiled"], one["tables"], one["malformed_rows"], one["documents_awaiting_ocr"]) == (1, 2, 1, 0, 0)
    columns = {r.name: r for r in corpus.table(spark, str(out), "dataset_columns").collect()}
    # no delimiter is clear here, so that a comma is taken
    assert columns["material;value"].asDict() | {"source_id": ""} == {"source_id": "", "table_ord": 0, "column_no": 0, "name": "material;value", "nonempty_count": 2, "missing_count": 0, "distinct_count": 2, "numeric_count": 0, "min": None, "max": None, "mean": None, "sample_values": ["LiFePO4;155", "ragged"]}
    assert corpus.validate(spark, p, str(out)) == []
    wider = profile.from_dict(BATTERY | {"keyword_groups": BATTERY["keyword_groups"] | {"cycling": "cycling response"}}, root)
    two = corpus.refresh(spark, wider, str(root), str(out))["statistics"]
    assert two["documents_reextracted"] == two["datasets_reprofiled"] == 0 and two["tables"] == 1 and two["facts"] >= one["facts"] and two["preserved_fact_ids"] == one["facts"]
    assert "the profile has changed since" in corpus.validate(spark, p, str(out))
    n = corpus.export_json(corpus.table(spark, str(out), "facts").drop("origin"), str(out / "facts.json"), ["source_id", "ord"])
    assert len(json.loads((out / "facts.json").read_text())) == n == two["facts"]
    assert corpus.migrate(spark, wider, str(out), str(tmp_path / "staging"))["new_machine_candidates"] == 0
    (root / "papers/_one.txt").unlink()
    (root / "papers/copy.txt").unlink()
    with pytest.raises(assertions.EvidenceError):
        corpus.refresh(spark, wider, str(root), str(out))
    assert corpus.current(str(out))["statistics"] == two


def test_document_records_and_ocr(spark, tmp_path):
    from quarrylight.operators import documents

    (tmp_path / "ocr.json").write_text(json.dumps({"documents": [{"sha256": "aa", "pages": [{"page": 1, "text": "y" * 50, "error": None}, {"page": 2, "text": "short"}]}, {"sha256": "AA", "pages": [{"page": 1, "text": "later"}]}]}))
    ocr = files.ocr_pages(spark, str(tmp_path / "ocr.json"))
    assert {(r.sha256, r.page): r.ocr_text for r in ocr.collect()} == {("AA", 1): "y" * 50, ("AA", 2): "short"}
    rows = [("p", "AA", 1, "thin"), ("p", "AA", 2, "Abstract: " + "x" * 90 + "\nKeywords: k doi 10.1000/abc."), ("q", "BB", 1, "")]
    pg = files.substitute_ocr(spark.createDataFrame(rows, "source_id string, sha256 string, page int, text string"), ocr)
    assert {(r.source_id, r.page): r.text_source for r in pg.collect()} == {("p", 1): "ocr", ("p", 2): "embedded", ("q", 1): "embedded"}
    pg = pg.select("source_id", "page", "text", "text_source").unionByName(spark.createDataFrame([("t", 1, "word", "text_file")], "source_id string, page int, text string, text_source string"))
    made = [(s, n, n, th, fo) for s, n, th, fo in (("p", 1, ["b", "a"], ["F2", "F1"]), ("p", 2, ["a"], ["F1"]), ("t", 1, ["z"], ["F9", "F3"]))]
    f = spark.createDataFrame(made, "source_id string, page int, ord int, themes array<string>, material_formula_candidates array<string>")
    src = [(s, "paper", f"d/Nature - 2020 - {s}{x}", [], h, 1, x) for s, h, x in (("p", "AA", ".pdf"), ("q", "BB", ".pdf"), ("t", "CC", ".txt"), ("u", "DD", ".md"))]
    sources = spark.createDataFrame(src, "source_id string, category string, path string, alias_paths array<string>, sha256 string, size_bytes long, extension string")
    bad = spark.createDataFrame([("q", 1, "page 1: broken")], "source_id string, page int, error string")
    got = {r.source_id: r for r in documents.document_records(sources, pg, f, bad).collect()}
    p, q, t, u = (got[x] for x in "pqtu")
    assert p.bibliographic_metadata.file_name.title == "p" and p.bibliographic_metadata.doi_candidates == ["10.1000/abc"] and p.extraction.ocr_pages_used == 1 and p.extraction.text_chars == 51 + len(rows[1][3])
    assert p.distilled_sections.abstract_or_summary == "x" * 90 and p.distilled_sections.conclusion_or_outlook is None and p.distillation_status == "machine_distilled_with_ocr_page_provenance"
    assert [(x.theme, x.n) for x in p.distilled_index.themes] == [("a", 2), ("b", 1)] and p.distilled_index.material_formula_candidates == ["F1", "F2"] and p.distilled_index.fact_count == 2
    assert q.extraction.errors == ["page 1: broken"] and q.distillation_status == "unreadable_requires_ocr" and q.extraction.text_coverage_status == "ocr_or_manual_review_required"
    assert t.distilled_index.material_formula_candidates == ["F3", "F9"] and t.extraction.text_coverage_status == "text_extracted" and t.distillation_status == "machine_distilled_with_line_level_text"
    assert u.extraction.text_coverage_status == "unreadable" and u.distilled_index.fact_count == 0 and u.human_verification_status == "not_complete"
    records = documents.document_records(sources, pg, f, bad)
    assert {r.source_id for r in documents.ocr_targets(records).collect()} == {"p", "q", "u"}
    assert {r.source_id for r in documents.awaiting_ocr(records, ocr).collect()} == {"p"}


def test_file_profiles():
    assert files.profile_json(b"")["content_status"] == "empty_file"
    assert files.profile_json(b'{"a": [1], "b": {"c": {"d": {"e": 1}}}}')["shape"] == {"a": {"type": "array", "length": 1, "item_shape": "int"}, "b": {"c": {"d": {"e": "int"}}}}
    assert files.profile_gzip(gzip.compress(b'[{"x": 1}]'))["content_type"] == "json"
    assert files.profile_gzip(gzip.compress(b"{broken"))["content_type"] == "json_like"
    assert files.profile_gzip(gzip.compress("a\0  b­".encode()))["text_prefix"] == "a b"
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as w:
        w.writestr("a.txt", "hello")
    assert files.profile_zip(z.getvalue()) == {"format": "zip", "member_count": 1, "uncompressed_size_bytes": 5, "members": [{"path": "a.txt", "size_bytes": 5, "compressed_size_bytes": 5, "crc32": "3610A686", "is_directory": False}]}
    whole = b"[" + b"1," * (2 << 20) + b"1]"
    assert files.profile_gzip(gzip.compress(whole))["shape"]["length"] == (2 << 20) + 1 and files.profile_gzip(gzip.compress(whole)[:-2000])["content_type"] == "json_like"
    assert files.profile_text(b"a\r\nb\n", ".py") == {"format": "py", "line_count": 2, "text_chars": 4, "head": "a\nb"}
    assert files.read_csv(("a;b\n" + "1;2\n" * 30 + "5\n").encode("utf-8-sig"))[0] == [["a", "b"], *[["1", "2"]] * 30, ["5"]]
    assert files.read_csv("列,值\n钠,1\n".encode("gb18030"))[1] == "gb18030"


def test_scalar_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(X.clean(F.lit(" a\0b­  c\n \n\n\n d "))) == "a b c\n\nd"
    assert get(X.dois(F.lit("10.1000/abc.), 10.1000/ABC; 10.1000/abc"))) == ["10.1000/ABC", "10.1000/abc"]
    for odd in ("  a\u00ad b\0\0c \n\n\n\t d\u2003e\u00a0 ", "\0", "", "\u00ad \u00ad", "x\n \n y\x1c", "\x85a\r\nb "):
        assert get(X.one_line(F.lit(odd))) == get(X.squeeze(X.clean(F.lit(odd)))) == " ".join(odd.replace("\0", " ").replace("\u00ad", "").split())
    assert [get(X.plain_doi(F.lit(v))) for v in (" https://doi.org/10.1/A.", "DOI: 10.1/b);", None)] == ["10.1/a", "10.1/b", ""]
    assert get(X.document_doi(F.array(F.lit("10.1016/j.abc.20"), F.lit("10.1016/J.X.5"), F.lit("10.1/ab")))) == "10.1016/j.x.5"
    assert get(X.filename_metadata(F.lit("Nature - 2020 - A - B"), F.lit("paper"))).asDict() == {"title": "A - B", "year": 2020, "venue_or_institution": "Nature", "publication_number": None}
    assert get(X.section(F.lit("Abstract: " + "x" * 90 + "\nKeywords: a"), [r"^\s*abstract\s*[:—-]?"], [r"^\s*keywords"])) == "x" * 90
    assert get(X.valid_formula(F.lit("La0.6Sr0.4CoO3"))) and not get(X.valid_formula(F.lit("ABO3")))
    assert get(X.formula_key(F.lit("La0.6Sr0.4CoO3-δ"))) == "la0.6sr0.4co"
    assert get(X.parse_number(F.lit("1.5 × 10−3"))) == pytest.approx(0.0015)
    assert get(X.author_list(F.array(F.lit("a"), F.lit("b"), F.lit("c")))) == "a, b, and c"
    assert get(promotion.sentences(F.lit("At 7008C it is. Next one."))) == ["At 700 °C it is.", "Next one."]
    kinds = [get(datasets.infer_scalar(F.lit(v)))["kind"] for v in ("", "true", "1_000", "1.5e3", "nan", "1d")]
    assert kinds == ["null", "bool", "int", "float", "string", "string"]
    register(spark)
    assert spark.sql("SELECT stable_id('src', 'a') x").first().x == "src_" + hashlib.sha256(b"a").hexdigest()[:20]
    assert spark.sql("SELECT normalized_text('Ａ-b 中') x").first().x == "ab中"


def test_literature(spark):
    new = spark.createDataFrame([("f", "h1", ".pdf", "b"), ("f", "h1", ".pdf", "a"), ("f", "h2", ".zip", "c")], "family string, hash string, extension string, source string")
    taken = spark.createDataFrame([("f", 1)], "family string, number int")
    assert {(r.hash, r.number) for r in literature.number_attachments(new, taken).collect()} == {("h1", 2), ("h2", 3)}
    mains = spark.createDataFrame([("p1", "10.1/A"), ("p2", "10.1/b"), ("p3", "10.1/B")], "path string, doi string")
    sup = spark.createDataFrame([("s1", "10.1/a"), ("s2", "10.1/b")], "path string, doi string")
    assert {(r.path, r.related_paper) for r in literature.link_supplements(sup, mains).collect()} == {("s1", "p1"), ("s2", "https://doi.org/10.1/b")}


def test_streaming_refresh(spark, tmp_path):
    from quarrylight.streaming.refresh import screen_new_pages

    p = profile.from_dict(BATTERY)
    for n, text in enumerate((SENTENCE, SENTENCE + " More.")):
        pages(spark, text).write.mode("append").parquet(str(tmp_path / "pages"))
        screen_new_pages(spark, p, str(tmp_path / "pages"), str(tmp_path / "facts"), str(tmp_path / "ck")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "facts")).count() == 1


def test_promotion_job(spark):
    text = "We use La0.6Sr0.4Co0.2Fe0.8O3 (LSCF) here. LSCF has an electrical conductivity of 300 S cm-1 at 700 °C. The ASR was reported by others as 5 ohm cm2 at 600 °C."
    pg = spark.createDataFrame([("a", 1, text), ("a", 2, "References\nLSCF has an electrical conductivity of 301 S cm-1 at 700 °C."), ("b", 1, "x")], "source_id string, page int, text string")
    titles = spark.createDataFrame([("a", "Work on cathodes", "aa", "paper"), ("b", "A review of all", "bb", "paper"), ("c", "Other batch", "cc", "paper")], "source_id string, title string, sha256 string, category string")
    batch = spark.createDataFrame([("AA",), ("BB",)], "sha256 string")
    none = spark.createDataFrame([], "formula_key string, property string, value double, unit string, temperature_c double")
    new, why = promotion.promote(pg, titles, batch, none)
    (m,) = new.collect()
    assert (m.formula, m.value, m.unit, m.temperature_c) == ("La0.6Sr0.4Co0.2Fe0.8O3", 300.0, "S/cm", 700.0)
    assert {r.reason: r.n for r in why.collect()} == {"review_or_perspective_document": 1, "references_section": 1, "secondary_or_cited_statement": 1}
    again, why = promotion.promote(pg, titles, batch, new)
    assert again.count() == 0 and {r.reason: r.n for r in why.collect()}["already_in_master"] == 1


def test_formula_resolution(spark):
    from quarrylight.operators.formulas import contexts, resolve_formulas

    long, other, third = "La0.6Sr0.4Co0.2Fe0.8O3", "Ba0.5Sr0.5Co0.8Fe0.2O3", "Pr0.5Ba0.5Co2O5"
    docs = [
        ("a", f"On {long}", [f"We use {long} (LSCF) here."]), ("b", None, [f"{third} (PBC) and {other} (BSCF), Sr0.9 Ce0.1 Co0.9 Nb0.1 O3 (SCCN).", "", "", f"{long} (LATE)"]),
        ("c", "A title", None), ("d", f"{long}-δ work", [f"{long} (LSCF); {other} (LSCF)"]), ("e", f"{other} and {third}", []), ("f", "CeO2 and Gd0.1Ce0.9O1.95", ["x (ABC)"]),
    ]
    openings = spark.createDataFrame(docs, "source_id string, title string, pages array<string>")
    names = {r.source_id: dict(r.names) for r in contexts(openings).collect()}
    assert names["a"] == {"LSCF": long} and names["b"] == {"PBC": third, "BSCF": other, "SCCN": "Sr0.9Ce0.1Co0.9Nb0.1O3"} and names["c"] == {} and names["d"] == {"LSCF": other}
    cases = [
        ("a", "LSCF is good.", long, "document_abbreviation_definition"), ("a", "It is good.", long, "single_formula_in_title"), ("a", "The LSX is good.", long, "title_formula_for_named_material"),
        ("z", f"{other} is good.", other, "explicit_same_sentence"), ("z", "It is good.", None, "ambiguous_or_missing_formula"), ("b", "BSCF and PBC differ.", None, "ambiguous_or_missing_formula"),
        ("a", "The AAB and the CCD cathode.", long, "title_formula_for_named_cathode_abbreviation"), ("a", "The YSZ layer.", None, "ambiguous_or_missing_formula"), ("e", "It is good.", None, "ambiguous_or_missing_formula"),
        ("b", "The PBC-based one on XRD.", third, "document_abbreviation_definition"), ("f", "It is good.", None, "ambiguous_or_missing_formula"), ("a", None, long, "single_formula_in_title"),
    ]
    df = spark.createDataFrame([(c[0], i, c[1]) for i, c in enumerate(cases)], "source_id string, page int, sentence string")
    got = {r.page: (r.formula, r.formula_method) for r in resolve_formulas(df, openings).collect()}
    assert got == {i: c[2:] for i, c in enumerate(cases)}


def test_first_measurement_by_place(spark):
    """Of equal measurements on a page the first sentence stays, not the least."""
    rows = [("a", 1, s, "La0.6Sr0.4CoO3", o) for o, s in ((5, "A conductivity of 300 S cm-1 at 700 °C."), (2, "Z conductivity of 300 S cm-1 at 700 °C."))]
    paired = promotion.pair_measurements(spark.createDataFrame(rows, "source_id string, page int, sentence string, formula string, ord int"))
    none = spark.createDataFrame([], "formula_key string, property string, value double, unit string, temperature_c double")
    assert [r.sentence[0] for r in promotion.new_measurements(paired, none).collect()] == ["Z"]


def test_organiser(spark):
    rows = [("in/paper/Nature - 2020 - A long title.pdf", "h1", "text", None), ("in/x/A long title copy.pdf", "h1", "text", None), ("in/x/CN 1234567A.pdf", "h2", "发明专利 published on 2019-01-02", None), ("in/x/thesis.pdf", "h3", "博士学位论文 清华大学 2018", "A useful thesis title"), ("in/reports/r.pdf", "h4", "", None), ("in/x/y_SI.xlsx", "h5", None, None)]
    f = spark.createDataFrame(rows, "path string, hash string, text string, metadata_title string")
    for c, k in (("category", "string"), ("venue", "string"), ("year", "int"), ("title", "string"), ("doi", "string")):
        f = f.withColumn(f"{c}_o", F.lit(None).cast(k))
    got = {r.path: (r.status, r.target) for r in literature.organise(literature.classify(f)).collect()}
    assert got[rows[0][0]] == ("canonical", "paper/Nature - 2020 - A long title.pdf") and got[rows[2][0]] == ("canonical", "patent/CN1234567A - 2019.pdf")
    assert got[rows[3][0]] == ("canonical", "thesis/清华大学 - 2018 - A useful thesis title.pdf") and got[rows[4][0]] == ("excluded", None) and got[rows[5][0]] == ("unresolved", None)
