import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quarrylight.functions.register import register
from quarrylight.operators import literature, promotion
from quarrylight.operators.assertions import EvidenceError
from quarrylight.plans import binding, corpus, masters, profile
from quarrylight.sources import files

PROFILE = {
    "schema_version": 1, "material_system": "battery", "canonical_roots": {"paper": "papers"}, "keyword_groups": {"capacity": "specific capacity"},
    "formula_pattern": r"\bLiFePO4\b", "value_unit_pattern": r"\d+\s*mAh", "master_sources": [{"path": "masters/a.json", "existing_index_type": "cells", "pointer": "masters/head.json", "pointer_keys": ["now", "path"]}],
    "evidence_rules": {"required_context": ["source_page"], "context_patterns": {}},
}
SENTENCE = "LiFePO4 delivered a specific capacity of 155 mAh in an illustrative half-cell measurement."
FILE = "path string, hash string, status string, target string"


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest().upper()


def test_scan_and_overrides(spark):
    df = spark.createDataFrame([("a/x.PDF", None), ("a/(si).xlsx", None), ("a/x si.xlsx", None), ("a/y.xlsx", True), ("a/z.md", None), ("out/x.pdf", None), ("a/x.PDF", None)], "path string, supplementary_o boolean")
    assert {r.path for r in literature.scan(df, "out").collect()} == {"a/x.PDF", "a/x si.xlsx", "a/y.xlsx"}
    assert "a/z.md" in {r.path for r in literature.scan(df, markdown=True).collect()}
    over = spark.createDataFrame([("x.PDF", "by name", None), ("a/x.PDF", "by path", None), ("x.PDF", "again", "t")], "name string, venue string, title string")
    (r,) = literature.with_overrides(df.filter("path = 'a/x.PDF'").distinct(), over).collect()
    assert (r.venue_o, r.title_o) == ("by path", None)
    assert literature.with_overrides(df, over.limit(0)).filter("venue_o IS NOT NULL").isEmpty()


def test_supplements_keep_places_and_numbers(spark):
    rows = [("b.pdf", "h1", ".pdf", "10/a", None), ("a.pdf", "h2", ".pdf", "10/a", None), ("copy of a.pdf", "h2", ".pdf", "10/a", None), ("c.pdf", "h3", ".pdf", "10/a", 2), ("old.pdf", "h9", ".pdf", "10/a", None), ("two.pdf", "h4", ".pdf", "10/b", None), ("alone.pdf", "h5", ".pdf", "10/c", None)]
    sup = spark.createDataFrame(rows, "source string, hash string, extension string, doi string, attachment_number int")
    sup = sup.select("*", *(F.lit(None).cast("string").alias(c) for c in ("venue", "title", "related_paper")), F.lit(None).cast("int").alias("year"))
    mains = spark.createDataFrame([("10/a", "V", 2020, "T", "paper/V - 2020 - T.pdf"), ("10/c", "V", 2021, "U", "u"), ("10/b", "V", 1, "x", "1"), ("10/b", "V", 2, "y", "2")], "doi string, venue string, year int, title string, target string")
    ledger = spark.createDataFrame([("paper/SI - V - 2020 - T - 03.pdf", "T", "2020", "V", "h9"), ("paper/../SI - x - 01.pdf", "T", "2020", "V", "h1")], "path string, title string, year string, venue string, hash string")
    got = {r.source: r for r in literature.resolve_supplements(sup, mains, ledger).collect()}
    assert {s: r.attachment_number for s, r in got.items()} == {"a.pdf": 1, "copy of a.pdf": 1, "b.pdf": 4, "c.pdf": 2, "old.pdf": None, "two.pdf": None, "alone.pdf": None}
    assert got["old.pdf"].preserved_target == "paper/SI - V - 2020 - T - 03.pdf" and got["two.pdf"].status == "unresolved" and got["two.pdf"].related_paper == "https://doi.org/10/b"
    with pytest.raises(EvidenceError, match="positive"):
        literature.resolve_supplements(sup.withColumn("attachment_number", F.lit(0)), mains, ledger)


def test_numbers_in_ledger_names(spark):
    """The organiser's own names: a last part of digits is the number, else it is 1; a year in last place counts as one, too."""
    one = spark.createDataFrame([("V", "2020", "T", ".PDF")], "venue string, year string, title string, extension string")
    made = one.select(literature.target_name(F.lit("paper"), F.concat(F.lit("SI - "), "venue"), F.col("year"), F.col("title"), F.col("extension"))).first()[0]
    assert made == "paper/SI - V - 2020 - T.PDF"
    names = [made, "paper/SI - V - 2020 - T - 03.xlsx", "paper/SI - V - 2020.pdf", "paper/V - 2020 - T.pdf"]
    ledger = spark.createDataFrame([(n, "T", "2020", "V", "h") for n in names], "path string, title string, year string, venue string, hash string")
    assert {(r.path, r.number, r.extension) for r in literature.attached(ledger).collect()} == {(names[0], 1, ".pdf"), (names[1], 3, ".xlsx"), (names[2], 2020, ".pdf")}


def test_apply_plan(spark, tmp_path):
    for n, b in (("x", b"one"), ("y", b"one"), ("z", b"two")):
        (tmp_path / n).write_bytes(b)
    rows = [(str(tmp_path / "x"), sha(b"one"), "canonical", "paper/x.pdf"), (str(tmp_path / "y"), sha(b"one"), "exact_duplicate", None), (str(tmp_path / "z"), sha(b"two"), "canonical", "paper/z.pdf")]
    plan, out = spark.createDataFrame(rows, FILE), tmp_path / "out"
    assert literature.apply_plan(plan, str(out)) == {"mode": "preview", "absent": 2} and not out.exists()
    assert literature.apply_plan(plan, str(out), apply=True) == {"mode": "apply", "copied_or_there": 2, "deleted": 0}
    assert (out / "paper/x.pdf").read_bytes() == b"one" and (tmp_path / "y").exists() and len(list((out / "paper").iterdir())) == 2
    assert literature.apply_plan(plan, str(out), True, True)["deleted"] == 1 and not (tmp_path / "y").exists()
    (out / "paper/z.pdf").write_bytes(b"other")
    with pytest.raises(EvidenceError, match="other bytes"):
        literature.apply_plan(plan, str(out), apply=True)
    assert (out / "paper/z.pdf").read_bytes() == b"other"
    for bad, why in (([("q", "h", "unresolved", None)], "unresolved"), ([("q", "h", "canonical", "A"), ("r", "i", "canonical", "a")], "collide")):
        with pytest.raises(EvidenceError, match=why):
            literature.apply_plan(spark.createDataFrame(bad, FILE), str(out))


def test_batch_hashes(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/x").write_bytes(b"one")
    (tmp_path / "d/inner.zip").write_bytes(b"not opened")
    with zipfile.ZipFile(tmp_path / "b.ZIP", "w") as z:
        z.writestr("m", b"two")
        z.writestr("n", b"one")
    got = {r.sha256 for r in files.batch_hashes(spark, [str(tmp_path / "d"), str(tmp_path / "b.ZIP")]).collect()}
    assert got == {sha(b"one"), sha(b"two"), sha(b"not opened")}
    with pytest.raises(FileNotFoundError):
        files.batch_hashes(spark, [str(tmp_path / "none")])


def test_promotion_snapshot(spark):
    new = spark.createDataFrame([("s", "la", "ASR", 2.0, "Ω", 700.0, 3, "By EIS in air.", "La"), ("s", "la", "ASR", 1.0, "Ω", 650.0, 4, "Plain.", "LA"), ("t", "sr", "TEC", 1.0, "K", None, 1, None, None)], "source_id string, formula_key string, property string, value double, unit string, temperature_c double, page int, sentence string, formula string")
    about = spark.createDataFrame([("s", "Title", "10/a", "p.pdf")], "source_id string, title string, doi string, path string")
    made = promotion.records(new, about, "2020-01-01").cache()
    s, t = sorted(made.collect(), key=lambda r: r.source_id)
    assert [m.temperature_c for m in s.measurements] == [650.0, 700.0] and s.formula == "La" and s.external_source.doi == "10/a" and t.external_source.doi is None
    assert s.measurements[1].test_context.test_method == "EIS" and s.measurements[1].missing_fields == ["electrolyte", "synthesis_method"] and s.measurements[0].missing_fields == ["electrolyte", "test_method", "synthesis_method"]
    assert {r.priority for r in promotion.review_queue(made).filter("temperature_c = 650").collect()} == {"high"}
    c = promotion.coverage_counts(made).first()
    assert (c.records, c.measurements, c.test_method, c.exact_original_sentence, c.figure) == (2, 3, 1, 2, 0)
    assert promotion.coverage_counts(made.limit(0)).first().measurements == 0
    counts = promotion.audit(made.filter("source_id = 's'"), made.filter("source_id = 't'"), spark.createDataFrame([("x", 2)], "reason string, n long"))
    assert counts["output_counts"] == {"sources": 2, "records": 2, "measurements": 3} and counts["added_source_count"] == 1 and counts["rejection_counts"] == {"x": 2}
    assert promotion.snapshot(made.filter("source_id = 's'"), made.filter("source_id = 't'")).count() == 2
    with pytest.raises(EvidenceError):
        promotion.snapshot(made, made)


def test_masters(spark, tmp_path):
    m = tmp_path / "masters"
    m.mkdir()
    (m / "a.json").write_text(json.dumps({"database_type": "cells", "records": [1, 2], "screened_literature_extracted_data": {"records": [1]}}))
    (m / "b.json").write_text("{}")
    p = profile.from_dict(PROFILE)
    assert masters.master_paths(p, tmp_path) == [m / "a.json"]
    (m / "head.json").write_text(json.dumps({"now": {"path": "masters/b.json"}}))
    assert masters.master_paths(p, tmp_path) == [m / "b.json"]
    entry = {"path": "masters/a.json", "sha256": sha((m / "a.json").read_bytes()), "database_type": "cells"}
    assert masters.master_paths(p, tmp_path, [entry]) == [m / "a.json"]
    for bad in ([entry, entry], [entry | {"sha256": "00"}]):
        with pytest.raises(EvidenceError):
            masters.master_paths(p, tmp_path, bad)
    (r,) = masters.master_profiles(spark, [m / "a.json"], tmp_path).collect()
    assert (r.record_counts.records, r.record_counts.composition_only_records, r.record_counts.screened_literature_records) == (2, 0, 1) and r.sha256 == entry["sha256"]
    assert masters.latest(["evidence_fact_dispositions_2.json", "evidence_fact_dispositions_10.json", "x"]) == "evidence_fact_dispositions_2.json"
    assert masters.latest(["evidence_fact_dispositions_2.json", "evidence_fact_dispositions.json"]) == "evidence_fact_dispositions.json" and masters.latest([]) is None


def test_bind_a_run(spark, tmp_path):
    (tmp_path / "papers").mkdir()
    (tmp_path / "masters").mkdir()
    (tmp_path / "masters/a.json").write_text('{"database_type": "cells", "records": []}')
    text = tmp_path / "papers/one.txt"
    text.write_text(SENTENCE)
    p, out = profile.from_dict(PROFILE), str(tmp_path / "out")
    run = corpus.refresh(spark, p, str(tmp_path), out)
    assert run["statistics"]["masters"] == 1 and corpus.validate(spark, p, out, str(tmp_path)) == []
    assert corpus.manifest_faults({"schema_version": "2", "scope": {}}) and corpus.manifest_faults([]) == ["the manifest is no object"]
    (fact,) = corpus.table(spark, out, "facts").collect()
    made = {"schema_version": "1.0.0", "conclusions": [{"conclusion_id": "c", "text": "So it is.", "claim_type": "source_fact", "evidence": [{"fact_id": fact.fact_id, "relation": "supports"}]}]}
    (tmp_path / "in.json").write_text(json.dumps(made))
    args = (spark, p, str(tmp_path), out, "in.json", "bound.json")
    assert binding.bind(*args)["conclusions"] == 1
    assert json.loads((tmp_path / "bound.json").read_text())["conclusions"][0]["support_state"] == "supporting_facts_machine_candidates"
    assert binding.bind(*args, validate_only=True)["validate_only"]
    for bad in ("in.json", "papers/x.json", "x.txt", "masters/a.json"):
        with pytest.raises(EvidenceError):
            binding.bind(*args[:5], bad)
    (tmp_path / "in.json").write_text(json.dumps(made | {"conclusions": [made["conclusions"][0] | {"text": "Or not."}]}))
    with pytest.raises(EvidenceError, match="stale"):
        binding.bind(*args, validate_only=True)
    (tmp_path / "masters/a.json").write_text("{}")
    assert corpus.validate(spark, p, out, str(tmp_path)) == ["the master masters/a.json has changed"]
    text.write_text(SENTENCE + " More.")
    with pytest.raises(EvidenceError, match="source bytes"):
        binding.bind(*args)


def test_sql_functions_over_bytes(spark):
    register(spark)
    spark.createDataFrame([(1, bytearray(b"a;b\n1;2\n")), (2, None)], "id int, content binary").createOrReplaceTempView("raw_files")
    got = spark.sql("SELECT id, row_no, cells FROM raw_files, LATERAL csv_cells(content)").collect()
    assert sorted((r.id, r.row_no, r.cells) for r in got) == [(1, 0, ["a", "b"]), (1, 1, ["1", "2"])]
    (r,) = spark.sql("SELECT clean_text('\t a\\u00ad  b\n \n\n\nc ') AS t, match_spans('At 5 K', '[0-9]+ k') AS m, match_spans(NULL, 'x') AS n").collect()
    assert r.t == "a b\n\nc" and (r.m[0].text, r.m[0].start, r.m[0].end) == ("5 K", 3, 6) and r.n is None
