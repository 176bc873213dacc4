"""Queries of the evidence engine over the driver's tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions import text as X
from quarrylight.operators import context, datasets, documents, facts, inventory, lineage, literature, merge, promotion
from quarrylight.plans import binding, corpus
from quarrylight.plans.profile import Profile, from_dict

PROFILE: Profile = from_dict({
    "schema_version": 1, "material_system": "licences", "canonical_roots": {"paper": "documents"},
    "keyword_groups": {"license": "license|copyright", "function_words": " the .* of "},
    "formula_pattern": "(?:MIT|Apache|GNU|CC BY-NC)", "value_unit_pattern": r"\d{1,3}(?:\.\d{1,3}){3}",
    "evidence_rules": {"required_context": ["license_name", "address", "owner", "source_page"], "context_patterns": {"license_name": "mit|apache|gnu", "address": r"\d+\.\d+"}},
})
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(c: Column | str) -> Column:
    return F.array_join(c, "|")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.lit("paper").alias("category"), F.col("doc_id").cast("string").alias("path"), F.lit(".txt").alias("extension"), X.file_hash(F.col("text")).alias("sha256"), "text", "lang")


def document_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = inventory.canonical_sources(document_rows(spark, sf_dir))
    return facts.fact_candidates(s.select("source_id", F.lit(1).alias("page"), "text"), PROFILE)


SRC = "'src_' || left(sha256(upper(sha256(text))), 20)"
CUT = r"unnest(string_split(regexp_replace(text, '([.!?。！？;；])\s+', '\1' || chr(1), 'g'), chr(1)))"
SQUEEZE = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
HITS = r"""regexp_matches(s, 'license|copyright', 'i') AS t1, regexp_matches(s, ' the .* of ', 'i') AS t2,
 regexp_extract_all(s, '\d{1,3}(?:\.\d{1,3}){3}') AS vs, list_sort(list_distinct(regexp_extract_all(s, '(?:MIT|Apache|GNU|CC BY-NC)'))) AS fs"""
# facts of documents: doc (smallest id), source_id, s, t1, t2, vs, fs
FACTS = f"""canon AS (SELECT {SRC} AS source_id, text, doc_id FROM documents),
 canon1 AS (SELECT source_id, min(doc_id) AS doc_id, any_value(text) AS text FROM canon GROUP BY source_id),
 cut AS (SELECT source_id, doc_id, {CUT} AS raw FROM canon1),
 sent AS (SELECT DISTINCT source_id, doc_id, {SQUEEZE.format('raw')} AS s FROM cut),
 hit AS (SELECT source_id, doc_id, s, {HITS} FROM sent WHERE length(s) BETWEEN 35 AND 1600),
 facts AS (SELECT *, 'fact_' || left(sha256(source_id || '|1|' || s), 20) AS fact_id, CASE WHEN len(vs) > 0 AND (t1 OR t2 OR len(fs) > 0) THEN 'high' ELSE 'medium' END AS confidence
  FROM hit WHERE t1 OR t2 OR (len(vs) > 0 AND len(fs) > 0))"""
THEMES = "concat_ws('|', CASE WHEN t1 THEN 'license' END, CASE WHEN t2 THEN 'function_words' END)"


@query(f"WITH {FACTS} SELECT fact_id, source_id, s AS evidence_text, {THEMES} AS themes, array_to_string(vs, '|') AS vals, array_to_string(fs, '|') AS formulas, confidence FROM facts")
def flagship_fact_candidates(spark, sf_dir):
    f = document_facts(spark, sf_dir)
    return f.select("fact_id", "source_id", "evidence_text", joined("themes").alias("themes"), joined("numeric_value_candidates").alias("vals"), joined("material_formula_candidates").alias("formulas"), "confidence")


@query(f"SELECT doc_id, upper(sha256(text)) AS sha256, {SRC} AS source_id FROM documents")
def inventory_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.file_hash(F.col("text")).alias("sha256"), X.source_id(X.file_hash(F.col("text"))).alias("source_id"))


@query(f"""SELECT {SRC} AS source_id, min(doc_id)::VARCHAR AS path, count(*) - 1 AS n_aliases,
 coalesce(array_to_string(list_sort(list(doc_id))[2:], '|'), '') AS aliases FROM documents GROUP BY 1""")
def dedup_canonical(spark, sf_dir):
    c = inventory.canonical_sources(document_rows(spark, sf_dir))
    return c.select("source_id", "path", F.size("alias_paths").cast("bigint").alias("n_aliases"), joined("alias_paths").alias("aliases"))


@query(f"""WITH k AS (SELECT *, {SRC} AS source_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)
 SELECT doc_id::VARCHAR AS duplicate_path, source_id AS canonical_source_id, first::VARCHAR AS canonical_path, 'byte_identical_sha256' AS reason FROM k WHERE doc_id <> first""")
def dedup_aliases(spark, sf_dir):
    return inventory.duplicates(document_rows(spark, sf_dir)).select("duplicate_path", "canonical_source_id", "canonical_path", "reason")


@query(f"WITH c AS (SELECT doc_id, {CUT} AS raw FROM documents), s AS (SELECT doc_id, {SQUEEZE.format('raw')} AS sentence FROM c) SELECT doc_id, sentence, count(*) AS n FROM s WHERE length(sentence) BETWEEN 35 AND 1600 GROUP BY 1, 2")
def sentence_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", F.lit(X.java(X.SPLIT_PROSE)), -1)).alias("piece"))
    s = d.select("doc_id", X.one_line(F.col("piece")).alias("sentence"))
    return s.filter(F.length("sentence").between(X.SHORTEST, X.LONGEST)).groupBy("doc_id", "sentence").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH cut AS (SELECT 'conv_' || conv_id AS source_id, turn + 1 AS page, {CUT} AS raw FROM conversations),
 sent AS (SELECT DISTINCT source_id, page, {SQUEEZE.format('raw')} AS s FROM cut), hit AS (SELECT *, {HITS} FROM sent WHERE length(s) BETWEEN 35 AND 1600)
 SELECT 'fact_' || left(sha256(source_id || '|' || page || '|' || s), 20) AS fact_id, page FROM hit WHERE t1 OR t2 OR (len(vs) > 0 AND len(fs) > 0)""")
def multi_page_facts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    pages = c.select(F.concat(F.lit("conv_"), "conv_id").alias("source_id"), (F.col("turn") + 1).alias("page"), "text")
    return facts.fact_candidates(pages, PROFILE).select("fact_id", "page")


@query(f"WITH {FACTS}, t AS (SELECT unnest([CASE WHEN t1 THEN 'license' END, CASE WHEN t2 THEN 'function_words' END]) AS theme FROM facts) SELECT theme, count(*) AS n FROM t WHERE theme IS NOT NULL GROUP BY 1")
def theme_counts(spark, sf_dir):
    return facts.theme_counts(document_facts(spark, sf_dir))


@query(f"""WITH {FACTS}, t AS (SELECT doc_id, unnest([CASE WHEN t1 THEN 'license' END, CASE WHEN t2 THEN 'function_words' END]) AS theme FROM facts)
 SELECT coalesce(lang, 'all') AS lang, coalesce(theme, 'all') AS theme, count(*) AS n FROM t JOIN documents USING (doc_id) WHERE theme IS NOT NULL GROUP BY ROLLUP (lang, theme)""")
def theme_counts_by_lang_rollup(spark, sf_dir):
    c = inventory.canonical_sources(document_rows(spark, sf_dir)).select("source_id", "lang")
    t = document_facts(spark, sf_dir).join(c, "source_id").select("lang", F.explode("themes").alias("theme"))
    return t.rollup("lang", "theme").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("lang", F.lit("all")).alias("lang"), F.coalesce("theme", F.lit("all")).alias("theme"), "n")


@query(r"SELECT doc_id, unnest(regexp_extract_all(text, '\d{1,3}(?:\.\d{1,3}){3}')) AS val FROM documents")
def value_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(X.find_all(F.col("text"), PROFILE.value_unit_pattern, True)).alias("val"))


@query("""SELECT p_partkey, '10.1234/part.' || p_partkey AS doi FROM part""")
def doi_extract(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    text = F.concat(F.lit("See (doi: 10.1234/PART."), F.col("p_partkey"), F.lit(")."))
    return p.select("p_partkey", F.lower(F.element_at(X.dois(text), 1)).alias("doi"))


@query(f"WITH {FACTS} SELECT confidence, count(*) AS n FROM facts GROUP BY 1")
def confidence_split(spark, sf_dir):
    return document_facts(spark, sf_dir).groupBy("confidence").agg(F.count(F.lit(1)).alias("n"))


@query(rf"""WITH {FACTS}, w AS (SELECT f.fact_id, f.s, c.text, regexp_replace(f.s, '\s+', '', 'g') AS needle, regexp_replace(c.text, '\s+', '', 'g') AS hay FROM facts f JOIN canon1 c USING (source_id))
 SELECT fact_id, position(needle IN hay) > 0 AND position(needle IN substr(hay, position(needle IN hay) + 1)) = 0 AS located, sha256(text) AS page_sha256 FROM w""")
def span_uniqueness(spark, sf_dir):
    # a text's page is its content
    c = inventory.canonical_sources(document_rows(spark, sf_dir).drop("text", "lang")).select("source_id", F.lower("sha256").alias("page_sha256"))
    return document_facts(spark, sf_dir).join(c, "source_id").select("fact_id", F.col("source_span").isNotNull().alias("located"), "page_sha256")


@query(rf"""WITH {FACTS}, w AS (SELECT f.fact_id, f.s, c.text, position(f.s IN regexp_replace(c.text, '\s', ' ', 'g')) AS pos, regexp_replace(f.s, '\s+', '', 'g') AS needle, regexp_replace(c.text, '\s+', '', 'g') AS hay FROM facts f JOIN canon1 c USING (source_id))
 SELECT fact_id, pos - 1 AS span_start, pos - 1 + length(s) AS span_end FROM w WHERE pos > 0 AND position(needle IN substr(hay, position(needle IN hay) + 1)) = 0""")
def source_span(spark, sf_dir):
    s = document_facts(spark, sf_dir).filter("source_span IS NOT NULL")
    return s.select("fact_id", F.col("source_span.start").alias("span_start"), F.col("source_span.end").alias("span_end"))


@query("SELECT doc_id, CASE WHEN length(text) >= 200 THEN 'text_extracted' ELSE 'ocr_or_manual_review_required' END AS coverage FROM documents")
def coverage_status(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.pdf_coverage(F.length("text"), F.lit(1)).alias("coverage"))


@query("""SELECT doc_id, CASE WHEN length(html) >= 20 AND length(html) > greatest(20, 2 * length(text)) THEN 'ocr' ELSE 'embedded' END AS text_source,
 CASE WHEN length(html) >= 20 AND length(html) > greatest(20, 2 * length(text)) THEN length(html) ELSE length(text) END AS n FROM documents LEFT JOIN pages ON doc_id = page_id""")
def ocr_substitution(spark, sf_dir):
    from quarrylight.sources.files import substitute_ocr

    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("sha256"), F.lit(1).alias("page"), "text")
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("sha256"), F.lit(1).alias("page"), F.col("html").alias("ocr_text"))
    return substitute_ocr(d, p).select("doc_id", "text_source", F.length("text").cast("bigint").alias("n"))


def document_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = inventory.canonical_sources(document_rows(spark, sf_dir)).select("source_id", F.lit(1).alias("page"), "text")
    return context.context_checks(context.locate(document_facts(spark, sf_dir), c), PROFILE)


@query(rf"""WITH {FACTS} SELECT fact_id, unnest(['license_name', 'address', 'owner', 'source_page']) AS field,
 unnest([CASE WHEN regexp_matches(s, 'mit|apache|gnu', 'i') THEN 'located_in_candidate' ELSE 'not_located_in_candidate' END,
 CASE WHEN regexp_matches(s, '\d+\.\d+') THEN 'located_in_candidate' ELSE 'not_located_in_candidate' END, 'not_configured', 'located_in_cached_page']) AS status FROM facts""")
def context_checks(spark, sf_dir):
    return document_checks(spark, sf_dir).select("fact_id", F.explode("fields").alias("f")).select("fact_id", F.col("f.field").alias("field"), F.col("f.status").alias("status"))


@query(rf"""WITH {FACTS}, x AS (SELECT regexp_matches(s, 'mit|apache|gnu', 'i') AS a, regexp_matches(s, '\d+\.\d+') AS b FROM facts)
 SELECT 'license_name' AS field, CASE WHEN a THEN 'located_in_candidate' ELSE 'not_located_in_candidate' END AS status, count(*) AS n FROM x GROUP BY ALL
 UNION ALL SELECT 'address', CASE WHEN b THEN 'located_in_candidate' ELSE 'not_located_in_candidate' END, count(*) FROM x GROUP BY ALL
 UNION ALL SELECT 'owner', 'not_configured', count(*) FROM x UNION ALL SELECT 'source_page', 'located_in_cached_page', count(*) FROM x""")
def context_status_counts(spark, sf_dir):
    return context.status_counts(document_checks(spark, sf_dir))


def _matches_sql(field: str, pattern: str) -> str:
    return f"""SELECT fact_id, '{field}' AS field, i AS number, m[i] AS match, list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)::BIGINT AS start
 FROM (SELECT fact_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT fact_id, regexp_extract_all(s, '{pattern}') AS m, string_split_regex(s, '{pattern}') AS g FROM facts))"""


@query(f"WITH {FACTS} {_matches_sql('license_name', '(?i)(?:mit|apache|gnu)')} UNION ALL {_matches_sql('address', '[0-9]+[.][0-9]+')}")
def context_match_offsets(spark, sf_dir):
    m = document_checks(spark, sf_dir).select("fact_id", F.explode("fields").alias("f")).select("fact_id", "f.field", F.posexplode("f.matches").alias("number", "m"))
    return m.select("fact_id", "field", (F.col("number") + 1).cast("bigint").alias("number"), F.col("m.text").alias("match"), F.col("m.start").cast("bigint").alias("start"))


@query(f"WITH {FACTS} SELECT fact_id, 'located_in_cached_page' AS locator_status, true AS needs_review FROM facts")
def context_needs_review(spark, sf_dir):
    return document_checks(spark, sf_dir).select("fact_id", "locator_status", "needs_review")


def _halves(spark, sf_dir):
    # both halves are read from one extraction; sources are told apart without their texts
    f = lineage.cut(document_facts(spark, sf_dir), "facts")
    old = inventory.canonical_sources(document_rows(spark, sf_dir).drop("text", "lang")).filter("cast(path AS BIGINT) % 2 = 0").select("source_id")
    return f, f.join(old, "source_id", "left_semi")


@query(rf"""WITH {FACTS}, one AS (SELECT *, row_number() OVER (PARTITION BY source_id, regexp_replace(s, '\s+', '', 'g') ORDER BY fact_id) AS rn FROM facts)
 SELECT fact_id, CASE WHEN doc_id % 2 = 0 THEN 'preserved' ELSE 'new' END AS origin FROM one""")
def merge_preserved(spark, sf_dir):
    return merge.merge_preserved(*_halves(spark, sf_dir)).select("fact_id", "origin")


@query(f"""WITH {FACTS} SELECT count(*) FILTER (doc_id % 2 = 0) AS preserved_fact_ids, 0::BIGINT AS preserved_verified_facts, count(*) FILTER (doc_id % 2 <> 0) AS new_machine_candidates FROM facts""")
def merge_counts(spark, sf_dir):
    return merge.merge_counts(merge.merge_preserved(*_halves(spark, sf_dir)))


def _label_facts(spark, sf_dir):
    status = F.when(F.col("toxic") == 1, "agent_verified").when(F.col("quality") == 1, "human_verified").otherwise("source_located_not_human_verified")
    return table(spark, sf_dir, "labels").select(F.concat(F.lit("fact_"), "doc_id").alias("fact_id"), F.col("doc_id").cast("string").alias("source_id"), F.lit(1).alias("page"), status.alias("verification_status"))


@query("""WITH l AS (SELECT 'fact_' || doc_id AS fact_id, CASE WHEN toxic = 1 THEN 'agent_verified' WHEN quality = 1 THEN 'human_verified' ELSE 'source_located_not_human_verified' END AS st, doc_id FROM labels)
 SELECT fact_id, st AS verification_status, CASE WHEN doc_id % 7 = 0 THEN 'kept' WHEN st = 'human_verified' THEN 'human_verified_evidence_fact' WHEN st = 'agent_verified' THEN 'verified_evidence_fact' ELSE 'machine_context_candidate_not_strict_formal_measurement' END AS formal_disposition FROM l""")
def dispositions_merge(spark, sf_dir):
    f = _label_facts(spark, sf_dir)
    old = f.filter("cast(source_id AS BIGINT) % 7 = 0").withColumn("formal_disposition", F.lit("kept")).withColumn("reason", F.lit("reviewed"))
    return merge.merge_dispositions(f, old).select("fact_id", "verification_status", "formal_disposition")


@query("""WITH l AS (SELECT CASE WHEN toxic = 1 THEN 'verified_evidence_fact' WHEN quality = 1 THEN 'human_verified_evidence_fact' ELSE 'machine_context_candidate_not_strict_formal_measurement' END AS d FROM labels)
 SELECT coalesce(d, 'total') AS formal_disposition, count(*) AS n FROM l GROUP BY ROLLUP (d)""")
def disposition_counts(spark, sf_dir):
    f = _label_facts(spark, sf_dir)
    return merge.disposition_counts(merge.merge_dispositions(f, f.limit(0).withColumn("formal_disposition", F.lit("")).withColumn("reason", F.lit(""))))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def orphan_check(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


def _bound(spark, sf_dir):
    """Conclusions over the labels: c0, c1, ... by doc_id mod 40; every fifth fact contradicts."""
    f = _label_facts(spark, sf_dir).withColumn("evidence_text", F.concat(F.lit("evidence "), "source_id")).withColumn("source_span", F.lit(None).cast("struct<source_id:string,page:int,page_sha256:string,start:bigint,end:bigint,offset_unit:string,raw_text_sha256:string>"))
    pages = f.select("source_id", "page", F.col("evidence_text").alias("text"))
    n = F.col("source_id").cast("bigint")
    links = f.select(F.concat(F.lit("c"), n % 40).alias("conclusion_id"), "fact_id", F.when(n % 5 == 4, "contradicts").otherwise("supports").alias("relation"))
    own = links.filter("relation = 'supports'").select("conclusion_id").distinct()
    links = links.join(own, "conclusion_id", "left_semi")
    claims = own.select("conclusion_id", F.lit("claim").alias("text"), F.lit("source_fact").alias("claim_type"), F.lit(None).cast("string").alias("rationale"))
    # every third conclusion that has two facts says that its first and last ones differ
    pair = links.filter("cast(substring(conclusion_id, 2) AS INT) % 3 = 0").groupBy("conclusion_id").agg(F.array_distinct(F.array(F.min("fact_id"), F.max("fact_id"))).alias("fact_ids"))
    conflicts = pair.filter("size(fact_ids) = 2").withColumn("description", F.lit("they differ"))
    return context.bind_conclusions(claims, links, conflicts, f, context.context_checks(context.locate(f, pages), PROFILE))


@query("""WITH l AS (SELECT doc_id % 40 AS c, 'c' || doc_id % 40 AS conclusion_id, doc_id % 5 = 4 AS con, CASE WHEN toxic = 1 THEN 'a' WHEN quality = 1 THEN 'h' ELSE 'm' END AS st FROM labels)
 SELECT conclusion_id, CASE WHEN bool_and(con OR st = 'h') THEN 'supporting_facts_human_verified' WHEN bool_and(con OR st = 'a') THEN 'supporting_facts_agent_verified' WHEN bool_and(con OR st = 'm') THEN 'supporting_facts_machine_candidates'
 ELSE 'supporting_facts_mixed_or_project_specific_status' END AS support_state, bool_or(con) OR (any_value(c) % 3 = 0 AND count(*) > 1) AS has_conflicting_evidence, any_value(c) % 3 = 0 AND count(*) > 1 AS disputed,
 true AS context_needs_review, count(*) AS n FROM l GROUP BY 1 HAVING bool_or(NOT con)""")
def binding_support_state(spark, sf_dir):
    b = _bound(spark, sf_dir)
    return b.select("conclusion_id", "support_state", "has_conflicting_evidence", F.col("conflicts").isNotNull().alias("disputed"), "context_needs_review", F.size("evidence").cast("bigint").alias("n"))


def _profile_sql(name: str, numbers: list[str], others: list[str]) -> str:
    one = lambda c, n: f"SELECT '{c}' AS name, count(nullif({c}::VARCHAR, '')) AS nonempty_count, count(*) - count(nullif({c}::VARCHAR, '')) AS missing_count, count(DISTINCT {c}) AS distinct_count, " + (f"count({c}) AS numeric_count, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c})::DOUBLE, 4) AS mean FROM {name}" if n else f"0::BIGINT AS numeric_count, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean FROM {name}")
    return " UNION ALL ".join([one(c, True) for c in numbers] + [one(c, False) for c in others])


def _profiled(name: str, numbers: list[str], others: list[str]) -> None:
    def run(spark, sf_dir):
        p = datasets.column_profile(table(spark, sf_dir, name), [*numbers, *others])
        return p.withColumn("mean", F.round("mean", 4))

    run.__name__ = f"column_profile_{name}"
    query(_profile_sql(name, numbers, others))(run)


_profiled("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_returnflag", "l_linestatus", "l_shipdate"])
_profiled("orders", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority", "o_orderdate"])
_profiled("customer", ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"])
_profiled("part", ["p_partkey", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"])
_profiled("events", ["event_id", "user_id", "value"], ["event_type", "props", "ts"])


@query(r"""WITH v AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_type WHEN 2 THEN 'TRUE' WHEN 3 THEN ' ' WHEN 4 THEN (event_id || '.5e1') ELSE event_id || 'd' END AS t FROM events)
 SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'int' WHEN 1 THEN 'string' WHEN 2 THEN 'bool' WHEN 3 THEN 'null' WHEN 4 THEN 'float' ELSE 'string' END AS kind, CASE event_id % 6 WHEN 0 THEN event_id::DOUBLE WHEN 2 THEN 1.0 WHEN 4 THEN t::DOUBLE END AS number FROM v""")
def scalar_inference(spark, sf_dir):
    n, e = F.col("event_id"), table(spark, sf_dir, "events")
    s = n.cast("string")
    t = F.when(n % 6 == 0, s).when(n % 6 == 1, F.col("event_type")).when(n % 6 == 2, "TRUE").when(n % 6 == 3, " ").when(n % 6 == 4, F.concat(s, F.lit(".5e1"))).otherwise(F.concat(s, F.lit("d")))
    x = datasets.infer_scalar(t)
    return e.select("event_id", x["kind"].alias("kind"), x["number"].alias("number"))


@query("SELECT array_to_string(json_keys(props), '|') AS keys, count(*) AS n FROM events GROUP BY 1")
def json_shape_events(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(joined(F.json_object_keys("props")).alias("keys")).agg(F.count(F.lit(1)).alias("n"))


@query(r"SELECT page_id, len(string_split(regexp_replace(html, '\n$', ''), chr(10))) AS line_count, length(html) AS text_chars FROM pages")
def html_text_profile(spark, sf_dir):
    x = datasets.text_profile(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", x["line_count"].cast("bigint").alias("line_count"), x["text_chars"].cast("bigint").alias("text_chars"))


@query("""WITH r AS (SELECT CASE WHEN source IN ('src1', 'src2') THEN 'dataset' ELSE 'paper' END AS category FROM documents) SELECT category, count(*) AS n, count(*) AS documents, count(*) FILTER (category = 'dataset') AS datasets FROM r GROUP BY 1""")
def extension_routing(spark, sf_dir):
    r = table(spark, sf_dir, "documents").select(F.when(F.col("source").isin("src1", "src2"), "dataset").otherwise("paper").alias("category"), F.lit(".TXT").alias("extension"))
    return inventory.route(r).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_document").alias("documents"), F.count_if("is_dataset").alias("datasets"))


@query(f"""WITH {FACTS} SELECT (SELECT count(*) FROM documents) AS files, (SELECT count(*) FROM canon1) AS sources, (SELECT count(*) FROM facts) AS facts,
 (SELECT count(*) FROM facts WHERE confidence = 'high') AS high, (SELECT count(*) FROM labels) AS dispositions, (SELECT count(*) FROM benchmark) AS master_records""")
def manifest_statistics(spark, sf_dir):
    f = document_facts(spark, sf_dir).agg(F.count(F.lit(1)).alias("facts"), F.count_if(F.col("confidence") == "high").alias("high"))
    files = document_rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("files"), F.count_distinct("sha256").alias("sources"))
    one = lambda t, n: table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias(n))
    out = files
    for x in (f, one("labels", "dispositions"), one("benchmark", "master_records")):
        out = out.withColumn("k", F.lit(1)).join(F.broadcast(x.withColumn("k", F.lit(1))), "k").drop("k")  # rows of one: bounded
    return out


RENDER = """CASE p_partkey % 5 WHEN 0 THEN 'Sample ' || p_brand || ' showed a polarization resistance of ' || p_size || '.5 ohm cm2 at ' || (400 + p_size * 10) || ' °C in air.'
 WHEN 1 THEN 'As reported by others, ' || p_brand || ' was fine.' WHEN 2 THEN 'The value lies between ' || p_size || ' - 90 for ' || p_brand || '.' WHEN 3 THEN 'A composite of ' || p_brand || ' was used.'
 ELSE 'Peak power density of ' || p_size || ' mW cm-2 and 7 mW cm-2 at 650 °C.' END"""


def _dealt(rows: DataFrame) -> DataFrame:
    """rows over all cores: a million short ones fit in one split of a file, but their patterns take minutes. Written, as filters would
    be pushed below a mere repartition, back into that one task."""
    return lineage.cut(rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism), "dealt")


def _sentences(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _dealt(p.select(F.col("p_partkey").cast("string").alias("source_id"), F.lit(1).alias("page"), F.expr(RENDER).alias("sentence"), F.concat(F.lit("LaSrO"), F.col("p_size") % 3).alias("formula"), "p_brand"))


#: A sentence for each reason to reject, and for each property that is measured.
VARIED = """CASE p_partkey % 16 WHEN 0 THEN 'Sample ' || p_brand || ' showed a polarization resistance of ' || p_size || '.5 ohm cm2 at ' || (400 + p_size * 10) || ' °C in air.'
 WHEN 1 THEN 'As reported by others, ' || p_brand || ' was fine.' WHEN 2 THEN 'The value lies between ' || p_size || ' - 90 for ' || p_brand || '.' WHEN 3 THEN 'A composite of ' || p_brand || ' was used.'
 WHEN 4 THEN 'Peak power density of ' || p_size || ' mW cm-2 at 650 °C.' WHEN 5 THEN 'Peak power density of ' || p_size || ' W cm-2 at 650 °C and 700 °C.' WHEN 6 THEN 'The value of [12] for ' || p_brand || '.'
 WHEN 7 THEN 'An enhancement of the electrical conductivity for ' || p_brand || '.' WHEN 8 THEN 'The value /C2 for ' || p_brand || '.' WHEN 9 THEN 'AB12 and CD34 for ' || p_brand || '.' WHEN 10 THEN 'A value of 5 3 1012 cm for ' || p_brand || '.'
 WHEN 11 THEN 'The electrical conductivity for YSZ was ' || p_size || ' S cm-1 at 700 °C.' WHEN 12 THEN 'The ASR was 3 ohm cm2 and 4 ohm cm2 at 700 °C.' WHEN 13 THEN 'Surface exchange coefficient of ' || p_size || 'e-5 cm s-1 at 700 °C.'
 WHEN 14 THEN 'The TEC was ' || p_size || ' 10-6 K-1 at 700 °C.' ELSE 'The diffusion coefficient of ' || p_brand || ' was ' || p_size || ' cm2 s-1 at 150 °C.' END"""


def _varied(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _dealt(p.select(F.col("p_partkey").cast("string").alias("source_id"), F.lit(1).alias("page"), F.expr(VARIED).alias("sentence"), F.lit("LaSrO3").alias("formula")))


@query("""SELECT CASE p_partkey % 16 WHEN 1 THEN 'secondary_or_cited_statement' WHEN 2 THEN 'range_approximate_or_inequality' WHEN 3 THEN 'composite_material_not_single_formula' WHEN 6 THEN 'ambiguous_or_cited_sentence'
 WHEN 7 THEN 'relative_change_not_absolute_measurement' WHEN 8 THEN 'unresolved_ocr_scientific_notation' WHEN 9 THEN 'multiple_material_abbreviations' WHEN 10 THEN 'suspicious_ocr_scientific_notation'
 WHEN 14 THEN 'range_approximate_or_inequality' ELSE 'kept' END AS reason, p_partkey::VARCHAR AS source_id FROM part""")
def promotion_reject_chain(spark, sf_dir):
    return _varied(spark, sf_dir).select(F.coalesce(promotion.reject_reason(F.col("sentence")), F.lit("kept")).alias("reason"), "source_id")


@query("""SELECT p_partkey::VARCHAR AS source_id, 'ASR' AS property, NULL AS reason, p_size + 0.5::DOUBLE AS value, 'Ω·cm²' AS unit, (400 + p_size * 10)::DOUBLE AS temperature_c FROM part WHERE p_partkey % 16 = 0
 UNION ALL SELECT p_partkey::VARCHAR, 'peak_power_density', NULL, p_size::DOUBLE, 'mW/cm²', 650 FROM part WHERE p_partkey % 16 = 4
 UNION ALL SELECT p_partkey::VARCHAR, 'peak_power_density', 'unpaired_value_temperature', NULL, NULL, NULL FROM part WHERE p_partkey % 16 = 5
 UNION ALL SELECT p_partkey::VARCHAR, 'electrical_conductivity', 'electrolyte_property_not_cathode', NULL, NULL, NULL FROM part WHERE p_partkey % 16 = 11
 UNION ALL SELECT p_partkey::VARCHAR, 'ASR', 'multiple_unpaired_property_values', NULL, NULL, NULL FROM part WHERE p_partkey % 16 = 12
 UNION ALL SELECT p_partkey::VARCHAR, 'oxygen_surface_exchange_coefficient', NULL, (p_size || 'e-5')::DOUBLE, 'cm/s', 700 FROM part WHERE p_partkey % 16 = 13""")
def promotion_pairing(spark, sf_dir):
    kept = _varied(spark, sf_dir).filter(promotion.reject_reason(F.col("sentence")).isNull())
    return promotion.pair_measurements(kept).select("source_id", "property", "reason", "value", "unit", "temperature_c")


@query("""WITH m AS (SELECT DISTINCT p_partkey::VARCHAR AS source_id, 'lasro' || p_size % 3 AS formula_key, p_size + 0.5::DOUBLE AS value, (400 + p_size * 10)::DOUBLE AS temperature_c, p_brand FROM part WHERE p_partkey % 5 = 0),
 old AS (SELECT DISTINCT formula_key, value, temperature_c FROM m WHERE p_brand = (SELECT min(p_brand) FROM part))
 SELECT source_id, formula_key, value, temperature_c FROM m WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.formula_key = m.formula_key AND old.value = m.value AND old.temperature_c = m.temperature_c)""".replace("'lasro' || p_size % 3", "CASE p_size % 3 WHEN 0 THEN 'lasro0' WHEN 1 THEN 'lasro1' ELSE 'lasro2' END"))
def promotion_new_vs_existing(spark, sf_dir):
    kept = _sentences(spark, sf_dir).filter(promotion.reject_reason(F.col("sentence")).isNull())
    paired = lineage.cut(promotion.pair_measurements(kept).filter("property = 'ASR'"), "paired")  # read twice
    least = table(spark, sf_dir, "part").agg(F.min("p_brand").alias("p_brand"))
    old = table(spark, sf_dir, "part").join(F.broadcast(least), "p_brand", "left_semi").select(F.col("p_partkey").cast("string").alias("source_id"))
    known = paired.join(old, "source_id", "left_semi").withColumn("formula_key", X.formula_key(F.col("formula")))
    return promotion.new_measurements(paired, known).select("source_id", "formula_key", "value", "temperature_c")


@query("""SELECT conv_id, turn, coalesce(max((role = 'system')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 0) AS in_references FROM conversations""")
def references_running_flag(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    pages = c.select(F.col("conv_id").alias("source_id"), F.col("turn").alias("page"), F.when(F.col("role") == "system", F.concat(F.lit("References\n"), "text")).otherwise(F.col("text")).alias("text"))
    return promotion.references_flag(pages).select(F.col("source_id").alias("conv_id"), F.col("page").alias("turn"), F.col("in_references").cast("int").alias("in_references"))


TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


@query(rf"""WITH f AS (SELECT page_id, url, sha256(html) AS hash, regexp_replace(lower({TITLE}), '[^0-9a-z\x{{4e00}}-\x{{9fff}}]+', '', 'g') AS k FROM pages),
 a AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY len(string_split(url, '/')), length(url), lower(url), url, page_id) AS rn FROM f),
 b AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN k = '' THEN 'hash:' || hash ELSE k END ORDER BY len(string_split(url, '/')), length(url), lower(url), url, page_id) AS kn FROM a WHERE rn = 1)
 SELECT CASE WHEN kn = 1 THEN 'canonical' ELSE 'bibliographic_duplicate' END AS status, count(*) AS n FROM b GROUP BY 1 UNION ALL SELECT 'exact_duplicate', count(*) FROM a WHERE rn > 1 HAVING count(*) > 0""")
def bibliographic_dedup(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    files = p.select(F.col("url").alias("path"), F.lit(0).alias("penalty"), F.sha2("html", 256).alias("hash"), literature.bibliographic_key(F.lit("paper"), F.lit(None).cast("string"), title, F.lit(None).cast("int")).alias("key"))
    return literature.canonical_files(files).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH t AS (SELECT lower('paper/' || p_brand || ' - 2020 - ' || p_type || '.pdf') AS target_key FROM part) SELECT target_key, count(*) AS n FROM t GROUP BY 1 HAVING count(*) > 1""")
def filename_collisions(spark, sf_dir):
    plan = table(spark, sf_dir, "part").select(literature.target_name(F.lit("paper"), F.col("p_brand"), F.lit("2020"), F.col("p_type"), F.lit(".pdf")).alias("target"))
    return literature.collisions(plan)


@query("SELECT 'R' || lpad((max(item_id) + 1)::VARCHAR, greatest(3, length((max(item_id) + 1)::VARCHAR))::INTEGER, '0') AS next_id FROM benchmark")
def registry_next_id(spark, sf_dir):
    return literature.next_id(table(spark, sf_dir, "benchmark").select(F.concat(F.lit("R"), F.lpad(F.col("item_id").cast("string"), 3, "0")).alias("id")), "id")


@query(f"WITH {FACTS}, x AS (SELECT unnest(fs) AS formula FROM facts), c AS (SELECT formula, count(*) AS n FROM x GROUP BY 1) SELECT formula, n FROM c ORDER BY n DESC LIMIT 200")
def topk_formulas(spark, sf_dir):
    return facts.top_formulas(document_facts(spark, sf_dir).withColumn("all", F.lit(1)), "all").select("formula", "n")


@query("""WITH f AS (SELECT s_nationkey AS family, 'h' || s_suppkey AS hash, row_number() OVER (PARTITION BY s_nationkey ORDER BY lower(s_name), 'h' || s_suppkey) AS r FROM supplier)
 SELECT family, hash, CASE WHEN family % 2 = 0 AND r >= 2 THEN r + 1 ELSE r END AS number FROM f""")
def attachment_numbers(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    new = s.select(F.col("s_nationkey").alias("family"), F.concat(F.lit("h"), "s_suppkey").alias("hash"), F.lit(".pdf").alias("extension"), F.col("s_name").alias("source"))
    taken = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("family"), F.lit(2).alias("number"))
    return literature.number_attachments(new, taken).select("family", "hash", F.col("number").cast("bigint").alias("number"))


@query("SELECT p_partkey, (400 + p_size * 10) || ' °C' AS temperature FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT p_partkey, '650 °C' FROM part WHERE p_partkey % 5 = 4")
def temperature_extract(spark, sf_dir):
    s = _sentences(spark, sf_dir)
    return s.select(F.col("source_id").cast("bigint").alias("p_partkey"), F.explode(X.find_all(F.col("sentence"), X.TEMPERATURE, True)).alias("temperature"))


TABLE_PROFILE = from_dict({"schema_version": 1, "canonical_roots": {"paper": "p"}, "keyword_groups": {"size": "sizes"}, "formula_pattern": "Brand#[0-9]+", "value_unit_pattern": "[0-9]+ mm"})


@query("""WITH l AS (SELECT p_brand, p_partkey, 'Brand#' || p_partkey || ' has a row with length ' || p_size || ' mm' AS line FROM part)
 SELECT p_brand AS source_id, line AS evidence_text, 'fact_' || left(sha256(p_brand || '|1|' || line), 20) AS fact_id FROM l WHERE length(line) >= 35""")
def table_page_rows(spark, sf_dir):
    line = F.concat(F.lit("Brand#"), "p_partkey", F.lit(" has a row with length "), "p_size", F.lit(" mm"))
    lines = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("l")))).alias("ls"))
    pages = lines.select(F.col("p_brand").alias("source_id"), F.lit(1).alias("page"), F.concat(F.lit("Table 1\n"), F.array_join(F.transform("ls", lambda x: x["l"]), "\n")).alias("text"))
    return facts.fact_candidates(pages, TABLE_PROFILE).select("source_id", "evidence_text", "fact_id")


CONV_FACTS = f"""cut AS (SELECT 'conv_' || conv_id AS source_id, turn + 1 AS page, {CUT} AS raw FROM conversations),
 sent AS (SELECT DISTINCT source_id, page, {SQUEEZE.format('raw')} AS s FROM cut), hit AS (SELECT *, {HITS} FROM sent WHERE length(s) BETWEEN 35 AND 1600),
 facts AS (SELECT * FROM hit WHERE t1 OR t2 OR (len(vs) > 0 AND len(fs) > 0))"""


@query(f"""WITH {CONV_FACTS}, n AS (SELECT source_id, count(*) AS fact_count, count(*) FILTER (t1) AS license, count(*) FILTER (t2) AS function_words FROM facts GROUP BY 1),
 d AS (SELECT 'conv_' || conv_id AS source_id, count(*) AS page_count, sum(length(text)) + count(*) - 1 AS text_chars FROM conversations GROUP BY 1)
 SELECT source_id, page_count, text_chars::BIGINT AS text_chars, CASE WHEN text_chars >= greatest(200, 20 * page_count) THEN 'text_extracted' ELSE 'ocr_or_manual_review_required' END AS coverage,
 coalesce(fact_count, 0) AS fact_count, coalesce(license, 0) AS license, coalesce(function_words, 0) AS function_words, 'machine_distilled_with_page_provenance' AS status FROM d LEFT JOIN n USING (source_id)""")
def document_records(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    pages = c.select(F.concat(F.lit("conv_"), "conv_id").alias("source_id"), (F.col("turn") + 1).alias("page"), "text", F.lit("embedded").alias("text_source"))
    sources = pages.select("source_id").distinct().select("source_id", F.lit("paper").alias("category"), F.concat("source_id", F.lit(".pdf")).alias("path"), F.array().cast("array<string>").alias("alias_paths"), F.lit("").alias("sha256"), F.lit(0).alias("size_bytes"), F.lit(".pdf").alias("extension"))
    r = documents.document_records(sources, pages, facts.fact_candidates(pages, PROFILE))
    n = lambda t: F.coalesce(F.get(F.filter("distilled_index.themes", lambda x: x["theme"] == t), F.lit(0))["n"], F.lit(0)).alias(t)
    e = F.col("extraction")
    return r.select("source_id", e["page_count"].alias("page_count"), e["text_chars"].cast("bigint").alias("text_chars"), e["text_coverage_status"].alias("coverage"), F.col("distilled_index.fact_count").alias("fact_count"), n("license"), n("function_words"), F.col("distillation_status").alias("status"))


@query("""SELECT 'conv_' || conv_id AS source_id, sum(length(text)) + count(*) - 1 AS text_chars FROM conversations GROUP BY conv_id HAVING sum(length(text)) + count(*) - 1 < greatest(200, 20 * count(*))""")
def ocr_targets(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    pages = c.select(F.concat(F.lit("conv_"), "conv_id").alias("source_id"), (F.col("turn") + 1).alias("page"), "text", F.lit("embedded").alias("text_source"))
    sources = pages.select("source_id").distinct().select("source_id", F.lit("paper").alias("category"), F.concat("source_id", F.lit(".pdf")).alias("path"), F.array().cast("array<string>").alias("alias_paths"), F.lit("").alias("sha256"), F.lit(0).alias("size_bytes"), F.lit(".pdf").alias("extension"))
    none = facts.fact_candidates(pages.limit(0), PROFILE)
    return documents.ocr_targets(documents.document_records(sources, pages, none)).select("source_id", F.col("extraction.text_chars").cast("bigint").alias("text_chars"))


def _part_cells(spark, sf_dir) -> DataFrame:
    """A table of text cells for each brand; every seventh row lacks its last cell."""
    p = table(spark, sf_dir, "part").filter("p_partkey > 0")  # row 0 is the header
    rows = p.select(F.col("p_brand").alias("source_id"), F.lit(0).alias("table_ord"), F.lit("csv").alias("table"), F.col("p_partkey").alias("row_no"), F.array(F.col("p_partkey").cast("string"), F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).otherwise(""), F.when(F.col("p_size") % 2 == 0, "TRUE").otherwise("text"), F.lit("x")).alias("cells"))
    rows = rows.withColumn("cells", F.when(F.col("row_no") % 7 == 0, F.slice("cells", 1, 3)).otherwise(F.col("cells")))
    heads = p.select("p_brand").distinct().select(F.col("p_brand").alias("source_id"), F.lit(0).alias("table_ord"), F.lit("csv").alias("table"), F.lit(0).cast("bigint").alias("row_no"), F.array(*map(F.lit, ("key", "size", "kind", "last"))).alias("cells"))
    return heads.unionByName(rows)


@query("SELECT p_brand AS source_id, count(*) AS row_count, 4 AS column_count, count(*) FILTER (p_partkey % 7 = 0) AS malformed_row_count FROM part WHERE p_partkey > 0 GROUP BY 1")
def dataset_tables(spark, sf_dir):
    return datasets.table_shapes(_part_cells(spark, sf_dir)).select("source_id", "row_count", "column_count", "malformed_row_count")


@query("""WITH p AS (SELECT * FROM part WHERE p_partkey > 0)
 SELECT p_brand AS source_id, 'key' AS name, count(*) AS nonempty_count, 0::BIGINT AS missing_count, count(DISTINCT p_partkey) AS distinct_count, count(*) AS numeric_count, min(p_partkey)::DOUBLE AS min, max(p_partkey)::DOUBLE AS max, array_to_string(list_sort(list(p_partkey))[1:8], '|') AS samples FROM p GROUP BY 1
 UNION ALL SELECT p_brand, 'size', count(*) FILTER (p_size > 10), count(*) FILTER (p_size <= 10), count(DISTINCT p_size) FILTER (p_size > 10), count(*) FILTER (p_size > 10), min(p_size) FILTER (p_size > 10)::DOUBLE, max(p_size) FILTER (p_size > 10)::DOUBLE, coalesce(array_to_string((list(p_size ORDER BY p_partkey) FILTER (p_size > 10))[1:8], '|'), '') FROM p GROUP BY 1
 UNION ALL SELECT p_brand, 'kind', count(*), 0, count(DISTINCT p_size % 2), count(*) FILTER (p_size % 2 = 0), CASE WHEN bool_or(p_size % 2 = 0) THEN 1 END, CASE WHEN bool_or(p_size % 2 = 0) THEN 1 END, array_to_string(list(CASE WHEN p_size % 2 = 0 THEN 'TRUE' ELSE 'text' END ORDER BY p_partkey)[1:8], '|') FROM p GROUP BY 1
 UNION ALL SELECT p_brand, 'last', count(*) FILTER (p_partkey % 7 <> 0), count(*) FILTER (p_partkey % 7 = 0), CASE WHEN bool_or(p_partkey % 7 <> 0) THEN 1 ELSE 0 END, 0, NULL, NULL, array_to_string(list_transform(range(0, least(8, count(*) FILTER (p_partkey % 7 <> 0))), lambda x: 'x'), '|') FROM p GROUP BY 1""")
def dataset_columns(spark, sf_dir):
    c = datasets.table_columns(_part_cells(spark, sf_dir))
    return c.select("source_id", "name", "nonempty_count", "missing_count", "distinct_count", "numeric_count", "min", "max", joined("sample_values").alias("samples"))


#: Names by which parts are listed: by whole path, by name, below the root, with backslashes.
LISTED = """CASE p_partkey % 5 WHEN 0 THEN '/corpus/paper/part ' || p_partkey || '.pdf' WHEN 1 THEN 'part ' || p_partkey || '.pdf' WHEN 2 THEN 'paper/part ' || p_partkey || '.pdf' ELSE 'paper/other ' || p_partkey || '.pdf' END"""


@query(f"""WITH o AS (SELECT {LISTED} AS name, p_brand AS venue, p_size AS year FROM part UNION ALL SELECT 'part ' || p_partkey || '.pdf', 'by name', 1 FROM part WHERE p_partkey % 5 = 2)
 SELECT p_partkey, CASE WHEN p_partkey % 5 = 2 THEN 'by name' WHEN p_partkey % 5 < 2 THEN p_brand END AS venue, CASE WHEN p_partkey % 5 = 2 THEN 1 WHEN p_partkey % 5 < 2 THEN p_size END AS year FROM part""")
def override_priority(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    files = p.select("p_partkey", F.expr("concat('/corpus/paper/part ', p_partkey, '.pdf')").alias("path"))
    listed = p.select(F.expr(LISTED).alias("name"), F.col("p_brand").alias("venue"), F.col("p_size").alias("year"))
    listed = listed.unionByName(p.filter("p_partkey % 5 = 2").select(F.expr("concat('part ', p_partkey, '.pdf')").alias("name"), F.lit("by name").alias("venue"), F.lit(1).alias("year")))
    return literature.with_overrides(files, listed, ["/corpus"]).select("p_partkey", F.col("venue_o").alias("venue"), F.col("year_o").alias("year"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'unresolved' ELSE 'ready' END AS status, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'https://doi.org/10.1/x' || s_suppkey ELSE 'paper/N' || s_nationkey || '.pdf' END AS related_paper,
 CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'own' ELSE n_name END AS venue, CASE WHEN s_suppkey % 7 > 0 AND s_suppkey % 3 > 0
 AND (n_regionkey = 1 OR count(*) OVER (PARTITION BY s_nationkey, s_suppkey % 7 = 0, s_suppkey % 3 = 0) > 1)
 THEN row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 7 = 0, s_suppkey % 3 = 0 ORDER BY lower(s_name)) + (n_regionkey = 1)::INT END AS attachment_number FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def supplement_families(spark, sf_dir):
    """Attachments with the DOI of one paper, of none, and of nothing known; papers of region 1 have attachment 1 in the ledger; an
    attachment that is alone gets no number."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    none = F.lit(None).cast("string")
    alone, lost = F.col("s_suppkey") % 3 == 0, F.col("s_suppkey") % 7 == 0
    sup = s.select(
        "s_suppkey", "s_nationkey", F.col("s_name").alias("source"), F.concat(F.lit("h"), "s_suppkey").alias("hash"), F.lit(".pdf").alias("extension"),
        F.when(lost, none).when(alone, F.concat(F.lit("10.1/x"), "s_suppkey")).otherwise(F.concat(F.lit("10.1/n"), "s_nationkey")).alias("doi"), F.when(alone & ~lost, "own").alias("venue"),
        F.when(alone & ~lost, F.lit(2020)).alias("year"), F.when(alone & ~lost, F.col("s_name")).alias("title"), none.alias("related_paper"), F.lit(None).cast("int").alias("attachment_number"),
    )
    mains = n.select(F.concat(F.lit("10.1/n"), "n_nationkey").alias("doi"), F.col("n_name").alias("venue"), F.lit(2020).alias("year"), F.col("n_name").alias("title"), F.concat(F.lit("paper/N"), "n_nationkey", F.lit(".pdf")).alias("target"))
    listed = literature.target_name(F.lit("paper"), F.concat(F.lit("SI - "), "n_name"), F.lit("2020"), F.col("n_name"), F.lit(".pdf"))  # without its title the year would be the number
    ledger = n.filter("n_regionkey = 1").select(listed.alias("path"), F.col("n_name").alias("title"), F.lit("2020").alias("year"), F.col("n_name").alias("venue"), F.lit("old").alias("hash"))
    out = literature.resolve_supplements(sup, mains, ledger)
    return out.select("s_suppkey", "status", "related_paper", "venue", F.col("attachment_number").cast("bigint").alias("attachment_number"))


def _promoted(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    new = promotion.new_measurements(promotion.pair_measurements(_varied(spark, sf_dir).filter(promotion.reject_reason(F.col("sentence")).isNull())), spark.createDataFrame([], "formula_key string, property string, value double, unit string, temperature_c double"))
    return promotion.records(new, p.select(F.col("p_partkey").cast("string").alias("source_id"), F.col("p_name").alias("title"), F.lit(None).cast("string").alias("doi"), F.col("p_name").alias("path")), "2020-01-01")


@query("""WITH p AS (SELECT * FROM part WHERE p_partkey % 16 IN (0, 4, 13)) SELECT p_partkey::VARCHAR AS source_id, 'LaSrO3' AS formula, 1::BIGINT AS n, CASE p_partkey % 16 WHEN 0 THEN 'ASR' WHEN 4 THEN 'peak_power_density' ELSE 'oxygen_surface_exchange_coefficient' END AS property,
 CASE WHEN p_partkey % 16 = 0 THEN 'air' END AS atmosphere, CASE WHEN p_partkey % 16 = 4 OR (p_partkey % 16 = 0 AND p_size = 25) THEN 'high' ELSE 'normal' END AS priority, p_name AS title FROM p""")
def promotion_records(spark, sf_dir):
    made = _promoted(spark, sf_dir)
    rank = promotion.review_queue(made).select("evidence_id", "priority")
    m = made.select("source_id", "formula", F.size("measurements").cast("bigint").alias("n"), F.col("external_source.title").alias("title"), F.explode("measurements").alias("m"))
    return m.select("source_id", "formula", "n", "m.property", F.col("m.test_context.atmosphere").alias("atmosphere"), "title", F.col("m.evidence_id").alias("evidence_id")).join(rank, "evidence_id").drop("evidence_id")


@query("""SELECT n AS records, n AS measurements, n AS directly_reported, 0 AS electrolyte, 0 AS test_method, 0 AS synthesis_method, n AS page, 0 AS figure, 0 AS "table", 0 AS sheet_row, n AS exact_original_sentence FROM (SELECT count(*) AS n FROM part WHERE p_partkey % 16 IN (0, 4, 13))""")
def promotion_coverage(spark, sf_dir):
    return promotion.coverage_counts(_promoted(spark, sf_dir))


@query("SELECT id AS source_id FROM (SELECT doc_id::VARCHAR AS id FROM documents UNION SELECT doc_id::VARCHAR FROM labels UNION SELECT page_id::VARCHAR FROM pages)")
def recorded_sources(spark, sf_dir):
    ids = [table(spark, sf_dir, t).select(F.col(c).cast("string").alias("source_id")) for t, c in (("documents", "doc_id"), ("labels", "doc_id"), ("pages", "page_id"))]
    return corpus.recorded_sources(*ids)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE 'changed' END AS change FROM orders WHERE NOT (o_orderkey % 11 = 0 AND o_orderkey % 7 = 0) AND (o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 5 = 0)""")
def stale_bindings(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    old = o.filter("o_orderkey % 11 <> 0")
    new = o.filter("o_orderkey % 7 <> 0").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, "other").otherwise(F.col("o_orderpriority")))
    return binding.stale(old, new, "o_orderkey")


@query("""SELECT p_partkey::VARCHAR AS name FROM part WHERE p_partkey % 4 = 0 UNION ALL SELECT p_partkey::VARCHAR FROM part WHERE p_partkey % 4 = 1 AND p_partkey % 3 = 0""")
def organiser_scan(spark, sf_dir):
    """PDFs, attachments by name, other files, and files that are organised already."""
    path = "CASE p_partkey % 4 WHEN 0 THEN 'in/' || p_partkey || '.PDF' WHEN 1 THEN 'in/' || CASE WHEN p_partkey % 3 = 0 THEN 'SI_' ELSE 'basis_' END || p_partkey || '.xlsx' WHEN 2 THEN 'in/' || p_partkey || '.html' ELSE 'out/' || p_partkey || '.pdf' END"
    found = literature.scan(table(spark, sf_dir, "part").select(F.expr(path).alias("path")), "out")
    return found.select(F.regexp_extract("path", r"(\d+)\.", 1).alias("name"))


@query("""WITH u AS (SELECT html, min(url) AS url FROM pages GROUP BY html) SELECT (SELECT count(*) FROM pages) AS scanned, (SELECT count(*) FROM pages) AS ready_before_dedup, (SELECT count(*) FROM u) AS planned_unique, (SELECT count(*) FROM u) AS planned_paper, 0 AS planned_patent, 0 AS planned_thesis,
 0 AS unresolved_count, 0 AS excluded_count, (SELECT count(*) FROM (SELECT html FROM pages GROUP BY html HAVING count(*) > 1)) AS exact_duplicate_groups, 0 AS bibliographic_duplicates, 6 + max(length(sha256(html))) AS longest_target_path_chars, 0 AS filename_collisions FROM pages""")
def organiser_summary(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.sha2("html", 256).alias("hash"), F.lit(0).alias("penalty"), F.lit(None).cast("string").alias("key"), F.lit("paper").alias("category"))
    plan = literature.canonical_files(p)
    return literature.plan_summary(plan.withColumn("target", F.when(F.col("status") == "canonical", F.concat(F.lit("paper/"), "hash"))))
