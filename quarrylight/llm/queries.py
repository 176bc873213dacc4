"""The registered queries of this subpackage: thin forms of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff_lm, cover_tree, golay_simhash, mixing, mpeg_audio, ordinal_quality, rendezvous, suffix_dedup, token_output, vector_packing
from .common import documents


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_audio.store_texts(documents(spark, sf_dir), "doc_id", "text")


#: Grades from the labels: 0 toxic, 1 of low quality, 2 good. Kept: documents with P(grade >= 2) of LEAST or more.
GRADE, GRADES, LEAST = "CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 2 END", 3, 0.65


def quality_model(docs: DataFrame, sf_dir: str) -> ordinal_quality.Model:
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal_quality.train(docs, labels, "doc_id", "text", F.expr(GRADE), GRADES)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ordinal_quality.grade_documents(docs, "doc_id", "text", quality_model(docs, sf_dir)).withColumn("keep", F.col("tail_2") >= LEAST)


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", "vec_id % 50 = 0")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack_documents(documents(spark, sf_dir), "doc_id", "text")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir), "doc_id", "text")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    docs = docs.withColumn("grown_shard", rendezvous.rendezvous(F.col("doc_id"), dict.fromkeys(range(17), 1.0)))
    out = rendezvous.assign_shards(docs, "doc_id", dict.fromkeys(range(16), 1.0), order=["text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = golay_simhash.near_groups(documents(spark, sf_dir), "doc_id", "text")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Weights of the mix by language, near the square roots of their usual shares.
TARGETS = {"en": 0.40, "de": 0.20, "fr": 0.20, "es": 0.20}


def language_labels(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains of the labelled table's good documents: their language."""
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0").select("doc_id").distinct()
    return docs.select("doc_id", "lang").join(labels, "doc_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = mixing.mix(docs, "doc_id", "text", language_labels(docs, sf_dir), TARGETS, low=0.0)
    return out.select("doc_id", "tokens", *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(TARGETS)), "rate", "copies")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score_documents(documents(spark, sf_dir), "doc_id", "text")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.write_matrices(documents(spark, sf_dir), "doc_id", "text")


QUERIES = {f.__name__: f for f in (op1_media_columns, op2_quality, op3_cover_tree, op4_packing, op5_suffix_dedup, op6_sharding, op7_simhash, op8_mixing, op9_lm_scoring, op10_token_output)}
ORACLES: dict[str, str] = {
    "op3_cover_tree": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2]))::BIGINT AS score FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
 r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
 SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_suffix_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
 c AS (SELECT doc_id, unnest(range(0, greatest(len(h) // 2 - 99, 0), 512)) AS o, h FROM d),
 b AS (SELECT doc_id, o, substr(h, 2 * o + 1, 1222) AS h FROM c),
 w AS (SELECT doc_id, o, unnest(range(0, least(512, len(h) // 2 - 99))) AS p, h FROM b),
 k AS (SELECT doc_id, o + p AS p, md5_number(substr(h, 2 * p + 1, 200)) AS m FROM w),
 f AS (SELECT m, min(struct_pack(d := doc_id, p := p)) AS first FROM k GROUP BY m HAVING count(*) > 1),
 later AS (SELECT doc_id, p FROM k JOIN f USING (m) WHERE struct_pack(d := doc_id, p := p) <> first),
 i AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM later),
 g AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM i),
 s AS (SELECT doc_id, g, min(p) AS s, max(p) + 100 AS e FROM g GROUP BY doc_id, g),
 l AS (SELECT doc_id, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es, count(*) AS n, sum(e - s) AS gone FROM s GROUP BY doc_id)
 SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
 sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(ss) + 1), lambda x: substr(h, 2 * (CASE WHEN x = 0 THEN 0 ELSE es[x] END) + 1, 2 * (coalesce(ss[x + 1], len(h) // 2) - CASE WHEN x = 0 THEN 0 ELSE es[x] END))), '') END)) AS kept_sha256
 FROM d LEFT JOIN l USING (doc_id)""",
}
