"""Corpus pipeline: quality filter, near-dedup, exact substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. run() writes each
stage's result as Parquet in the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.llm import golay_simhash, mixing, ordinal_quality, queries, suffix_dedup, vector_packing
from quarrylight.llm.common import cut, documents

#: Candidates for near copies: fingerprints over word pairs that differ in at most so many bits. The five-word similarity of candidates is
#: then counted exactly, so that this decides only what is found, not what counts as a near copy.
SHINGLE, DISTANCE = 2, 7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, unchanged."""
    return ordinal_quality.select_documents(docs, "text", queries.quality_model(docs, sf_dir), 2, queries.LEAST)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity of five words in a row of 0.8 or more) one document, that with the smallest id; one
    without an id stays only if its group has no id at all. Documents that share an id or have none count by their texts."""
    return golay_simhash.keep_one(docs, "doc_id", "text", SHINGLE, DISTANCE)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes that stand earlier; a character of which a part goes goes whole. Nothing else changes:
    texts without such passages stay as they are, null ones too, and documents of which nothing is left stay with an empty text."""
    other = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    own = docs.select("doc_id", "text", *(F.col(c).alias(a) for c, a in other.items()))
    out = suffix_dedup.remove_repeats(own, "doc_id", "text", carry=list(other.values()), characters=True)
    text = F.col("kept").cast("string")
    n = F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col(other["n_chars"]))
    new = {"doc_id": F.col("doc_id"), "text": text, **{c: F.col(a) for c, a in other.items()}, "n_chars": n}
    return out.select(*(new[c].alias(c) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, at least once: the mix gains by repeating what is short, no document is lost."""
    rates = mixing.mix(docs, "doc_id", "text", queries.language_labels(docs, sf_dir), queries.TARGETS, low=1.0)
    rates = rates.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("copies").alias("__copies"))
    out = docs.join(rates, docs["doc_id"].eqNullSafe(rates["__id"]) & (mixing.text_hash(docs["text"]) == rates["__hash"]))
    return out.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return vector_packing.pack_documents(docs, "doc_id", "text")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("repeats", repeats), ("mix", mix), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
