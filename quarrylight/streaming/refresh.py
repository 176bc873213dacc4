"""Streaming front-end: pages that arrive as files are screened once each; facts append to a table by anti-join on their ids.

A micro-batch runs the same transforms as a batch run. The sink is idempotent: a batch that is run again finds its facts there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarrylight.operators.facts import fact_candidates
from quarrylight.plans.profile import Profile

PAGES = "source_id string, page int, text string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def screen_new_pages(spark: SparkSession, profile: Profile, source: str, facts: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Reads Parquet pages that aren't read yet, in batches of bounded size, and stops when there are no more."""

    def batch(df: DataFrame, _: int) -> None:
        new = fact_candidates(df, profile)
        if _exists(spark, facts):
            new = new.join(spark.read.parquet(facts).select("fact_id"), "fact_id", "left_anti")
        new.dropDuplicates(["fact_id"]).write.mode("append").parquet(facts)

    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
