"""Ingest of a landing directory as a stream: each text once, whatever arrives again, with a resumable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T


def landing(spark: SparkSession, path: str, schema: str = "doc_id long, source string, text string, arrived timestamp") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(path)


def distinct_texts(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Texts whose hash did not arrive within the delay before; the state is bounded by the watermark."""
    hashed = stream.withColumn("sha256", F.sha2("text", 256)).withWatermark("arrived", delay)
    return hashed.dropDuplicatesWithinWatermark(["sha256"])


def canonical(stream: DataFrame) -> DataFrame:
    return stream.withColumn("canonical", T.canonical(T.normalize(T.clean(F.col("text")))))


def word_counts(stream: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Frequencies by source and window of arrival, as texts come in."""
    words = stream.withWatermark("arrived", delay).select("arrived", "source", F.explode(T.lexical_tokens(F.col("text"))).alias("word"))
    return words.groupBy(F.window("arrived", window), "source", "word").agg(F.count(F.lit(1)).alias("frequency"))


def write(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
