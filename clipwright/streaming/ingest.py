"""Arriving clip files as a stream: transcripts normalised, each batch added to a table with its drop accounting.

This goes beyond the batch phases; it uses the same expressions. Progress is kept in the stream's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipwright.functions.text import with_normalized_transcript
from clipwright.operators.cleanup import is_short


def clip_stream(spark: SparkSession, folder: str, schema: str, *, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def with_drop_reason(df: DataFrame) -> DataFrame:
    reason = F.when(F.col("transcription").isNull() | (F.col("transcription") == ""), "empty_text").when(is_short(F.col("duration")), "short")
    return df.withColumn("drop_reason", reason)


def hourly_counts(df: DataFrame, time: str, *, late: str = "2 hours", window: str = "1 hour") -> DataFrame:
    """Clips by window of arrival; later rows than ``late`` are left out."""
    return df.withWatermark(time, late).groupBy(F.window(time, window)).agg(F.count(F.lit(1)).alias("clips")).select(F.col("window.start").alias("start"), "clips")


def ingest_stream(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Starts the stream; each batch writes its own folder, so a batch that runs again replaces itself. Ends when all files there are have been read."""

    def write(batch: DataFrame, number: int) -> None:
        with_drop_reason(with_normalized_transcript(batch)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
