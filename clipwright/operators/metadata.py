"""Gender and language forms, speaker indexes and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipwright.functions.text import capitalize, strip
from clipwright.operators.skew import heavy_keys, salted_aggregate, salted_join


def normalize_metadata(df: DataFrame, gender: str = "gender", language: str = "language") -> DataFrame:
    """Gender stripped and capitalised, language stripped and in lower case; nulls stay."""
    return df.withColumn(gender, capitalize(strip(F.col(gender)))).withColumn(language, F.lower(strip(F.col(language))))


def speaker_index(df: DataFrame, speaker: str = "source_speaker_id") -> DataFrame:
    """(speaker, clips, speaker_idx): index 0 for the speaker with most rows, ties by id. Null speakers get none.

    Numbers are given over the table of speakers in sorted ranges: each range counts its rows, and starts after those before it.
    """
    counts = salted_aggregate(df.filter(F.col(speaker).isNotNull()), speaker, {"clips": ("rows", None)}, heavy=[])
    return dense_numbers(counts, [F.desc("clips"), F.asc(speaker)], "speaker_idx")


def dense_numbers(df: DataFrame, order: list, name: str) -> DataFrame:
    """0-based position of each row in the whole table, by a range sort and the sizes of the ranges; order must be unique."""
    from clipwright.storage import Scratch

    scratch = Scratch(df.sparkSession, "numbers")
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    kept = scratch.keep(parts)
    sizes = {r["_part"]: r["n"] for r in kept.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each partition
    starts, at = [], 0
    for p in sorted(sizes):
        starts.append((p, at))
        at += sizes[p]
    table = df.sparkSession.createDataFrame(starts, "_part int, _start long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return kept.join(F.broadcast(table), "_part").withColumn(name, (F.col("_start") + place - 1).cast("int")).drop("_part", "_start")


def add_speaker_index(df: DataFrame, speaker: str = "source_speaker_id") -> DataFrame:
    """Each row with its speaker's index; null for null speakers."""
    index = speaker_index(df, speaker).select(speaker, "speaker_idx")
    return salted_join(df.drop("speaker_idx"), index, speaker, heavy=heavy_keys(df, speaker), how="left")


def add_clip_count(df: DataFrame, speaker: str = "source_speaker_id", into: str = "speaker_clip_count") -> DataFrame:
    """Each row with the number of rows of its speaker. Counts are combined before the shuffle and joined back under salts, so no task gets all rows of a speaker."""
    counts = df.filter(F.col(speaker).isNotNull()).groupBy(speaker).agg(F.count(F.lit(1)).alias(into))
    return salted_join(df.drop(into), counts, speaker, heavy=heavy_keys(df, speaker), how="left")


def value_counts(df: DataFrame, column: str, *, nulls: bool = False) -> DataFrame:
    """(value, n), most frequent first, ties by value."""
    rows = df if nulls else df.filter(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("value"))


def before_after_counts(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Value counts of two versions of a column under one roof."""
    a = value_counts(before, column).select(F.lit("before").alias("version"), "value", "n")
    return a.unionByName(value_counts(after, column).select(F.lit("after").alias("version"), "value", "n"))


def union_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """train, validation, test, then any others, in one table with ``split``. None given: an error. One given: just that, labelled."""
    if not splits:
        raise ValueError("no splits")
    first = [s for s in ("train", "validation", "test") if s in splits]
    out = None
    for name in [*first, *(s for s in splits if s not in first)]:
        part = splits[name].withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
