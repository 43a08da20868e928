"""Per-speaker results where a few speakers hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipwright.operators.speakers import speaker_counts
from clipwright.plans.tables import table


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The right clip count of each speaker."""
    return speaker_counts(table(spark, sf_dir, "clips_annotated"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers with a stored clip count that is wrong."""
    return p3_counts(spark, sf_dir).filter("stale").select("source_speaker_id")


QUERIES = {f.__name__: f for f in (p3_found, p3_counts)}

_COUNTS = """
SELECT source_speaker_id, count(*) AS rows, count(DISTINCT source_id) AS clips, min(speaker_clip_count) AS stored_min, max(speaker_clip_count) AS stored_max,
    coalesce(min(speaker_clip_count) <> count(DISTINCT source_id) OR max(speaker_clip_count) <> count(DISTINCT source_id), false) AS stale
FROM clips_annotated WHERE source_speaker_id IS NOT NULL GROUP BY 1
"""
SQL = {"p3_counts": _COUNTS, "p3_found": f"SELECT source_speaker_id FROM ({_COUNTS}) WHERE stale"}
