"""Per-speaker counts of repeated deliveries, for speakers of very different size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import SALTS, SHARE, salted_aggregate


def speaker_counts(df: DataFrame, *, speaker: str = "source_speaker_id", clip: str = "source_id", stored: str = "speaker_clip_count", share: float = SHARE, salts: int = SALTS) -> DataFrame:
    """Of each non-null speaker: rows, different clips (the right count), smallest and largest stored count, and whether a stored one is wrong.

    Null clips count as rows but not as clips; null stored counts are not wrong. An empty table gives no rows.
    """
    spec = {"rows": ("rows", None), "clips": ("count_distinct", clip), "stored_min": ("min", stored), "stored_max": ("max", stored)}
    per = salted_aggregate(df.filter(F.col(speaker).isNotNull()), speaker, spec, share=share, salts=salts)
    wrong = (F.col("stored_min") != F.col("clips")) | (F.col("stored_max") != F.col("clips"))
    return per.withColumn("stale", F.coalesce(wrong, F.lit(False)))
