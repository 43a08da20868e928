"""Filters that leave only usable clips, with their accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import heavy_keys, key_profile, salted_aggregate, salted_join

MIN_SECONDS = 3.0


def is_short(duration: Column, least: float = MIN_SECONDS) -> Column:
    """Null and NaN durations are not short. The form is not pushed to Parquet on purpose: footer statistics ignore NaN, so a row group could be skipped wrongly."""
    return F.coalesce(duration < F.lit(least), F.lit(False))


def drop_short(df: DataFrame, duration: str = "duration", least: float = MIN_SECONDS) -> DataFrame:
    return df.filter(~is_short(F.col(duration), least))


def _counts(df: DataFrame, speaker: str, into: str) -> DataFrame:
    """(speaker, rows) of speakers with more than one row. Counts are combined before the shuffle, so they need no salt; a join back does."""
    return df.filter(F.col(speaker).isNotNull()).groupBy(speaker).agg(F.count(F.lit(1)).alias(into)).filter(F.col(into) > 1)


def drop_singletons(df: DataFrame, speaker: str = "source_speaker_id") -> DataFrame:
    """Rows of speakers with more than one row; null speakers fall out."""
    return salted_join(df, _counts(df, speaker, "_rows").select(speaker), speaker, heavy=heavy_keys(df, speaker), how="left_semi")


def cleanup(df: DataFrame, speaker: str = "source_speaker_id", duration: str = "duration", least: float = MIN_SECONDS, count: str = "speaker_clip_count") -> DataFrame:
    """Short clips, then singleton speakers out; clip counts made anew. Raises if a row that is left has no speaker.

    One pass looks for rows without a speaker and for heavy speakers; one aggregate gives the counts by which singletons go and which the others get.
    """
    left = drop_short(df, duration, least).drop(count)
    _, nameless, heavy = key_profile(left, speaker)
    if nameless:
        raise ValueError("a clip has no speaker")
    return salted_join(left, _counts(left, speaker, count), speaker, heavy=heavy)


def cleanup_audit(df: DataFrame, speaker: str, duration: str, least: float = MIN_SECONDS) -> DataFrame:
    """One row: rows in, dropped as short, dropped as singletons, left, and the share kept (0 for no rows)."""
    per = salted_aggregate(df.withColumn("_short", is_short(F.col(duration), least).cast("int")), speaker, {"n": ("rows", None), "short": ("sum", "_short")})
    rest = F.col("n") - F.col("short")
    single = F.when(F.col(speaker).isNotNull() & (rest == 1), rest).otherwise(0)
    sums = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("short"), F.lit(0)).alias("dropped_short"), F.coalesce(F.sum(single), F.lit(0)).alias("dropped_singleton"))
    left = F.col("rows_in") - F.col("dropped_short") - F.col("dropped_singleton")
    return sums.withColumn("rows_out", left).withColumn("kept_share", F.when(F.col("rows_in") > 0, F.col("rows_out") / F.col("rows_in")).otherwise(0.0))


def deny(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value isn't on the list; nulls stay."""
    return df.filter(~F.coalesce(F.col(column).isin(list(values)), F.lit(False))) if values else df


def drop_noise(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Rows whose cluster isn't -1; null clusters stay."""
    return df.filter(~F.col(cluster).eqNullSafe(F.lit(-1)))


def failed_rules(rules: dict[str, Column], sep: str = "|", none: str = "all_rules_passed") -> Column:
    """Names of the rules that are not true, joined; ``none`` if all are."""
    text = F.concat_ws(sep, *(F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()))
    return F.when(text == "", none).otherwise(text)


def drop_reason_counts(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    return df.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
