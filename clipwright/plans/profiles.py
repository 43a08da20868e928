"""Queries on profiles, statistics, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.functions.text import strip
from clipwright.operators.profile import (
    by_speaker_category, category_votes, clip_histogram, coverage, dominant_category, duration_buckets, fixed_distribution, long_tail, majority, medians, metric_stats, ranked_speakers, speaker_profile,
)
from clipwright.operators.sampling import sample_per_group, sample_thirds, stratified_split, thirds, uniform_sample
from clipwright.plans.tables import table

METRICS = ("snr_db", "speech_ratio", "quality_score", "duration")


def _timed(spark: SparkSession, d: str) -> DataFrame:
    """Clips with their length in whole milliseconds, so that sums don't depend on their order."""
    ms = F.round(F.nanvl(F.col("duration"), F.lit(None).cast("double")) * 1000).cast("long")
    return table(spark, d, "clips_split").select("row_id", "source_id", "source_speaker_id", "gender", "quality_score", ms.alias("ms"))


def speaker_summary(spark: SparkSession, d: str) -> DataFrame:
    return speaker_profile(_timed(spark, d), "source_speaker_id", "ms")


def speaker_rank(spark: SparkSession, d: str) -> DataFrame:
    """The 39 speakers with most recorded time: a report of fixed length."""
    return ranked_speakers(speaker_profile(_timed(spark, d), "source_speaker_id", "ms").select("source_speaker_id", "clips", "total"), [F.desc_nulls_last("total"), F.asc("source_speaker_id")], 39)


def _genders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clips_annotated").select("source_speaker_id", F.lower(strip(F.col("gender"))).alias("gender"))


def gender_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Each speaker's gender by majority and whether its clips disagree."""
    found = majority(category_votes(_genders(spark, d), "source_speaker_id", "gender"), "source_speaker_id", "gender")
    return found.withColumn("labels", F.array_join("labels", "|"))


def gender_by_speaker(spark: SparkSession, d: str) -> DataFrame:
    return by_speaker_category(_genders(spark, d), "source_speaker_id", "gender")


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clips_annotated").filter("source_speaker_id is not null").groupBy("source_speaker_id").agg(F.count(F.lit(1)).alias("clips"))


def clip_buckets(spark: SparkSession, d: str) -> DataFrame:
    return clip_histogram(_counts(spark, d))


def coverage_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return coverage(_counts(spark, d))


def long_tail_summary(spark: SparkSession, d: str) -> DataFrame:
    return long_tail(_counts(spark, d))


def metric_summary(spark: SparkSession, d: str) -> DataFrame:
    out = metric_stats(table(spark, d, "clips_split"), METRICS)
    return out.select("metric", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "least", "most")


def metric_medians(spark: SparkSession, d: str) -> DataFrame:
    return medians(table(spark, d, "clips_split"), METRICS)


def duration_histogram(spark: SparkSession, d: str) -> DataFrame:
    return duration_buckets(table(spark, d, "clips_split"), "duration")


def gender_counts(spark: SparkSession, d: str) -> DataFrame:
    return fixed_distribution(table(spark, d, "clip_voice"), "gender_predicted", ("Female", "Male", "Unknown"))


def dominant_gender(spark: SparkSession, d: str) -> DataFrame:
    out = dominant_category(table(spark, d, "clip_voice"), "source_speaker_id", "gender_predicted", "gender_confidence")
    return out.withColumn("mean_confidence", F.round("mean_confidence", 12))


def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clips_annotated").agg(F.countDistinct("source_speaker_id").alias("speakers"), F.countDistinct("source_id").alias("clips"), F.count(F.lit(1)).alias("rows"))


def split_stratified(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clips_annotated").select("row_id", "source_speaker_id")
    return stratified_split(clips, "source_speaker_id", "row_id").select("row_id", "split")


def split_coverage(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clips_annotated").select("row_id", "source_speaker_id")
    return stratified_split(clips, "source_speaker_id", "row_id").groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("source_speaker_id").alias("speakers"))


def sample_uniform(spark: SparkSession, d: str) -> DataFrame:
    """500 clips: the sample is the feature."""
    return uniform_sample(table(spark, d, "clips_annotated").select("row_id", "source_id"), "row_id", 500)


def sample_each_speaker(spark: SparkSession, d: str) -> DataFrame:
    return sample_per_group(table(spark, d, "clips_annotated").filter("source_speaker_id is not null").select("row_id", "source_speaker_id"), "source_speaker_id", "row_id", 3)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clips_split").filter("source_speaker_id is not null and quality_score is not null and not isnan(quality_score)").select("row_id", "source_speaker_id", "quality_score")


def quality_thirds(spark: SparkSession, d: str) -> DataFrame:
    return thirds(_scored(spark, d), "source_speaker_id", "quality_score", "row_id").select("row_id", "tier")


def sample_tiers(spark: SparkSession, d: str) -> DataFrame:
    return sample_thirds(_scored(spark, d), "source_speaker_id", "quality_score", "row_id").select("row_id", "source_speaker_id", "tier")


QUERIES = {
    f.__name__: f
    for f in (
        speaker_summary, speaker_rank, gender_conflict, gender_by_speaker, clip_buckets, coverage_thresholds, long_tail_summary, metric_summary, metric_medians, duration_histogram, gender_counts,
        dominant_gender, distinct_counts, split_stratified, split_coverage, sample_uniform, sample_each_speaker, quality_thirds, sample_tiers,
    )
}

# NaN is told by its text, as DuckDB folds isnan() by footer statistics, which leave NaN out
_TIMED = "(SELECT *, CASE WHEN (duration::VARCHAR = 'nan') THEN NULL ELSE round(duration * 1000)::BIGINT END AS ms FROM clips_split)"
_COUNTS = "(SELECT source_speaker_id, count(*) AS clips FROM clips_annotated WHERE source_speaker_id IS NOT NULL GROUP BY 1)"
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_G = f"(SELECT source_speaker_id, lower(regexp_replace(gender, '^{_WS}+|{_WS}+$', '', 'g')) AS gender FROM clips_annotated WHERE source_speaker_id IS NOT NULL)"
_MAJ = f"""(SELECT source_speaker_id, gender AS majority FROM (SELECT source_speaker_id, gender, count(*) AS n FROM {_G} WHERE gender IS NOT NULL GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY source_speaker_id ORDER BY n DESC, gender) = 1)"""
_SPLIT = """(SELECT row_id, source_speaker_id, CASE WHEN n = 1 OR r <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN r <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM (
    SELECT row_id, source_speaker_id, count(*) OVER (PARTITION BY source_speaker_id) AS n, row_number() OVER (PARTITION BY source_speaker_id ORDER BY md5('42|' || row_id), row_id) AS r
    FROM clips_annotated WHERE source_speaker_id IS NOT NULL))"""
_THIRDS = """(SELECT row_id, source_speaker_id, CASE WHEN r <= greatest(1, n // 3) THEN 'low' WHEN r <= greatest(greatest(1, n // 3) + 1, n - n // 3) THEN 'mid' ELSE 'high' END AS tier FROM (
    SELECT row_id, source_speaker_id, count(*) OVER (PARTITION BY source_speaker_id) AS n, row_number() OVER (PARTITION BY source_speaker_id ORDER BY quality_score, row_id) AS r
    FROM clips_split WHERE source_speaker_id IS NOT NULL AND quality_score IS NOT NULL AND NOT (quality_score::VARCHAR = 'nan')))"""
_BUCKETS = "(VALUES ('1-9', 1, 9), ('10-24', 10, 24), ('25-49', 25, 49), ('50-99', 50, 99), ('100-199', 100, 199), ('200-499', 200, 499), ('500+', 500, NULL)) b(label, low, high)"


def _metric(c: str) -> str:
    return f"""SELECT '{c}' AS metric, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS least, max(v) AS most FROM (SELECT CASE WHEN ({c}::VARCHAR = 'nan') THEN NULL ELSE {c} END AS v FROM clips_split)"""


SQL = {
    "speaker_summary": f"SELECT source_speaker_id, count(*) AS clips, sum(ms)::BIGINT AS total, sum(ms)::DOUBLE / count(ms) AS mean, min(ms) AS least, max(ms) AS most FROM {_TIMED} WHERE source_speaker_id IS NOT NULL GROUP BY 1",
    "speaker_rank": f"""SELECT *, row_number() OVER (ORDER BY total DESC NULLS LAST, source_speaker_id)::INT AS rank FROM (
        SELECT source_speaker_id, count(*) AS clips, sum(ms)::BIGINT AS total FROM {_TIMED} WHERE source_speaker_id IS NOT NULL GROUP BY 1 ORDER BY total DESC NULLS LAST, source_speaker_id LIMIT 39)""",
    "gender_conflict": f"""SELECT source_speaker_id, majority, labels, k > 1 AS conflict FROM {_MAJ} JOIN (
        SELECT source_speaker_id, string_agg(DISTINCT gender, '|' ORDER BY gender) AS labels, count(DISTINCT gender) AS k FROM {_G} GROUP BY 1) USING (source_speaker_id)""",
    "gender_by_speaker": f"""SELECT coalesce(majority, 'unknown') AS category, count(*) AS speakers, sum(clips)::BIGINT AS clips FROM {_COUNTS} LEFT JOIN {_MAJ} USING (source_speaker_id) GROUP BY 1""",
    "clip_buckets": f"""SELECT *, speakers / sum(speakers) OVER () AS share FROM (SELECT label, low::BIGINT AS low, high::BIGINT AS high, count(clips) AS speakers, coalesce(sum(clips), 0)::BIGINT AS clips
        FROM {_BUCKETS} LEFT JOIN {_COUNTS} c ON c.clips >= low AND (high IS NULL OR c.clips <= high) GROUP BY 1, 2, 3)""",
    "coverage_thresholds": f"""SELECT t::INT AS threshold, count(clips) AS speakers, coalesce(sum(clips), 0)::BIGINT AS clips
        FROM (VALUES (10), (20), (30), (50), (75), (100), (150), (200)) v(t) LEFT JOIN {_COUNTS} c ON c.clips >= t GROUP BY 1""",
    "long_tail_summary": f"""SELECT *, tail_speakers / speakers AS tail_speaker_share, tail_clips / clips AS tail_clip_share FROM (SELECT count(*) AS speakers, sum(clips)::BIGINT AS clips,
        count(*) FILTER (clips < 50) AS tail_speakers, coalesce(sum(clips) FILTER (clips < 50), 0)::BIGINT AS tail_clips FROM {_COUNTS})""",
    "metric_summary": " UNION ALL ".join(_metric(c) for c in METRICS),
    "metric_medians": " UNION ALL ".join(f"SELECT '{c}' AS metric, median({c}) AS median FROM clips_split WHERE NOT ({c}::VARCHAR = 'nan')" for c in METRICS),
    "duration_histogram": """SELECT count(*) FILTER (d < 5) AS under_5, count(*) FILTER (d >= 5 AND d < 10) AS from_5_to_10, count(*) FILTER (d >= 10 AND d < 15) AS from_10_to_15,
        count(*) FILTER (d >= 15 AND d < 20) AS from_15_to_20, count(*) FILTER (d >= 20) AS from_20, count(*) FILTER (d IS NULL) AS unknown FROM (SELECT CASE WHEN NOT (duration::VARCHAR = 'nan') THEN duration END AS d FROM clips_split)""",
    "gender_counts": """SELECT count(*) FILTER (gender_predicted = 'Female') AS female, count(*) FILTER (gender_predicted = 'Male') AS male, count(*) FILTER (gender_predicted = 'Unknown') AS unknown FROM clip_voice""",
    "dominant_gender": """WITH p AS (SELECT source_speaker_id, count(*) AS total, count(*) FILTER (gender_predicted = 'Female') AS female, count(*) FILTER (gender_predicted = 'Male') AS male,
        count(*) FILTER (gender_predicted = 'Unknown') AS unknown, count(*) FILTER (gender_predicted = 'ERROR') AS errors,
        round(avg(gender_confidence) FILTER (gender_predicted IS DISTINCT FROM 'ERROR'), 12) AS mean_confidence FROM clip_voice WHERE source_speaker_id IS NOT NULL GROUP BY 1)
        SELECT *, CASE WHEN female >= male THEN 'Female' ELSE 'Male' END AS dominant, greatest(female, male) / greatest(total - unknown - errors, 1) AS dominant_share,
        concat_ws(' ', CASE WHEN unknown / total > 0.15 THEN 'HIGH_UNKNOWN' END, CASE WHEN female > 0 AND male > 0 AND least(female, male) / total > 0.20 THEN 'SPLIT' END) AS flags FROM p""",
    "distinct_counts": "SELECT count(DISTINCT source_speaker_id) AS speakers, count(DISTINCT source_id) AS clips, count(*) AS rows FROM clips_annotated",
    "split_stratified": f"SELECT row_id, split FROM {_SPLIT}",
    "split_coverage": f"SELECT split, count(*) AS rows, count(DISTINCT source_speaker_id) AS speakers FROM {_SPLIT} GROUP BY 1",
    "sample_uniform": "SELECT row_id, source_id FROM clips_annotated ORDER BY md5('42|' || row_id), row_id LIMIT 500",
    "sample_each_speaker": """SELECT row_id, source_speaker_id FROM clips_annotated WHERE source_speaker_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY source_speaker_id ORDER BY md5('42|' || row_id), row_id) <= 3""",
    "quality_thirds": f"SELECT row_id, tier FROM {_THIRDS}",
    "sample_tiers": f"""SELECT row_id, source_speaker_id, tier FROM (SELECT *, row_number() OVER (PARTITION BY source_speaker_id, tier ORDER BY md5('42|' || row_id), row_id) AS t FROM {_THIRDS})
        QUALIFY row_number() OVER (PARTITION BY source_speaker_id ORDER BY t > CASE tier WHEN 'mid' THEN 8 ELSE 6 END, md5('42|' || row_id), row_id) <= 20""",
}
