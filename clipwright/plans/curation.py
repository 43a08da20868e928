"""Queries on metadata, text, clean-up and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.functions.text import character_counts, has_punctuation, length_stats, normalization_diff, normalize_transcript, unexpected_characters
from clipwright.operators.cleanup import cleanup, cleanup_audit, deny, drop_noise, failed_rules
from clipwright.operators.lookups import last_of, lookup, not_done, only_in, path_keys, relabel
from clipwright.operators.metadata import add_clip_count, before_after_counts, normalize_metadata, speaker_index, union_splits, value_counts
from clipwright.operators.schema import ANNOTATED, cast_to, nan_to_null, rename_source, rows_between
from clipwright.plans.tables import table

DENIED = ["spk_004321eb", "rec.862eec62.m"]


def cleanup_filter(spark: SparkSession, d: str) -> DataFrame:
    """Short clips, then single clips of a speaker out; counts made anew."""
    clips = table(spark, d, "clips_split").filter("source_speaker_id is not null").drop("audio")
    return cleanup(clips.select("row_id", "source_speaker_id", "duration")).select("row_id", "source_speaker_id", "speaker_clip_count")


def cleanup_report(spark: SparkSession, d: str) -> DataFrame:
    return cleanup_audit(table(spark, d, "clips_split"), "source_speaker_id", "duration")


def denylist_filter(spark: SparkSession, d: str) -> DataFrame:
    return deny(table(spark, d, "clips_annotated").select("row_id", "source_speaker_id"), "source_speaker_id", DENIED)


def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    return drop_noise(table(spark, d, "clip_voice").select("row_id", "cluster_id"))


def rule_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Which quality rules a clip fails."""
    rules = {
        "low_snr": F.col("snr_db") >= 20, "little_speech": F.col("speech_ratio") >= 0.35, "short": F.coalesce(F.col("duration") >= 3, F.lit(True)), "no_text": F.length("transcription") > 0,
    }
    return table(spark, d, "clips_split").select("row_id", failed_rules(rules).alias("reason"))


def cache_miss_anti(spark: SparkSession, d: str) -> DataFrame:
    """Clips whose voice hasn't been embedded."""
    clips = table(spark, d, "clips_split").select("row_id", "source_id")
    return not_done(clips, table(spark, d, "clip_voice").filter("embedding is not null"), "source_id")


def top_speaker_semi(spark: SparkSession, d: str) -> DataFrame:
    """Clips of the 20 speakers with most clips."""
    clips = table(spark, d, "clips_annotated").select("row_id", "source_speaker_id")
    top = value_counts(clips, "source_speaker_id").orderBy(F.desc("n"), "value").limit(20).select(F.col("value").alias("source_speaker_id"))
    return only_in(clips, top, "source_speaker_id")


def relabel_join(spark: SparkSession, d: str) -> DataFrame:
    """Published clips with their voice's cluster, cast for the annotated release; NaN comes out as null."""
    clips = table(spark, d, "clips_split")
    voices = last_of(drop_noise(table(spark, d, "clip_voice").select("source_id", "cluster_id", "cluster_confidence", "gender_predicted", "loaded_at", "row_id")), "source_id", ["loaded_at", "row_id"])
    joined = relabel(clips.drop("gender", "row_id", "loaded_at"), voices.drop("row_id", "loaded_at"))
    named = joined.withColumnsRenamed({"cluster_id": "speaker_id", "gender_predicted": "gender", "cluster_confidence": "speaker_assignment_confidence"})
    return nan_to_null(cast_to(named, ANNOTATED))


def default_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Voices with the score and gender of their clip's last delivery, 0 and "" where there is none; a NaN counts as none."""
    voices = table(spark, d, "clip_voice").select("row_id", "source_id")
    clips = nan_to_null(table(spark, d, "clips_split").select("source_id", "quality_score", "snr_db", "gender", "loaded_at", "row_id"))
    return lookup(voices, clips, "source_id", {"quality_score": 0.0, "snr_db": 0.0, "gender": ""}, ["loaded_at", "row_id"])


def source_rename(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "clips_annotated").select(F.col("source_id").alias("id"), F.col("source_speaker_id").alias("speaker_id"), "row_id")
    return rename_source(raw).select("row_id", "source_id", "source_speaker_id")


def row_slice(spark: SparkSession, d: str) -> DataFrame:
    return rows_between(table(spark, d, "clips_annotated").select("row_id", "source_id"), "row_id", 100, 200)


def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """Keys parsed from the paths of clip files."""
    tier = F.element_at(F.array(F.lit(""), F.lit("__tier-low"), F.lit("__tier-mid"), F.lit("__tier-high")), (F.col("row_id") % 4 + 1).cast("int"))
    clips = table(spark, d, "clips_annotated").filter("source_speaker_id is not null")
    path = F.concat(F.lit("/data/"), F.format_string("%02d", (F.col("row_id") % 40).cast("int")), F.lit("_"), F.col("source_speaker_id"), F.lit("/"), F.col("source_id"), tier, F.lit(".wav"))
    return clips.select("row_id", path.alias("path")).select("row_id", *(v.alias(k) for k, v in path_keys(F.col("path")).items()))


def clip_names(spark: SparkSession, d: str) -> DataFrame:
    """File names with padded numbers."""
    return table(spark, d, "clip_voice").select("row_id", F.format_string("%s_%06d.wav", F.coalesce("source_id", F.lit("none")), "row_id").alias("file_name"))


def union_all_splits(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clips_split").select("row_id", "source_id", "split")
    parts = {s: clips.filter(F.col("split") == s).drop("split") for s in ("test", "train", "validation")}
    return union_splits(parts).groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("source_id").alias("clips"))


def metadata_norm(spark: SparkSession, d: str) -> DataFrame:
    return normalize_metadata(table(spark, d, "clips_annotated").select("row_id", "gender", "language"))


def gender_before_after(spark: SparkSession, d: str) -> DataFrame:
    before = table(spark, d, "clips_annotated").select("gender", "language")
    return before_after_counts(before, normalize_metadata(before), "gender")


def value_counts_drop_null(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(table(spark, d, "clips_annotated"), "split")


def value_counts_keep_null(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(table(spark, d, "clips_annotated"), "split", nulls=True)


def speaker_numbers(spark: SparkSession, d: str) -> DataFrame:
    return speaker_index(table(spark, d, "clips_annotated").select("source_speaker_id"))


def clip_count(spark: SparkSession, d: str) -> DataFrame:
    return add_clip_count(table(spark, d, "clips_annotated").select("row_id", "source_speaker_id", "speaker_clip_count")).select("row_id", "speaker_clip_count")


def text_normalize(spark: SparkSession, d: str) -> DataFrame:
    text = table(spark, d, "clips_text").select("row_id", normalize_transcript(F.col("transcription")).alias("transcription"))
    return text.withColumn("has_punctuation", has_punctuation(F.col("transcription")))


def document_normalize(spark: SparkSession, d: str) -> DataFrame:
    """The same over documents; texts come out as digests."""
    return table(spark, d, "documents").select("doc_id", F.md5(normalize_transcript(F.col("text"))).alias("digest"))


def punctuation_rate(spark: SparkSession, d: str) -> DataFrame:
    flags = table(spark, d, "clips_text").filter("transcription is not null").select(has_punctuation(normalize_transcript(F.col("transcription"))).alias("p"))
    n = F.count(F.lit(1))
    return flags.agg(n.alias("rows"), F.count_if("p").alias("with_punctuation"), F.when(n > 0, F.count_if("p") / n).otherwise(0.0).alias("share"))


def char_frequency(spark: SparkSession, d: str) -> DataFrame:
    return character_counts(table(spark, d, "clips_text"), "transcription")


def char_unexpected(spark: SparkSession, d: str) -> DataFrame:
    """The 20 most frequent characters that the audit doesn't expect: a report of fixed length."""
    return unexpected_characters(table(spark, d, "clips_text"), "transcription")


def length_report(spark: SparkSession, d: str) -> DataFrame:
    return length_stats(table(spark, d, "clips_text"), "transcription")


def norm_diff(spark: SparkSession, d: str) -> DataFrame:
    """The first ten rows that normalisation changes: a report of fixed length."""
    return normalization_diff(table(spark, d, "clips_text"), "transcription", "row_id")


def duration_text(spark: SparkSession, d: str) -> DataFrame:
    """Speaker time as H:MM:SS."""
    per = table(spark, d, "clips_split").filter("source_speaker_id is not null and not isnan(duration)").groupBy("source_speaker_id").agg(F.round(F.sum(F.col("duration").cast("decimal(12,3)")), 0).cast("long").alias("s"))
    s = F.col("s")
    return per.select("source_speaker_id", F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60).alias("time"))


QUERIES = {
    f.__name__: f
    for f in (
        cleanup_filter, cleanup_report, denylist_filter, noise_filter, rule_reasons, cache_miss_anti, top_speaker_semi, relabel_join, default_lookup, source_rename, row_slice, path_parts, clip_names,
        union_all_splits, metadata_norm, gender_before_after, value_counts_drop_null, value_counts_keep_null, speaker_numbers, clip_count, text_normalize, document_normalize, punctuation_rate,
        char_frequency, char_unexpected, length_report, norm_diff, duration_text,
    )
}

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _norm(c: str) -> str:
    """The ten rules in order, on text in which accents are stripped."""
    x = f"strip_accents({c})"
    x = rf"regexp_replace({x}, '\p{{Mn}}', '', 'g')"
    x = f"translate({x}, '’‘“”`', '''''''''''')"
    x = f"""regexp_replace({x}, '"{{2,}}', '"', 'g')"""
    x = f"translate({x}, '—–', '  ')"
    x = f"regexp_replace({x}, '{_WS}+-{_WS}+', '-', 'g')"
    x = rf"regexp_replace({x}, '([A-Za-z])\.([A-Z])', '\1. \2', 'g')"
    x = rf"regexp_replace({x}, '{_WS}+([,.])', '\1', 'g')"
    x = rf"""regexp_replace({x}, '[^A-Za-z0-9.,?!''" \-]', ' ', 'g')"""
    return f"trim(regexp_replace({x}, ' +', ' ', 'g'))"




def _num(c: str, kind: str = "DOUBLE") -> str:
    """A number with NaN as null. NaN is told by its text, as DuckDB folds isnan() by footer statistics, which leave NaN out."""
    return f"CASE WHEN {c}::VARCHAR <> 'nan' THEN {c} END::{kind}"


_SHORT = "coalesce(duration < 3.0, false)"
_GENDER = f"upper(substr({_strip('gender')}, 1, 1)) || lower(substr({_strip('gender')}, 2))"
_VC = "SELECT {0} AS value, count(*) AS n FROM clips_annotated {1} GROUP BY 1"

SQL = {
    "cleanup_filter": f"""SELECT row_id, source_speaker_id, n AS speaker_clip_count FROM (
        SELECT row_id, source_speaker_id, count(*) OVER (PARTITION BY source_speaker_id) AS n FROM clips_split WHERE source_speaker_id IS NOT NULL AND NOT {_SHORT}) WHERE n <> 1""",
    "cleanup_report": f"""WITH p AS (SELECT source_speaker_id AS s, count(*) AS n, sum({_SHORT}::INT) AS short FROM clips_split GROUP BY 1),
        t AS (SELECT sum(n)::BIGINT AS rows_in, sum(short)::BIGINT AS dropped_short, sum(CASE WHEN s IS NOT NULL AND n - short = 1 THEN 1 ELSE 0 END)::BIGINT AS dropped_singleton FROM p)
        SELECT *, rows_in - dropped_short - dropped_singleton AS rows_out, (rows_in - dropped_short - dropped_singleton) / rows_in AS kept_share FROM t""",
    "denylist_filter": "SELECT row_id, source_speaker_id FROM clips_annotated WHERE source_speaker_id IS NULL OR source_speaker_id NOT IN ('spk_004321eb', 'rec.862eec62.m')",
    "noise_filter": "SELECT row_id, cluster_id FROM clip_voice WHERE cluster_id IS DISTINCT FROM -1",
    "rule_reasons": """SELECT row_id, CASE WHEN r = '' THEN 'all_rules_passed' ELSE r END AS reason FROM (SELECT row_id, concat_ws('|',
        CASE WHEN NOT coalesce(snr_db >= 20, false) THEN 'low_snr' END, CASE WHEN NOT coalesce(speech_ratio >= 0.35, false) THEN 'little_speech' END,
        CASE WHEN NOT coalesce(duration >= 3, true) THEN 'short' END, CASE WHEN NOT coalesce(length(transcription) > 0, false) THEN 'no_text' END) AS r FROM clips_split)""",
    "cache_miss_anti": "SELECT row_id, source_id FROM clips_split c WHERE NOT EXISTS (SELECT 1 FROM clip_voice v WHERE v.source_id = c.source_id AND v.embedding IS NOT NULL)",
    "top_speaker_semi": """SELECT row_id, source_speaker_id FROM clips_annotated WHERE source_speaker_id IN (
        SELECT source_speaker_id FROM clips_annotated WHERE source_speaker_id IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, source_speaker_id LIMIT 20)""",
    "relabel_join": f"""WITH v AS (SELECT * FROM clip_voice WHERE cluster_id IS DISTINCT FROM -1 QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY loaded_at DESC, row_id DESC) = 1)
        SELECT c.transcription, c.source_id, v.cluster_id::INT AS speaker_id, c.speaker_clip_count::INT AS speaker_clip_count, c.language, v.gender_predicted AS gender, c.has_punctuation, {_num('c.snr_db', 'FLOAT')} AS snr_db,
        {_num('c.speech_ratio', 'FLOAT')} AS speech_ratio, {_num('c.quality_score', 'FLOAT')} AS quality_score, {_num('c.duration', 'FLOAT')} AS duration, {_num('v.cluster_confidence', 'FLOAT')} AS speaker_assignment_confidence
        FROM clips_split c JOIN v USING (source_id)""",
    "default_lookup": f"""WITH c AS (SELECT * FROM clips_split QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY loaded_at DESC, row_id DESC) = 1)
        SELECT v.source_id, v.row_id, coalesce({_num('c.quality_score')}, 0.0) AS quality_score, coalesce({_num('c.snr_db')}, 0.0) AS snr_db, coalesce(c.gender, '') AS gender FROM clip_voice v LEFT JOIN c USING (source_id)""",
    "source_rename": "SELECT row_id, source_id, source_speaker_id FROM clips_annotated",
    "row_slice": "SELECT row_id, source_id FROM clips_annotated WHERE row_id >= 100 AND row_id < 200",
    "path_parts": """SELECT row_id, f AS source_speaker_id, split_part(f, '_', 1) || '_' || substr(substr(f, 4), 1, 8) AS folder_prefix, regexp_replace(s, '^sna_', '') AS source_id,
        regexp_replace(regexp_replace(s, '^sna_', ''), '__tier-(low|mid|high)$', '') AS base_source_id, s || '.wav' AS original_filename FROM (
        SELECT row_id, format('{:02d}', row_id % 40) || '_' || source_speaker_id AS f, source_id || (['', '__tier-low', '__tier-mid', '__tier-high'])[row_id % 4 + 1] AS s FROM clips_annotated WHERE source_speaker_id IS NOT NULL)""",
    "clip_names": "SELECT row_id, coalesce(source_id, 'none') || format('_{:06d}.wav', row_id) AS file_name FROM clip_voice",
    "union_all_splits": "SELECT split, count(*) AS rows, count(DISTINCT source_id) AS clips FROM clips_split WHERE split IN ('train', 'validation', 'test') GROUP BY 1",
    "metadata_norm": f"SELECT row_id, {_GENDER} AS gender, lower({_strip('language')}) AS language FROM clips_annotated",
    "gender_before_after": f"""SELECT 'before' AS version, gender AS value, count(*) AS n FROM clips_annotated WHERE gender IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'after', {_GENDER}, count(*) FROM clips_annotated WHERE gender IS NOT NULL GROUP BY 2""",
    "value_counts_drop_null": _VC.format("split", "WHERE split IS NOT NULL"),
    "value_counts_keep_null": _VC.format("split", ""),
    "speaker_numbers": """SELECT source_speaker_id, count(*) AS clips, (row_number() OVER (ORDER BY count(*) DESC, source_speaker_id) - 1)::INT AS speaker_idx
        FROM clips_annotated WHERE source_speaker_id IS NOT NULL GROUP BY 1""",
    "clip_count": "SELECT row_id, CASE WHEN source_speaker_id IS NOT NULL THEN count(*) OVER (PARTITION BY source_speaker_id) END AS speaker_clip_count FROM clips_annotated",
    "text_normalize": f"SELECT row_id, t AS transcription, regexp_matches(t, '[.,?!]') AS has_punctuation FROM (SELECT row_id, {_norm('transcription')} AS t FROM clips_text)",
    "document_normalize": f"SELECT doc_id, md5({_norm('text')}) AS digest FROM documents",
    "punctuation_rate": f"""SELECT count(*) AS rows, count(*) FILTER (p) AS with_punctuation, count(*) FILTER (p) / count(*) AS share
        FROM (SELECT regexp_matches({_norm('transcription')}, '[.,?!]') AS p FROM clips_text WHERE transcription IS NOT NULL)""",
    "char_frequency": "SELECT char, count(*) AS n FROM (SELECT unnest(regexp_extract_all(transcription, '(?s).')) AS char FROM clips_text) GROUP BY 1",
    "char_unexpected": r"""SELECT char, count(*) AS n FROM (SELECT unnest(regexp_extract_all(transcription, '(?s).')) AS char FROM clips_text)
        WHERE NOT regexp_matches(char, '^[A-Za-z0-9\s.,?!''\-]$') GROUP BY 1 ORDER BY n DESC, char LIMIT 20""",
    "length_report": """SELECT count(*) AS rows, count(*) FILTER (transcription IS NULL) AS nulls, count(*) FILTER (transcription = '') AS empty, min(length(transcription))::INT AS shortest,
        max(length(transcription))::INT AS longest, avg(length(transcription)) AS mean_length FROM clips_text""",
    "norm_diff": f"SELECT row_id, transcription AS before, {_norm('transcription')} AS after FROM clips_text WHERE transcription <> {_norm('transcription')} ORDER BY row_id LIMIT 10",
    "duration_text": """SELECT source_speaker_id, format('{}:{:02d}:{:02d}', s // 3600, s % 3600 // 60, s % 60) AS time FROM (
        SELECT source_speaker_id, round(sum(CASE WHEN duration::VARCHAR <> 'nan' THEN duration::VARCHAR::DECIMAL(12,3) END), 0)::BIGINT AS s FROM clips_split WHERE source_speaker_id IS NOT NULL AND duration::VARCHAR <> 'nan' GROUP BY 1)""",
}
