"""Phases end to end: each takes and gives tables; paths and parameters are arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwright.functions.audio import clean_audio, loudness_gain, loudness_report
from clipwright.functions.text import with_normalized_transcript
from clipwright.operators.cleanup import cleanup, cleanup_audit, deny, drop_noise
from clipwright.operators.density import MIN_CLUSTER, MIN_SAMPLES, cluster_partitions
from clipwright.operators.lookups import last_of, relabel
from clipwright.operators.metadata import add_clip_count, add_speaker_index, dense_numbers, normalize_metadata, union_splits
from clipwright.operators.profile import metric_stats
from clipwright.operators.sampling import stratified_split
from clipwright.operators.schema import ANNOTATED, cast_to, rename_source, require_columns, require_rows
from clipwright.operators.vectors import centroids, rescue
from clipwright.operators.votes import renumber_clusters
from clipwright.sources.writers import promote, write_report


def ingest(splits: dict[str, DataFrame], order: str | None = None) -> DataFrame:
    """Splits in one table, source names kept apart from ours, each speaker with its index; with ``order`` (unique in a split) a stored ``row_id``."""
    rows = rename_source(require_rows(union_splits(splits), "ingest"))
    rows = add_speaker_index(require_columns(rows, ["source_id", "source_speaker_id"]))
    return dense_numbers(rows, [F.col("split"), F.col(order)], "row_id") if order else rows


def annotate(clips: DataFrame) -> DataFrame:
    return add_clip_count(normalize_metadata(require_columns(clips, ["gender", "language", "source_speaker_id"])))


def refine_text(clips: DataFrame) -> DataFrame:
    return with_normalized_transcript(require_columns(clips, ["transcription"]))


def refine_audio(clips: DataFrame, denied: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(kept clips, dropped ones with the reason). Denied speakers go before any audio is decoded."""
    rows = require_columns(clips, ["source_id", "source_speaker_id", "audio"])
    out = rows.filter(F.col("source_speaker_id").isin(list(denied))).select("source_id", F.lit("blacklisted_speaker").alias("drop_reason")) if denied else None
    flat = deny(rows, "source_speaker_id", denied).withColumn("_s", F.col("audio.array")).withColumn("_r", F.col("audio.sampling_rate")).drop("audio")
    done = clean_audio(flat, "_s", "_r")
    dropped = done.filter("drop_reason is not null").select("source_id", "drop_reason")
    kept = done.filter("drop_reason is null").withColumn("audio", F.struct(F.col("samples").alias("array"), F.col("sampling_rate"))).drop("samples", "sampling_rate", "drop_reason")
    return kept, dropped if out is None else out.unionByName(dropped)


def publish(clips: DataFrame, target: str, *, seed: int = 42) -> None:
    """Clean up, split by speaker, and promote with a report beside the table."""
    left = cleanup(clips)
    require_rows(left, "clean-up")
    promote(stratified_split(left, "source_speaker_id", "source_id", seed=seed), target, partition_by=("split",))
    write_report(cleanup_audit(clips, "source_speaker_id", "duration"), target.rstrip("/") + ".report")


def audit(clips: DataFrame) -> DataFrame:
    return metric_stats(clips, ("snr_db", "speech_ratio", "quality_score", "duration"))


def regroup_speakers(voices: DataFrame, *, dims: int, least: int = MIN_CLUSTER, samples: int = MIN_SAMPLES, accept: float = 0.75) -> DataFrame:
    """Voices with new cluster_id, cluster_confidence and noise_rescued: density clusters by predicted gender, numbered by size, then noise taken in by the nearest centroid."""
    ok = voices.filter(F.coalesce("embedding_ok", F.lit(True)) & F.col("embedding").isNotNull())
    sexed = ok.filter(F.col("gender_predicted").isin("Female", "Male"))
    raw = cluster_partitions(sexed, record="source_id", vector="embedding", partition="gender_predicted", least=least, samples=samples)
    ids = renumber_clusters(raw, "partition", "raw_label").select("partition", "raw_label", "cluster_id")
    known = raw.join(ids, ["partition", "raw_label"], "left").select("source_id", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"), "cluster_confidence")
    base = voices.drop("cluster_id", "cluster_confidence", "noise_rescued").join(known, "source_id", "left").na.fill({"cluster_id": -1, "cluster_confidence": 0.0})
    cents = centroids(base.filter("cluster_id <> -1"), "cluster_id", "embedding", dims)
    sex = base.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.min("gender_predicted").alias("gender_predicted"))
    noise = base.filter("cluster_id = -1 and embedding is not null").filter(F.coalesce("embedding_ok", F.lit(True))).select("source_id", "embedding", "gender_predicted")
    found = rescue(noise, cents.join(sex, "cluster_id"), "embedding", "cluster_id", "gender_predicted", least=accept).filter("rescued").select("source_id", F.col("nearest").alias("_c"), F.col("cosine").alias("_q"))
    out = base.join(found, "source_id", "left").withColumn("noise_rescued", F.col("_c").isNotNull())
    return out.withColumn("cluster_id", F.coalesce("_c", "cluster_id")).withColumn("cluster_confidence", F.coalesce("_q", "cluster_confidence")).drop("_c", "_q")


def level_audio(clips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clips with their audio at the release's loudness, outcomes): each outcome's clips, clipped ones, mean gain and highest peak. The struct ``audio`` keeps its rate."""
    flat = require_columns(clips, ["audio"]).withColumn("_s", F.col("audio.array")).withColumn("_r", F.col("audio.sampling_rate")).drop("audio")
    done = loudness_gain(flat, "_s", "_r")
    report = loudness_report(done)
    names = ["loudness_status", "loudness_before", "loudness_gain", "loudness_clipped", "peak_dbfs"]
    return done.withColumn("audio", F.struct(F.col("_s").alias("array"), F.col("_r").alias("sampling_rate"))).drop("_s", "_r", *names), report


def rebuild(clips: DataFrame, mapping: DataFrame, *, seed: int = 42) -> DataFrame:
    """Clips of the annotated release: noise out, one mapping row for each clip, audio (if there is any) levelled, cast and split by new speaker."""
    rows = last_of(drop_noise(mapping.select("source_id", "cluster_id", "cluster_gender", "cluster_confidence")), "source_id", ["cluster_confidence", "cluster_id"])
    joined = relabel(clips.drop("gender", "split"), rows)
    named = joined.withColumnsRenamed({"cluster_id": "speaker_id", "cluster_gender": "gender", "cluster_confidence": "speaker_assignment_confidence"})
    counted = add_clip_count(named.drop("speaker_clip_count"), "speaker_id")
    if "audio" not in counted.columns:
        return stratified_split(cast_to(counted, ANNOTATED), "speaker_id", "source_id", seed=seed)
    types = {"audio": "struct<array:array<float>,sampling_rate:int>"} | ANNOTATED
    return stratified_split(cast_to(level_audio(counted)[0], types), "speaker_id", "source_id", seed=seed)
