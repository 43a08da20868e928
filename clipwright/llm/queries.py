"""Queries p1 to p9 over the project's tables, each over the whole tables; p3 is in the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.llm.bpe import encode_corpus
from clipwright.llm.cap import cap_contributors, latest
from clipwright.llm.clusters import describe_clusters, similarity_clusters
from clipwright.llm.level import reading_levels, train_level_model
from clipwright.llm.lookalike import canonical_text, lookalike_pairs
from clipwright.llm.mixture import Mixture, language_key, mix_sources, source_key
from clipwright.llm.overlap import Rule, cross_overlaps, record_pairs
from clipwright.llm.related import entity_components, index_key, name_key, related_splits
from clipwright.operators.skew import heavy_keys, salted_join

PROPORTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of speaker ids that must share a split."""
    clips = table(spark, sf_dir, "clips_split")
    who = {"speaker": name_key("source_speaker_id"), "index": index_key("speaker_idx")}
    roots = entity_components(clips, who).filter(F.col("node").startswith("speaker:")).select("root", F.substring("node", 9, 2**31 - 1).alias("speaker_a"))
    others = roots.withColumnRenamed("speaker_a", "speaker_b").hint("merge")
    # a group's pairs are the result asked for; a large group's are made in several tasks
    return salted_join(roots, others, "root", heavy=heavy_keys(roots, "root")).filter("speaker_a < speaker_b").select("speaker_a", "speaker_b")


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of each row."""
    clips = table(spark, sf_dir, "clips_split").select("row_id", "source_id", "source_speaker_id", "speaker_idx")
    who = {"speaker": name_key("source_speaker_id"), "index": index_key("speaker_idx")}
    return related_splits(clips, who, record="row_id", proportions=PROPORTIONS, seed=42).select("row_id", "component", "related_split")


def _capped(spark: SparkSession, sf_dir: str, strata: bool) -> DataFrame:
    clips = table(spark, sf_dir, "clips_split").select("source_id", "speaker_idx", "language", "quality_score", "loaded_at", "row_id")
    clips = latest(clips, "source_id", ["loaded_at", "row_id"])
    who = F.when(F.col("speaker_idx") != -1, F.col("speaker_idx"))
    return cap_contributors(clips, contributor=who, quality=F.col("quality_score"), record="source_id", max_share=0.02, strata=language_key("language") if strata else None)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips beyond their speaker's cap of 2 in 100 of all clips; the whole of a speaker is one stratum."""
    return _capped(spark, sf_dir, strata=False).filter("not kept").select("source_id")


def p2_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clips left when a speaker's cap is split over languages; a NaN quality comes out as null."""
    quality = F.nanvl("quality_score", F.lit(None).cast("double")).alias("quality_score")
    return _capped(spark, sf_dir, strata=True).filter("kept").select("source_id", "speaker_idx", quality)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_pairs(table(spark, sf_dir, "clips_text"), "transcription", "row_id")


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of each transcription."""
    return canonical_text(table(spark, sf_dir, "clips_text").select("row_id", "transcription"), "transcription").select("row_id", "canonical")


#: at most an eighth of the longer text's words edited; shingles of two words, as an eighth of the edits may spoil any longer run of a short text
NEAR = Rule(width=2, jaccard=None, edits_part=8)


def _sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = table(spark, sf_dir, "clips_split").select("row_id", "source_id", "source_speaker_id", "transcription", "split")
    return clips.withColumn("side", F.when(F.col("split") == "train", 0).when(F.col("split").isin("validation", "test"), 1))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training row and an evaluation row with the same or almost the same transcription, the smaller row_id first."""
    members, pairs = cross_overlaps(_sided(spark, sf_dir), NEAR, record="row_id", text="transcription", side="side")
    return record_pairs(members, pairs).select("row_id_a", "row_id_b")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By split and speaker: evaluation rows, and those that occur in train by source_id, by equal words, or by nearly equal words."""
    clips = _sided(spark, sf_dir)
    members, pairs = cross_overlaps(clips, NEAR, record="row_id", text="transcription", side="side")
    kinds = pairs.groupBy(F.col("b").alias("id")).agg(F.max(F.col("exact").cast("int")).alias("same_text"), F.max((~F.col("exact")).cast("int")).alias("near_text"))
    held = members.filter("side = 1")
    texts = salted_join(held, kinds, "id", heavy=heavy_keys(held, "id")).select(F.col("record").alias("row_id"), "same_text", "near_text").distinct()
    ids = clips.filter("side = 0 and source_id is not null").select("source_id").distinct().withColumn("same_id", F.lit(1))
    rows = clips.filter("side = 1").select("row_id", "source_id", "split", name_key("source_speaker_id").alias("source")).join(ids, "source_id", "left").join(texts, "row_id", "left")
    hit = lambda *c: F.sum(F.greatest(*(F.coalesce(F.col(x), F.lit(0)) for x in c), F.lit(0))).alias("_".join(c) if len(c) == 1 else "overlapping")
    return rows.groupBy("split", "source").agg(F.count(F.lit(1)).alias("rows"), hit("same_id"), hit("same_text"), hit("near_text"), hit("same_id", "same_text", "near_text"))


VOICE = {"record": "source_id", "vector": "embedding", "ok": "embedding_ok"}


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips in a cluster of at least two, with its smallest source_id."""
    members = similarity_clusters(table(spark, sf_dir, "clip_voice"), **VOICE)
    several = members.groupBy("cluster_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("cluster_key")
    found = salted_join(members, several, "cluster_key", heavy=heavy_keys(members, "cluster_key"), how="left_semi")
    return found.select(F.col("record").alias("source_id"), "cluster_key")


def p6_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cluster's size and its three most typical clips."""
    voices = table(spark, sf_dir, "clip_voice")
    return describe_clusters(voices, similarity_clusters(voices, **VOICE), **VOICE)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "ids")


#: the domain of each source: what was said, what describes pictures, what was written
DOMAINS = {
    "field_transcripts": "spoken", "radio_talks": "spoken", "community_stories": "spoken", "council_minutes": "spoken", "picture_prompts": "described",
    "annotator_guides": "written", "session_notes": "written", "quality_memos": "written", "school_readers": "written",
}


def _mixture(spark: SparkSession, sf_dir: str, **settings: float) -> Mixture:
    targets = {r["source"]: (r["target_share"], r["max_repeats"]) for r in table(spark, sf_dir, "mix_targets").collect()}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mix_sources(docs, targets, record="doc_id", text="text", source=source_key("source"), language=language_key("lang"), domains=DOMAINS, seed=42, **settings)


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mixture with their number of uses."""
    return _mixture(spark, sf_dir).records


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached shares by source."""
    return _mixture(spark, sf_dir).shares


def p8_stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgets of a mixture twice as large as the sources can back in full: by node of the tree what was wanted and what it got after shortages moved."""
    return _mixture(spark, sf_dir, stretch=2.0).nodes


def p9_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level of each document."""
    model = train_level_model(table(spark, sf_dir, "level_samples"))
    return reading_levels(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_levels(spark, sf_dir).filter("level_words >= 40 and reading_level >= 4").select("doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_splits, p2_found, p2_strata, p4_found, p4_canonical, p5_found, p5_report, p6_found, p6_clusters, p7_ids, p8_mixture, p8_shares, p8_stretched, p9_found, p9_levels)}
