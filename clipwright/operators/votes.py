"""Majority labels, reports and flags of clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.operators.metadata import dense_numbers
from clipwright.operators.skew import salted_aggregate

GENDERS = ("Female", "Male", "Unknown")
MAJORITY = 0.75
MANY_SOURCES = 3


def vote_matrix(df: DataFrame, cluster: str = "cluster_id", gender: str = "gender_predicted") -> DataFrame:
    """Counts of each gender by cluster, 0 where there is none, and the cluster's size; null clusters left out."""
    flags = df.filter(F.col(cluster).isNotNull()).select(cluster, *(F.coalesce((F.col(gender) == g).cast("long"), F.lit(0)).alias(g.lower()) for g in GENDERS))
    return salted_aggregate(flags, cluster, {"cluster_size": ("rows", None)} | {f"{g.lower()}_clips": ("sum", g.lower()) for g in GENDERS})


def with_majority(matrix: DataFrame, least: float = MAJORITY) -> DataFrame:
    """cluster_gender: the label with at least ``least`` of the votes; else Mixed if both Female and Male occur, else Unknown. With its share of the votes."""
    f, m, u, n = (F.col(c) for c in ("female_clips", "male_clips", "unknown_clips", "cluster_size"))
    top = F.greatest(f, m, u)
    name = F.when(f == top, "Female").when(m == top, "Male").otherwise("Unknown")
    share = top / n
    gender = F.when(share >= least, name).when((f > 0) & (m > 0), "Mixed").otherwise("Unknown")
    return matrix.withColumn("cluster_gender", gender).withColumn("cluster_gender_confidence", share)


def cluster_sources(df: DataFrame, cluster: str = "cluster_id", speaker: str = "source_speaker_id") -> DataFrame:
    """Different speakers by cluster, counted and listed in order. The list is made of a cluster's different speakers, not of its rows."""
    pairs = df.filter(F.col(cluster).isNotNull() & F.col(speaker).isNotNull()).select(cluster, speaker).distinct()
    return pairs.groupBy(cluster).agg(F.count(F.lit(1)).alias("unique_source_speakers"), F.array_join(F.array_sort(F.collect_list(speaker)), "|").alias("source_speaker_ids"))


def flag_text(noise: Column, rescued: Column, gender: Column, sources: Column, failed: Column, sep: str = "|") -> Column:
    """Flags in their fixed order; "" if there is none."""
    yes = lambda c, name: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    return F.concat_ws(
        sep, yes(noise, "NOISE"), yes(rescued, "RESCUED"), yes(gender == "Mixed", "MIXED_GENDER"), yes(sources > MANY_SOURCES, "MANY_SOURCES"), yes(failed, "EMBEDDING_FAILED")
    )


def cluster_report(df: DataFrame) -> DataFrame:
    """A row for each cluster but noise: votes, label, sources, mean confidences and flags."""
    real = df.filter(F.col("cluster_id").isNotNull() & (F.col("cluster_id") != -1))
    votes = with_majority(vote_matrix(real))
    means = salted_aggregate(real, "cluster_id", {"mean_gender_confidence": ("avg", "gender_confidence"), "mean_cluster_confidence": ("avg", "cluster_confidence")})
    joined = votes.join(cluster_sources(real), "cluster_id", "left").join(means, "cluster_id")
    joined = joined.na.fill({"unique_source_speakers": 0, "source_speaker_ids": ""})
    no = F.lit(False)
    return joined.withColumn("flag", flag_text(no, no, F.col("cluster_gender"), F.col("unique_source_speakers"), no))


def relabel_mapping(df: DataFrame) -> DataFrame:
    """A row for each clip with its cluster's label, size, sources and flags; noise has an Unknown label and size 0. The cluster table is small and joined by AQE's choice."""
    info = cluster_report(df).select("cluster_id", "cluster_gender", "cluster_size", "unique_source_speakers")
    rows = df.select("source_id", "source_speaker_id", "cluster_id", "gender_predicted", "gender_confidence", "cluster_confidence", "noise_rescued", "embedding_ok")
    noise = F.col("cluster_id").eqNullSafe(F.lit(-1)) | F.col("cluster_id").isNull()
    out = rows.join(info, "cluster_id", "left").na.fill({"cluster_gender": "Unknown", "cluster_size": 0, "unique_source_speakers": 0})
    flag = flag_text(noise, F.col("noise_rescued"), F.col("cluster_gender"), F.col("unique_source_speakers"), ~F.col("embedding_ok"))
    return out.withColumn("flag", flag).drop("embedding_ok")


def renumber_clusters(df: DataFrame, partition: str, label: str, order: tuple[str, ...] = ("Female", "Male")) -> DataFrame:
    """(partition, label, size, cluster_id): ids from 0 on, partitions in ``order``, then by size, larger first, then by label. Noise (-1) gets no id."""
    sizes = df.filter(F.col(label).isNotNull() & (F.col(label) != -1) & F.col(partition).isin(*order)).groupBy(partition, label).agg(F.count(F.lit(1)).alias("size"))
    place = F.array_position(F.array(*(F.lit(x) for x in order)), F.col(partition))
    return dense_numbers(sizes.withColumn("_place", place), [F.asc("_place"), F.desc("size"), F.asc(label)], "cluster_id").drop("_place")


def vote_string(df: DataFrame, cluster: str, gender: str) -> DataFrame:
    """Votes as "F:3 | M:1", by the label's first letter, in order."""
    votes = df.filter(F.col(cluster).isNotNull() & F.col(gender).isNotNull()).groupBy(cluster, F.substring(gender, 1, 1).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("g", "n"))), lambda s: F.concat(s["g"], F.lit(":"), s["n"].cast("string")))
    return votes.groupBy(cluster).agg(F.array_join(parts, " | ").alias("votes"))
