"""Speaker and corpus profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwright.operators.skew import salted_aggregate
from clipwright.storage import Scratch

# Inclusive clip-count buckets; the last is open
BUCKETS = ((1, 9), (10, 24), (25, 49), (50, 99), (100, 199), (200, 499), (500, None))
THRESHOLDS = (10, 20, 30, 50, 75, 100, 150, 200)
LONG_TAIL = 50
# Half-open duration buckets in seconds
DURATIONS = (5.0, 10.0, 15.0, 20.0)


def speaker_profile(df: DataFrame, speaker: str, value: str) -> DataFrame:
    """Clips, total, mean, least and largest ``value`` of each speaker; null speakers left out. Mergeable parts only, so large speakers are salted."""
    spec = {"clips": ("rows", None), "total": ("sum", value), "mean": ("avg", value), "least": ("min", value), "most": ("max", value)}
    return salted_aggregate(df.filter(F.col(speaker).isNotNull()), speaker, spec)


def ranked_speakers(profile: DataFrame, by: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` speakers with their 1-based rank. The limit comes first, so the rank needs no sort of the whole table."""
    top = profile.orderBy(*by).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*by)))


def category_votes(df: DataFrame, key: str, category: str) -> DataFrame:
    """(key, category, n): the table that modes, shares and conflicts are taken from; its size follows keys, not rows."""
    return df.filter(F.col(key).isNotNull()).groupBy(key, category).agg(F.count(F.lit(1)).alias("n"))


def majority(votes: DataFrame, key: str, category: str) -> DataFrame:
    """Most frequent non-null category of each key, ties to the smallest; with all its different ones, sorted, and whether there are several."""
    known = votes.filter(F.col(category).isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(category).alias("c")))
    out = known.groupBy(key).agg(best.alias("b"), F.array_sort(F.collect_set(category)).alias("labels"))
    return out.select(key, F.col("b.c").alias("majority"), "labels", (F.size("labels") > 1).alias("conflict"))


def bucket_table(spark: SparkSession, buckets: Sequence[tuple[int, int | None]] = BUCKETS) -> DataFrame:
    rows = [(i, f"{lo}-{hi}" if hi else f"{lo}+", lo, hi) for i, (lo, hi) in enumerate(buckets)]
    return spark.createDataFrame(rows, "bucket int, label string, low long, high long")


def clip_histogram(counts: DataFrame, clips: str = "clips", buckets: Sequence[tuple[int, int | None]] = BUCKETS) -> DataFrame:
    """Speakers, clips and share of speakers by bucket; empty buckets have 0. The range condition becomes a bucket number by CASE, then a join on it."""
    c = F.col(clips)
    number = F.coalesce(*(F.when((c >= lo) & (c <= hi if hi else F.lit(True)), F.lit(i)) for i, (lo, hi) in enumerate(buckets)))
    per = counts.groupBy(number.alias("bucket")).agg(F.count(F.lit(1)).alias("speakers"), F.sum(c).alias("clips")).filter("bucket is not null")
    table = bucket_table(counts.sparkSession, buckets).join(per, "bucket", "left")
    everyone = Window.partitionBy()
    out = table.select("label", "low", "high", F.coalesce("speakers", F.lit(0)).alias("speakers"), F.coalesce("clips", F.lit(0)).alias("clips"))
    total = F.sum("speakers").over(everyone)
    return out.withColumn("share", F.when(total > 0, F.col("speakers") / total).otherwise(0.0))


def coverage(counts: DataFrame, clips: str = "clips", thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """Speakers with at least each threshold of clips, and those clips. One pass of conditional sums turned into rows."""
    c = F.col(clips)
    sums = [x for t in thresholds for x in (F.count_if(c >= t).alias(f"s{t}"), F.coalesce(F.sum(F.when(c >= t, c)), F.lit(0)).alias(f"c{t}"))]
    rows = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"s{t}").alias("speakers"), F.col(f"c{t}").alias("clips")) for t in thresholds))
    return counts.agg(*sums).select(F.inline(rows))


def long_tail(counts: DataFrame, clips: str = "clips", below: int = LONG_TAIL) -> DataFrame:
    """One row: speakers below the limit, their clips, and both as shares."""
    few = F.col(clips) < below
    sums = counts.agg(
        F.count(F.lit(1)).alias("speakers"), F.coalesce(F.sum(clips), F.lit(0)).alias("clips"),
        F.count_if(few).alias("tail_speakers"), F.coalesce(F.sum(F.when(few, F.col(clips))), F.lit(0)).alias("tail_clips"),
    )
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return sums.withColumn("tail_speaker_share", rate("tail_speakers", "speakers")).withColumn("tail_clip_share", rate("tail_clips", "clips"))


def by_speaker_category(df: DataFrame, speaker: str, category: str) -> DataFrame:
    """Speakers and clips by each speaker's most frequent category, unknown if it has none."""
    votes = category_votes(df, speaker, category)
    clips = votes.groupBy(speaker).agg(F.sum("n").alias("clips"))
    labelled = clips.join(majority(votes, speaker, category).select(speaker, "majority"), speaker, "left")
    return labelled.groupBy(F.coalesce("majority", F.lit("unknown")).alias("category")).agg(F.count(F.lit(1)).alias("speakers"), F.sum("clips").alias("clips"))


def metric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population statistics of each metric in long form; null for metrics without values. NaN counts as missing."""
    clean = df.select(*(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns))
    f = (("n", F.count), ("mean", F.avg), ("std", F.stddev_pop), ("least", F.min), ("most", F.max))
    wide = clean.agg(*(g(c).alias(f"{c}_{n}") for c in columns for n, g in f))
    return wide.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), *(F.col(f"{c}_{n}").alias(n) for n, _ in f)) for c in columns))))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact interpolated medians of the whole table; null for metrics without values. NaN counts as missing.

    All metrics' values are counted in long form, and the (metric, value) counts cut into sorted ranges. Each range's total tells in which one a median's
    two middle rows lie, so only numbers for each range meet, and no task gets all values of a metric, however continuous it is.
    """
    scratch = Scratch(df.sparkSession, "medians")
    long = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns))))
    counts = long.filter("v is not null and not isnan(v)").groupBy("metric", "v").agg(F.count(F.lit(1)).alias("n"))
    kept = scratch.keep(counts.repartitionByRange("metric", "v").withColumn("part", F.spark_partition_id()))
    sizes = kept.groupBy("metric", "part").agg(F.sum("n").alias("n")).collect()  # a row for each range and metric
    total: dict[str, int] = {}
    starts = []
    for r in sorted(sizes, key=lambda r: (r["metric"], r["part"])):
        starts.append((r["metric"], r["part"], total.get(r["metric"], 0), r["n"]))
        total[r["metric"]] = total.get(r["metric"], 0) + r["n"]
    # 0-based places of the two middle rows; one range holds each
    middle = [(m, p, before, at) for m, p, before, n in starts for at in {(total[m] - 1) // 2, total[m] // 2} if before <= at < before + n]
    wanted = df.sparkSession.createDataFrame(middle, "metric string, part int, before long, at long")
    upto = F.sum("n").over(Window.partitionBy("metric", "part", "at").orderBy("v"))
    placed = kept.join(F.broadcast(wanted), ["metric", "part"]).withColumn("end", F.col("before") + upto)
    two = placed.filter((F.col("at") < F.col("end")) & (F.col("at") >= F.col("end") - F.col("n"))).groupBy("metric").agg(F.avg("v").alias("median"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "metric string")
    return names.join(F.broadcast(two), "metric", "left")


def duration_buckets(df: DataFrame, duration: str, edges: Sequence[float] = DURATIONS) -> DataFrame:
    """One row: clips by half-open duration bucket, and those without a duration."""
    d = F.col(duration)
    known = d.isNotNull() & ~F.isnan(d)
    names = [f"under_{edges[0]:g}", *(f"from_{a:g}_to_{b:g}" for a, b in zip(edges, edges[1:], strict=False)), f"from_{edges[-1]:g}"]
    tests = [d < edges[0], *((d >= a) & (d < b) for a, b in zip(edges, edges[1:], strict=False)), d >= edges[-1]]
    return df.agg(*(F.count_if(known & t).alias(n) for n, t in zip(names, tests, strict=True)), F.count_if(~known).alias("unknown"))


def fixed_distribution(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """One row: counts of just the given values; others are left out without a word."""
    return df.agg(*(F.count_if(F.col(column) == k).alias(k.lower()) for k in keys))


def dominant_category(df: DataFrame, speaker: str, category: str, confidence: str) -> DataFrame:
    """Of each speaker: counts of Female, Male, Unknown and ERROR labels, the dominant one (Female on a tie), its share of known ones, mean confidence of scored clips and flags."""
    is_ = lambda k: (F.col(category) == k).cast("long")
    scored = F.when(F.coalesce(F.col(category) != "ERROR", F.lit(True)), F.col(confidence))
    rows = df.filter(F.col(speaker).isNotNull()).select(speaker, is_("Female").alias("f"), is_("Male").alias("m"), is_("Unknown").alias("u"), is_("ERROR").alias("e"), scored.alias("s"))
    spec = {"total": ("rows", None), "female": ("sum", "f"), "male": ("sum", "m"), "unknown": ("sum", "u"), "errors": ("sum", "e"), "mean_confidence": ("avg", "s")}
    per = salted_aggregate(rows, speaker, spec).na.fill(0, ["female", "male", "unknown", "errors"])
    f, m, total = F.col("female"), F.col("male"), F.col("total")
    flags = F.concat_ws(" ", F.when(F.col("unknown") / total > 0.15, "HIGH_UNKNOWN"), F.when((f > 0) & (m > 0) & (F.least(f, m) / total > 0.20), "SPLIT"))
    share = F.greatest(f, m) / F.greatest(total - F.col("unknown") - F.col("errors"), F.lit(1))
    return per.withColumn("dominant", F.when(f >= m, "Female").otherwise("Male")).withColumn("dominant_share", share).withColumn("flags", flags)
