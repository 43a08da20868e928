"""Frame masks and powers: smoothing, gap trimming and quality metrics, on one row for each clip with arrays in frame order.

A clip's frames are bounded by its length, so arrays keep each clip in one row and nothing is shuffled. Runs are found by
numpy kernels, as array functions would look at each run once for every frame; sums stay in the JVM. ``from_frames`` builds the
arrays from a table of frames.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.functions.audio import smooth, stays

MIN_SPEECH = 3
BRIDGE = 2
MAX_GAP = 5
KEEP_GAP = 3
FRAME_SECONDS = 0.03
TINY = 1e-10


def from_frames(df: DataFrame, clip: str, order: str, mask: Column, power: Column) -> DataFrame:
    """(clip, mask, power) arrays in frame order."""
    rows = df.groupBy(clip).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), mask.alias("m"), power.alias("p")))).alias("f"))
    return rows.select(clip, F.col("f.m").alias("mask"), F.col("f.p").alias("power"))


def _per_clip(df: DataFrame, mask: str, into: str, kernel: Callable[[np.ndarray], np.ndarray], kind: str) -> DataFrame:
    """A numpy kernel over each clip's mask, in Arrow batches; linear in the frames. Null masks stay null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda m: None if m is None else kernel(np.asarray(m, dtype=bool)))

    return df.withColumn(into, F.pandas_udf(run, f"array<{kind}>")(F.col(mask)))  # type: ignore[call-overload]


def smooth_mask(df: DataFrame, mask: str = "mask", into: str = "smooth", min_speech: int = MIN_SPEECH, bridge: int = BRIDGE) -> DataFrame:
    """Speech runs shorter than ``min_speech`` go, then gaps of at most ``bridge`` frames between speech are closed. Leading and trailing gaps stay."""
    return _per_clip(df, mask, into, lambda m: smooth(m, min_speech, bridge), "boolean")


def speech_bounds(df: DataFrame, mask: str = "mask", buffer: int = 13) -> DataFrame:
    """first and last speech frame, and the same widened by ``buffer`` frames inside the clip; null without speech."""
    n = F.size(mask)
    first = F.array_position(mask, F.lit(True)) - 1
    last = n - F.array_position(F.reverse(mask), F.lit(True))
    some = F.array_contains(mask, True)
    out = df.withColumn("first", F.when(some, first)).withColumn("last", F.when(some, last))
    return out.withColumn("from_frame", F.greatest(F.col("first") - buffer, F.lit(0))).withColumn("to_frame", F.least(F.col("last") + buffer, n - 1))


def kept_frames(df: DataFrame, mask: str = "mask", into: str = "kept", max_gap: int = MAX_GAP, keep: int = KEEP_GAP) -> DataFrame:
    """Frames that stay when each gap longer than ``max_gap`` is cut to its first ``keep`` frames: their numbers."""
    return _per_clip(df, mask, into, lambda m: np.flatnonzero(stays(m, max_gap, keep)).astype(np.int32), "int")


def gaps(df: DataFrame, mask: str = "mask", into: str = "gaps") -> DataFrame:
    """Lengths of the gaps between neighbouring speech frames, in order, without zero ones."""

    def inner(m: np.ndarray) -> np.ndarray:
        steps = np.diff(np.flatnonzero(m)) - 1
        return steps[steps > 0].astype(np.int32)

    return _per_clip(df, mask, into, inner, "int")


def quality(df: DataFrame, mask: str = "mask", power: str = "power", frame_seconds: float = FRAME_SECONDS) -> DataFrame:
    """speech_ratio, snr_db, quality_score and duration; all null for clips without speech.

    The noise floor is the mean of the quietest fifth of non-speech frames if there are at least four, else of the quietest tenth of all, with a penalty of 3.
    """
    zipped = F.zip_with(mask, power, lambda m, p: F.struct(m.alias("m"), p.cast("double").alias("p")))
    pick = lambda want: F.transform(F.filter(zipped, lambda x: x["m"] == F.lit(want)), lambda x: x["p"])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    n = F.size(mask)
    step = df.withColumn("_s", pick(True)).withColumn("_q", F.array_sort(pick(False)))
    few = F.size("_q") < 4
    count = F.greatest(F.lit(1), F.when(few, F.ceil(n * F.lit(0.1))).otherwise(F.ceil(F.size("_q") * F.lit(0.2)))).cast("int")
    source = F.when(few, F.array_sort(F.transform(power, lambda p: p.cast("double")))).otherwise(F.col("_q"))
    ratio = F.size("_s") / n
    some = F.size("_s") > 0
    step = step.withColumn("_floor", total(F.slice(source, 1, count)) / count).withColumn("_signal", total(F.col("_s")) / F.when(some, F.size("_s")))
    snr = F.lit(10.0) * F.log10((F.col("_signal") + TINY) / (F.col("_floor") + TINY))
    penalty = F.when(few, 3.0).otherwise(0.0) + F.when(ratio < 0.35, (F.lit(0.35) - ratio) * 20.0).otherwise(0.0) + F.when(ratio > 0.95, (ratio - F.lit(0.95)) * 40.0).otherwise(0.0)
    out = step.withColumn("speech_ratio", F.when(some, ratio)).withColumn("snr_db", F.when(some, snr)).withColumn("quality_score", F.when(some, snr - penalty))
    return out.withColumn("duration", F.when(some, n * F.lit(frame_seconds))).drop("_s", "_q", "_floor", "_signal")
