"""Embeddings: norms, centroids, nearest centroid, rescue of noise."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import heavy_keys, salted_join
from clipwright.storage import Scratch

TINY = 1e-10


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: str | Column, b: str | Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(TINY))


def l2_normalized(a: str | Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / (n + F.lit(TINY)))


def usable(df: DataFrame, vector: str = "embedding", ok: str | None = "embedding_ok") -> DataFrame:
    """Rows whose vector isn't null, flagged as failed, zero or holding NaN."""
    rows = df.filter(F.coalesce(F.col(ok), F.lit(True))) if ok else df
    n = norm(vector)
    return rows.filter(F.col(vector).isNotNull() & n.isNotNull() & ~F.isnan(n) & (n > 0))


def centroids(df: DataFrame, cluster: str, vector: str, dims: int) -> DataFrame:
    """(cluster, centroid, members): mean of the vectors brought to length one. One sum for each dimension, combined before the shuffle."""
    rows = df.filter(F.col(cluster).isNotNull() & F.col(vector).isNotNull())
    means = rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("members"), *(F.avg(F.col(vector)[i].cast("double")).alias(f"m{i}") for i in range(dims)))
    return means.select(cluster, l2_normalized(F.array(*(F.col(f"m{i}") for i in range(dims)))).alias("centroid"), "members")


def cosine_to_own(df: DataFrame, cents: DataFrame, cluster: str, vector: str) -> DataFrame:
    """Each clustered row with the cosine to its centroid."""
    return salted_join(df, cents.select(cluster, "centroid"), cluster, heavy=heavy_keys(df, cluster)).withColumn("cosine", cosine(vector, "centroid")).drop("centroid")


def _best_of(x: np.ndarray, c: np.ndarray, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Place and cosine of each row's nearest column vector; place -1 where none is allowed."""
    size = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(c, axis=1)[None]
    cos = (x @ c.T) / (size + TINY)
    if allowed is not None:
        cos[~allowed] = -np.inf
    at = cos.argmax(axis=1)
    best = cos[np.arange(len(x)), at]
    return np.where(np.isfinite(best), at, -1), best


def _updater(shared: Broadcast, grouped: bool) -> Callable:
    """The best of a row so far and of a block of centroids (names in order, vectors, groups)."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names, c, groups = shared.value
        for v, g, old, cos in batches:
            best, at = cos.to_numpy(np.float64, copy=True), list(old)
            some = np.flatnonzero(v.notna().to_numpy())
            if len(some) and len(names):
                x = np.stack([np.asarray(e, np.float64) for e in v.iloc[some]])
                allowed = None
                if grouped:
                    own = g.iloc[some].to_numpy(object)
                    allowed = (own[:, None] == groups[None]) | (own == "Unknown")[:, None]
                place, found = _best_of(x, c, allowed)
                for i, p, f in zip(some, place, found, strict=True):
                    if p >= 0 and (np.isnan(best[i]) or f > best[i] or (f == best[i] and names[p] < at[i])):
                        best[i], at[i] = f, names[p]
            yield pd.DataFrame({"c": pd.Series(at, dtype=object), "q": pd.Series([None if np.isnan(b) else b for b in best], dtype=object)})

    return run


def _nearest(items: DataFrame, cents: DataFrame, vector: str, cluster: str, group: str | None, most: int) -> DataFrame:
    """Items with ``nearest`` and ``cosine``: one matrix product for each Arrow batch with a broadcast block of at most some ``most`` centroids.

    More centroids are taken block by block; each pass hands the best so far on to the next through a written table, so one block at a time is in memory.
    """
    spark = items.sparkSession
    used = cents.select(F.col(cluster).alias("c"), F.col("centroid").cast("array<double>").alias("v"), (F.col(group) if group else F.lit(None)).cast("string").alias("g")).filter("v is not null")
    blocks = max(1, math.ceil(used.count() / most))
    kind = used.schema["c"].dataType.simpleString()
    out = items.withColumn("nearest", F.lit(None).cast(kind)).withColumn("cosine", F.lit(None).cast("double"))
    scratch = Scratch(spark, "nearest")
    for k in range(blocks):
        part = used.filter(F.pmod(F.xxhash64("c"), F.lit(blocks)) == k).collect() if blocks > 1 else used.collect()
        part.sort(key=lambda r: r["c"])
        shared = spark.sparkContext.broadcast(([r["c"] for r in part], np.asarray([r["v"] for r in part], np.float64), np.asarray([r["g"] for r in part], object)))

        udf = F.pandas_udf(_updater(shared, bool(group)), f"c {kind}, q double")  # type: ignore[call-overload]
        own_group = F.col(group).cast("string") if group else F.lit(None).cast("string")
        step = out.withColumn("_best", udf(F.col(vector), own_group, "nearest", "cosine"))
        out = step.withColumn("nearest", F.col("_best.c")).withColumn("cosine", F.col("_best.q")).drop("_best")
        if k < blocks - 1:
            out = scratch.keep(out)
            shared.unpersist()
    return out


def nearest_centroid(df: DataFrame, cents: DataFrame, vector: str, cluster: str, *, most: int = 10_000) -> DataFrame:
    """Each row with its nearest cluster (``nearest``) and the cosine; ties to the smaller id, null vectors have nulls. Centroids are broadcast ``most`` at a time."""
    return _nearest(df, cents, vector, cluster, None, most)


def rescue(noise: DataFrame, cents: DataFrame, vector: str, cluster: str, gender: str, *, least: float = 0.75, most: int = 10_000) -> DataFrame:
    """Noise rows with the nearest cluster of their gender (any for Unknown), and ``rescued`` if the cosine is at least ``least``. ``cents`` has ``gender`` of each cluster."""
    found = _nearest(noise, cents, vector, cluster, gender, most)
    return found.withColumn("rescued", F.coalesce(F.col("cosine") >= least, F.lit(False)))
