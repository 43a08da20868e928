"""Reproducible splits and samples, ordered by a hash of seed and id."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwright.operators.ranking import ranked
from clipwright.operators.skew import heavy_keys, salted_aggregate, salted_join
from clipwright.storage import Scratch


def shuffle_key(seed: int, record: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(record).cast("string")))


def _placed(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Rows with their position in the group and the group's size, without a task for all of a large group."""
    kept = Scratch(df.sparkSession, "placed").keep(df)
    heavy = heavy_keys(kept, group)
    sizes = salted_aggregate(kept, group, {"_size": ("rows", None)}, heavy=heavy).filter(F.col(group).isNotNull())
    return salted_join(ranked(kept, group, order, name), sizes, group, heavy=heavy)


def stratified_split(df: DataFrame, group: str, record: str, *, seed: int = 42, train: float = 0.8, validation: float = 0.1, into: str = "split") -> DataFrame:
    """Each group dealt to train, validation and test: whole parts of its size, the rest to test; single rows to train.

    Rows without a group are left out. Membership follows a hash of seed and record, so it doesn't depend on the order of rows.
    """
    rows = _placed(df.filter(F.col(group).isNotNull()).drop(into), group, [shuffle_key(seed, record), F.col(record)], "_r")
    n, r = F.col("_size"), F.col("_r")
    n_train, n_valid = F.floor(n * F.lit(train)), F.floor(n * F.lit(validation))
    split = F.when(n == 1, "train").when(r <= n_train, "train").when(r <= n_train + n_valid, "validation").otherwise("test")
    return rows.withColumn(into, split).select(*(f"`{c}`" for c in df.columns if c != into), into)


def replayed_positions(counts: list[tuple[str, int]], seed: int = 42) -> dict[str, list[int]]:
    """One generator over all groups in order: the positions of each, shuffled as a run with the same seed and order shuffled them. For tables that fit one machine."""
    rng = random.Random(seed)
    out = {}
    for g, n in counts:
        order = list(range(n))
        rng.shuffle(order)
        out[g] = order
    return out


def uniform_sample(df: DataFrame, record: str, n: int, *, seed: int = 42) -> DataFrame:
    """n rows without replacement: the smallest hashes. A bounded top-k, so it needs no full sort."""
    return df.orderBy(shuffle_key(seed, record), record).limit(n)


def sample_per_group(df: DataFrame, group: str, record: str, k: int, *, seed: int = 42) -> DataFrame:
    """k rows of each group; the rank limit is applied before the shuffle."""
    place = Window.partitionBy(group).orderBy(shuffle_key(seed, record), record)
    return df.withColumn("_r", F.row_number().over(place)).filter(F.col("_r") <= k).drop("_r")


def thirds(df: DataFrame, group: str, score: str, record: str, into: str = "tier") -> DataFrame:
    """low, mid, high by score: max(1, n // 3) lowest, the last n - max(b + 1, n - n // 3) highest, the others between. Not ntile, which cuts small groups otherwise."""
    rows = _placed(df.filter(F.col(group).isNotNull()), group, [F.col(score), F.col(record)], "_r")
    n = F.col("_size")
    low = F.greatest(F.lit(1), F.floor(n / 3))
    high = F.greatest(low + 1, n - F.floor(n / 3))
    return rows.withColumn(into, F.when(F.col("_r") <= low, "low").when(F.col("_r") <= high, "mid").otherwise("high")).drop("_r", "_size")


def sample_thirds(df: DataFrame, group: str, score: str, record: str, *, shares: tuple[int, int, int] = (6, 8, 6), total: int = 20, seed: int = 42) -> DataFrame:
    """From each group ``shares`` rows of its low, mid and high third, topped up to ``total`` from what is left."""
    tiers = thirds(df, group, score, record)
    share = F.when(F.col("tier") == "low", shares[0]).when(F.col("tier") == "mid", shares[1]).otherwise(shares[2])
    per_tier = Window.partitionBy(group, "tier").orderBy(shuffle_key(seed, record), record)
    # at most `total` rows of a tier can be taken, by share or as top-up
    few = tiers.withColumn("_t", F.row_number().over(per_tier)).filter(F.col("_t") <= total)
    first = few.withColumn("_extra", (F.col("_t") > share).cast("int"))
    overall = Window.partitionBy(group).orderBy("_extra", shuffle_key(seed, record), record)
    return first.withColumn("_r", F.row_number().over(overall)).filter(F.col("_r") <= total).drop("_t", "_extra", "_r")
