"""Capping records per dominant contributor.

A contributor over the cap has its slots split over strata (topics, periods) by largest-remainder apportionment, slots
a stratum can't fill are dealt to the others the same way, and inside each stratum the best records by quality stay.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.operators.ranking import ranked
from clipwright.operators.skew import heavy_keys, salted_join
from clipwright.storage import Scratch


def apportion(slots: int, weights: Sequence[float]) -> list[int]:
    """Largest remainder: whole slots in proportion to weights, left-over ones to the largest fractions, earlier ones first."""
    total = sum(weights)
    if slots <= 0 or total <= 0:
        return [0] * len(weights)
    exact = [slots * w / total for w in weights]
    out = [int(x) for x in exact]
    order = sorted(range(len(weights)), key=lambda i: (out[i] - exact[i], i))
    for i in order[: slots - sum(out)]:
        out[i] += 1
    return out


def quotas(slots: int, sizes: Sequence[int], weights: Sequence[float]) -> list[int]:
    """``apportion`` limited by ``sizes``; spare slots go round again over strata with room. All slots are dealt if the sizes allow."""
    got = [0] * len(sizes)
    left = min(slots, sum(sizes))
    while left > 0:
        room = [i for i in range(len(sizes)) if sizes[i] > got[i]]
        w = [weights[i] for i in room]
        share = apportion(left, w if sum(w) > 0 else [1.0] * len(room))
        for i, x in zip(room, share, strict=True):
            take = min(x, sizes[i] - got[i])
            got[i] += take
            left -= take
    return got


def latest(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Of each ``key`` the row that is last by ``by`` (nulls count as earliest). Partial aggregation, so a key with many copies is no hot spot. Null keys are one key."""
    cols = [c for c in df.columns if c != key]
    best = df.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*cols), F.struct(*by)).alias("_row"))
    return best.select(F.col("_key").alias(key), *(F.col("_row")[c].alias(c) for c in cols)).select(df.columns)


def cap_contributors(
    df: DataFrame, *, contributor: Column, quality: Column, record: str, max_share: float | None = None, max_count: int | None = None,
    strata: Column | None = None, weighting: str = "size", kept: str = "kept",
) -> DataFrame:
    """``df`` with a boolean ``kept``: false for records beyond their contributor's cap.

    The cap is ``max_count``, or ``max_share`` of the rows rounded down (rows of ``df`` should have one ``record`` each: see ``latest``).
    A null contributor expression means no cap. With ``strata`` the cap is split over a contributor's strata by ``weighting``: "size" (records
    in the stratum) or "equal". Null strata are one stratum. Inside a stratum the highest quality stays, null and NaN
    last, then the smallest ``record`` (nulls first); fully equal rows stay in no given order but in the right number.
    An empty table gives no rows. Contributors under the cap are not ranked; large ones are ranked in pieces.
    """
    if (max_share is None) == (max_count is None):
        raise ValueError("give max_share or max_count")
    if weighting not in ("size", "equal"):
        raise ValueError("weighting is size or equal")
    scratch = Scratch(df.sparkSession, "cap")
    who = contributor.cast("string")
    stratum = F.coalesce(strata.cast("string"), F.lit("\0")) if strata is not None else F.lit("")
    value = quality.cast("double")
    rows = scratch.keep(df.select(*(F.col(f"`{c}`") for c in df.columns), who.alias("_who"), stratum.alias("_stratum"), F.when(~F.isnan(value), value).alias("_quality")))
    cap = max_count if max_count is not None else int(rows.count() * max_share + 1e-9)
    if cap < 0:
        raise ValueError("the cap is negative")
    sizes = rows.filter("_who is not null").groupBy("_who", "_stratum").agg(F.count(F.lit(1)).alias("n"))
    over = sizes.groupBy("_who").agg(F.sum("n").alias("all")).filter(F.col("all") > cap).select("_who")

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_stratum")
        n = [int(x) for x in pdf["n"]]
        return pd.DataFrame({"_who": pdf["_who"], "_stratum": pdf["_stratum"], "_quota": quotas(cap, n, n if weighting == "size" else [1.0] * len(n))})

    # one row for each stratum of a contributor, not for each record
    dealt = scratch.keep(sizes.join(over, "_who", "left_semi").groupBy("_who").applyInPandas(deal, "_who string, _stratum string, _quota long"))
    dealt = dealt.withColumn("_cell", F.concat_ws("\1", "_who", "_stratum")).select("_cell", "_quota")
    cell = F.concat_ws("\1", "_who", "_stratum")
    # the table of quotas grows with the contributors over the cap, so Spark picks the join; large cells and rows without a contributor are spread in any case
    celled = rows.withColumn("_cell", F.when(F.col("_who").isNotNull(), cell))
    marked = salted_join(celled, dealt, "_cell", heavy=heavy_keys(celled.select("_cell"), "_cell"), how="left")
    order = [F.col("_quality").isNull(), -F.coalesce("_quality", F.lit(0.0)), F.col(record)]
    limited = scratch.keep(marked.filter("_quota is not null"))
    placed = ranked(limited, "_cell", order, "_rank").withColumn(kept, F.col("_rank") <= F.col("_quota"))
    free = marked.filter("_quota is null").withColumn(kept, F.lit(True))
    out = [*(F.col(f"`{c}`") for c in df.columns if c != kept), F.col(kept)]
    return placed.select(out).unionByName(free.select(out))
