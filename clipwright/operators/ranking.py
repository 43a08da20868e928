"""Exact row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwright.operators.skew import SHARE, heavy_keys

PIECES = 64
SAMPLE_ROWS = 20_000


def ranked(df: DataFrame, group: str, order: list[Column], name: str, *, share: float = SHARE, pieces: int = PIECES) -> DataFrame:
    """Add ``name``, the 1-based position of each row in its ``group`` by ``order`` (ascending; nulls first).

    ``order`` should be unique within a group; rows that tie get adjacent positions in no given order. Groups above ``share`` of
    all rows are cut at split points into ``pieces`` that are sorted apart, and each piece starts after the rows of those
    before it, so no task holds a whole large group. Split points come from a hash sample of about ``SAMPLE_ROWS``
    keys; they balance the pieces and can't change a position. ``df`` is read three times if it has large groups: pass a
    written table. Null groups count as a group. Empty input gives no rows.
    """
    base = df.withColumn("_k", F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))).withColumn("_g", F.coalesce(F.col(group).cast("string"), F.lit("\0")))
    heavy = heavy_keys(base, "_g", share)
    plain = Window.partitionBy("_g").orderBy("_k")
    if not heavy:
        return base.withColumn(name, F.row_number().over(plain)).drop("_k", "_g")
    large = base.filter(F.col("_g").isin(heavy)).select("_g", "_k")
    n = large.count()
    sample = large.filter(F.pmod(F.xxhash64("_k"), F.lit(max(1, n // SAMPLE_ROWS))) == 0)
    place = Window.partitionBy("_g").orderBy("_k")
    every = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)).over(Window.partitionBy("_g")) / F.lit(pieces)))
    # at most 1 / share groups, each of at most `pieces` split points
    cuts = sample.withColumn("_r", F.row_number().over(place)).withColumn("_e", every).filter(F.col("_r") % F.col("_e") == 0).groupBy("_g").agg(F.array_sort(F.collect_list("_k")).alias("_cuts"))
    kinds = cuts.schema
    fixed = df.sparkSession.createDataFrame(cuts.collect(), kinds)
    cut = base.join(F.broadcast(fixed), "_g", "left").withColumn("_piece", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_k"))), F.lit(0))).drop("_cuts")
    sizes = cut.filter(F.col("_g").isin(heavy)).groupBy("_g", "_piece").agg(F.count(F.lit(1)).alias("_n")).collect()
    before: dict = {}
    offsets = []
    for r in sorted(sizes, key=lambda r: (r["_g"], r["_piece"])):
        offsets.append((r["_g"], r["_piece"], before.get(r["_g"], 0)))
        before[r["_g"]] = before.get(r["_g"], 0) + r["_n"]
    starts = df.sparkSession.createDataFrame(offsets, "_g string, _piece int, _start long")
    inner = Window.partitionBy("_g", "_piece").orderBy("_k")
    return (
        cut.withColumn(name, F.row_number().over(inner))
        .join(F.broadcast(starts), ["_g", "_piece"], "left")
        .withColumn(name, (F.col(name) + F.coalesce("_start", F.lit(0))).cast("long"))
        .drop("_k", "_g", "_piece", "_start")
    )
