"""Work on keys of which a handful hold most records.

``heavy_keys`` finds the keys above a share of all rows; at most ``1 / share`` keys can be, so the list has a proven
bound and may be collected and broadcast. ``salted_aggregate`` and ``salted_join`` spread just those keys. Salts are
taken from a hash of the row's own values, never from a random generator: a task that is run again after the loss of
an executor gives every row the same salt, and rows that differ spread as evenly as with random numbers. Rows that
don't differ are merged before the shuffle by partial aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

SHARE = 1 / 200
SALTS = 32
MERGEABLE = ("count", "rows", "sum", "min", "max", "avg", "count_distinct")


def key_profile(df: DataFrame, key: str, share: float = SHARE) -> tuple[int, int, list]:
    """(rows, rows with a null key, heavy keys) in one pass without a shuffle of keys: tasks keep sketches of their frequent items, which are merged.

    Heavy keys are the non-null ones that hold more than ``share`` of all rows: at most ``1 / share`` values. A sketch holds 20 times as many items
    as can be above the share, so none of these is missed; in tables of more different keys than that, a key slightly below the share may come out too.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    most = math.ceil(1 / share)
    binary = isinstance(df.schema[key].dataType, BinaryType)
    k = f"hex(`{key}`)" if binary else f"`{key}`"
    top = F.expr(f"approx_top_k({k}, {most + 1}, {min(1_000_000, 20 * most + 100)})")  # nulls may be one of the items
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("named"), top.alias("top")).first()
    found = [x["item"] for x in r["top"] or () if x["item"] is not None and x["count"] > r["n"] * share]
    return r["n"], r["n"] - r["named"], [bytes.fromhex(x) for x in found] if binary else found


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Non-null keys that hold more than ``share`` of all rows (see ``key_profile``). Empty input: none."""
    return key_profile(df, key, share)[2]


def _is_heavy(key: Column, heavy: list) -> Column:
    return F.coalesce(key.isin(heavy), F.lit(False)) if heavy else F.lit(False)


def salted_aggregate(
    df: DataFrame, key: str, aggregates: Mapping[str, tuple[str, str | None]], *, share: float = SHARE, salts: int = SALTS, heavy: list | None = None
) -> DataFrame:
    """Per-key aggregates in two stages: heavy keys get a salt, partial results are made per (key, salt), then merged by key.

    ``aggregates`` maps an output name to (kind, column); kinds: ``rows`` (column None), ``count`` (non-null), ``sum``,
    ``min``, ``max``, ``avg`` and ``count_distinct`` (non-null values; of one column at most, whose hash is then the
    salt, so that equal values meet under one salt and the distinct counts of the salts add up).

    Null keys form one group, as in GROUP BY, and are salted always. Empty input gives no rows. Other columns of ``df`` are ignored;
    they may have any names. NaN follows Spark: equal to itself, above all numbers.
    """
    kinds = {kind for kind, _ in aggregates.values()}
    if unknown := kinds - set(MERGEABLE):
        raise ValueError(f"unknown aggregate kinds: {sorted(unknown)}")
    distinct = {c for kind, c in aggregates.values() if kind == "count_distinct"}
    if len(distinct) > 1:
        raise ValueError("count_distinct is possible for one column")
    value = next(iter(distinct), None)
    used = list(dict.fromkeys(c for _, c in aggregates.values() if c))
    slim = df.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(used)))
    name = {c: f"_c{i}" for i, c in enumerate(used)}
    if heavy is None:
        heavy = heavy_keys(slim, "_key", share)
    by = [F.col(name[value])] if value else [F.col(c) for c in name.values()] or [F.lit(0)]
    salt = F.when(F.col("_key").isNull() | _is_heavy(F.col("_key"), heavy), F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    rows = slim.withColumn("_salt", salt)

    first, merge, last = [], [], []
    for i, (out, (kind, c)) in enumerate(aggregates.items()):
        p, col = f"_p{i}", F.col(name[c]) if c else None
        if kind == "rows":
            first.append(F.count(F.lit(1)).alias(p)), merge.append(F.sum(p).alias(p)), last.append(F.col(p).alias(out))
        elif kind == "count":
            first.append(F.count(col).alias(p)), merge.append(F.sum(p).alias(p)), last.append(F.col(p).alias(out))
        elif kind in ("sum", "min", "max"):
            f = getattr(F, kind)
            first.append(f(col).alias(p)), merge.append(f(p).alias(p)), last.append(F.col(p).alias(out))
        elif kind == "avg":
            first += [F.sum(col.cast("double")).alias(p), F.count(col).alias(p + "n")]
            merge += [F.sum(p).alias(p), F.sum(p + "n").alias(p + "n")]
            last.append(F.when(F.col(p + "n") > 0, F.col(p) / F.col(p + "n")).alias(out))
        else:
            last.append(F.col("_distinct").alias(out))
    if value:
        # one row for each value under its salt; copies of a row end here, on the map side already
        rows = rows.groupBy("_key", "_salt", F.col(name[value]).alias("_v")).agg(*(first or [F.lit(0).alias("_none")]))
        partial = rows.groupBy("_key", "_salt").agg(F.count("_v").alias("_distinct"), *merge)
        merge = [F.sum("_distinct").alias("_distinct"), *merge]
    else:
        partial = rows.groupBy("_key", "_salt").agg(*first)
    return partial.groupBy("_key").agg(*merge).select(F.col("_key").alias(key), *last)


def salted_join(big: DataFrame, small: DataFrame, key: str, *, heavy: list, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join on ``key`` where ``heavy`` keys of ``big`` are spread over ``salts`` tasks and their rows of ``small`` repeated for each.

    ``how``: inner, left (all rows of ``big``), left_semi or left_anti. Null keys match nothing; where their rows stay they are spread too, as a
    shuffle would send them all to one task. Without heavy keys an inner or semi join is a plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how can't be {how}")
    keeps_nulls = how in ("left", "left_anti")
    if not heavy and not keeps_nulls:
        return big.join(small, key, how)
    spread = _is_heavy(F.col(key), heavy)
    if keeps_nulls:
        spread = spread | F.col(key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in big.columns)), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(_is_heavy(F.col(key), heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = small.withColumn("_join_salt", F.explode(copies) if heavy else F.lit(0))
    return big.withColumn("_join_salt", salt).join(copied, [key, "_join_salt"], how).drop("_join_salt")
