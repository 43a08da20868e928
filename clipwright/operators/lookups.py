"""Joins of keyed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import heavy_keys, salted_join


def relabel(clips: DataFrame, mapping: DataFrame, key: str = "source_id") -> DataFrame:
    """Inner join; repeated keys multiply. AQE picks broadcast or shuffle by the size it measures."""
    return clips.join(mapping, key)


def last_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the last by ``order``; partial aggregation, so copies of a key don't meet in one task."""
    cols = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select(key, *(F.col("_r")[c].alias(c) for c in cols))


def lookup(df: DataFrame, table: DataFrame, key: str, defaults: Mapping[str, object], order: list[str]) -> DataFrame:
    """Left join of the last row of each key in ``table``, with a default for each field that is missing."""
    fields = last_of(table.select(key, *dict.fromkeys([*defaults, *order])), key, order).select(key, *(F.col(c).alias(f"_{c}") for c in defaults))
    joined = salted_join(df.drop(*defaults), fields, key, heavy=heavy_keys(df, key), how="left")
    return joined.withColumns({c: F.coalesce(F.col(f"_{c}"), F.lit(v)) for c, v in defaults.items()}).drop(*(f"_{c}" for c in defaults))


def lookup_by_file(df: DataFrame, earlier: DataFrame, path: str, defaults: Mapping[str, object], order: list[str]) -> DataFrame:
    """``df`` with what an earlier run found for a file of the same name, wherever it lay: the last row by ``order``, or the defaults. Null paths get the defaults."""
    name = F.element_at(F.split(path, "/"), -1)
    named = earlier.withColumn("_file", name).filter("_file is not null")
    return lookup(df.withColumn("_file", name), named, "_file", defaults, order).drop("_file")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in ``done``: what a resumed run has yet to do."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def only_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_semi")


def path_keys(path: Column) -> dict[str, Column]:
    """Keys held in a clip's path "<speaker folder>/sna_<id>[__tier-low|mid|high].wav"."""
    folder = F.element_at(F.split(path, "/"), -2)
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"\.wav$", "")
    source_id = F.regexp_replace(stem, "^sna_", "")
    rest = F.substring(F.regexp_extract(folder, r"^[^_]*_(.*)$", 1), 1, 8)
    prefix = F.when(folder.contains("_"), F.concat(F.split_part(folder, F.lit("_"), F.lit(1)), F.lit("_"), rest)).otherwise(F.substring(folder, 1, 10))
    return {
        "source_speaker_id": folder, "folder_prefix": prefix, "source_id": source_id,
        "base_source_id": F.regexp_replace(source_id, r"__tier-(low|mid|high)$", ""), "original_filename": name,
    }
