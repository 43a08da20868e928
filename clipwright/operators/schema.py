"""Column contracts between stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of a published clip, in order
PUBLISHED = (
    "audio", "transcription", "source_id", "source_speaker_id", "speaker_idx", "speaker_clip_count", "language", "gender",
    "has_punctuation", "snr_db", "speech_ratio", "quality_score", "duration",
)
# The columns and types of the annotated release
ANNOTATED = {
    "transcription": "string", "source_id": "string", "speaker_id": "int", "speaker_clip_count": "int", "language": "string", "gender": "string",
    "has_punctuation": "boolean", "snr_db": "float", "speech_ratio": "float", "quality_score": "float", "duration": "float", "speaker_assignment_confidence": "float",
}


class MissingColumns(ValueError):
    """A stage got a table without columns it needs."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise MissingColumns(f"missing columns: {missing}")
    return df


def rename_source(df: DataFrame) -> DataFrame:
    """id → source_id (if there is one) and speaker_id → source_speaker_id."""
    return df.withColumnsRenamed({"id": "source_id", "speaker_id": "source_speaker_id"})


def drop_if_there(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def select_in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return require_columns(df, columns).select(*columns)


def cast_to(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns of ``types`` only, cast, in that order."""
    return require_columns(df, list(types)).select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float and double columns with null for NaN; other columns as they are."""
    kinds = dict(df.dtypes)
    clean = {c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(kinds[c])) for c in df.columns if kinds[c] in ("float", "double")}
    return df.select(*((clean[c].alias(c)) if c in clean else F.col(f"`{c}`") for c in df.columns))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raises if there is no row; reads at most one."""
    if df.isEmpty():
        raise ValueError(f"no rows left: {what}")
    return df


def rows_between(df: DataFrame, row_id: str, start: int, stop: int) -> DataFrame:
    """Rows by stored position: Spark's rows have no position of their own."""
    return df.filter((F.col(row_id) >= start) & (F.col(row_id) < stop))
