"""Queries that send whole tables through each sink and read them back by its source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.operators.metadata import value_counts
from clipwright.operators.schema import drop_if_there, require_columns, require_rows, select_in_order
from clipwright.operators.vectors import usable
from clipwright.plans.tables import table
from clipwright.sources.readers import list_audio, read_checkpoint, read_csv, read_document, read_lines, read_splits, read_table, source_signature
from clipwright.sources.writers import append_checkpoint, promote, write_by_class, write_csv, write_report, write_splits, write_text, write_wavs
from clipwright.storage import shared_dir


def _place(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/exchange-{uuid.uuid4().hex[:12]}"


def csv_trip(spark: SparkSession, d: str) -> DataFrame:
    """Ids and labels through CSV: nulls and empty strings are both an empty field, which is read as null; blanks at the ends stay."""
    place = _place(spark)
    write_csv(table(spark, d, "clips_annotated").select("row_id", "source_id", "source_speaker_id", "gender"), place, single=False)
    return read_csv(spark, place, "row_id long, source_id string, source_speaker_id string, gender string")


def splits_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table written as a folder for each split and read as one again."""
    place = _place(spark)
    write_splits(table(spark, d, "clips_split").select("row_id", "source_id", "split").filter("split is not null"), place)
    return read_splits(spark, {s: f"{place}/split={s}" for s in ("train", "validation", "test")}).select("row_id", "source_id", "split")


def promote_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table that is replaced by a part of itself."""
    place = _place(spark)
    promote(table(spark, d, "clips_split").select("row_id", "source_id"), place)
    promote(read_table(spark, place).filter("row_id % 2 = 0"), place)
    return read_table(spark, place, "row_id long, source_id string")


def report_trip(spark: SparkSession, d: str) -> DataFrame:
    """Clips by split through a JSON report; the null split keeps its field."""
    place = _place(spark)
    write_report(value_counts(table(spark, d, "clips_annotated"), "split", nulls=True), place)
    return spark.read.schema("value string, n long").json(place)


def document_defaults(spark: SparkSession, d: str) -> DataFrame:
    """A number from a JSON document that is there and from one that isn't, 0 then."""
    place = _place(spark)
    write_report(table(spark, d, "clips_split").agg(F.struct(F.count(F.lit(1)).alias("rows")).alias("clips")), place)
    read = lambda name, path: read_document(spark, path, "clips struct<rows:long>").select(F.lit(name).alias("document"), F.coalesce("clips.rows", F.lit(0)).alias("rows"))
    return read("there", place).unionByName(read("missing", place + "-none"))


def lines_trip(spark: SparkSession, d: str) -> DataFrame:
    """Ids through text lines."""
    place = _place(spark)
    write_text(table(spark, d, "clips_split").filter("source_id is not null"), "source_id", place)
    return read_lines(spark, place).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def checkpoint_trip(spark: SparkSession, d: str) -> DataFrame:
    """Of two inputs' results in one checkpoint those of the first."""
    place, clips = _place(spark), table(spark, d, "clips_split").select("row_id", "source_id")
    mine, other = clips.filter("row_id % 3 = 0"), clips.filter("row_id % 3 = 1")
    for part in (mine, other):
        append_checkpoint(part, place, source_signature(part, "source_id", "row_id"))
    return read_checkpoint(spark, place, source_signature(mine, "source_id", "row_id"))


def class_folders(spark: SparkSession, d: str) -> DataFrame:
    """Clips by the folder of their class."""
    place = _place(spark)
    write_by_class(table(spark, d, "clip_voice").select("row_id", "gender_predicted"), place, "gender_predicted")
    return read_table(spark, place).groupBy("gender_predicted").agg(F.count(F.lit(1)).alias("clips"))


def wav_files(spark: SparkSession, d: str) -> DataFrame:
    """Voices' vectors written as WAV files and listed."""
    place = _place(spark)
    require_rows(write_wavs(usable(table(spark, d, "clip_voice")).select("row_id", "embedding", F.lit(8000).alias("rate")), place, name="row_id", samples="embedding", rate="rate").filter("ok"), "WAV files")
    names = F.regexp_extract("path", r"([0-9]+)\.wav$", 1).cast("long")
    return list_audio(spark, place).select(names.alias("row_id"), "length")


def published_columns(spark: SparkSession, d: str) -> DataFrame:
    """Needed columns checked, others dropped if they are there, the rest in order."""
    clips = require_columns(table(spark, d, "clips_split"), ["source_id", "transcription"])
    return select_in_order(drop_if_there(clips, "loaded_at", "audio", "no_such_column"), ["row_id", "source_id", "speaker_idx", "has_punctuation"])


QUERIES = {f.__name__: f for f in (csv_trip, splits_trip, promote_trip, report_trip, document_defaults, lines_trip, checkpoint_trip, class_folders, wav_files, published_columns)}

SQL = {
    "csv_trip": "SELECT row_id, nullif(source_id, '') AS source_id, nullif(source_speaker_id, '') AS source_speaker_id, nullif(gender, '') AS gender FROM clips_annotated",
    "splits_trip": "SELECT row_id, source_id, split FROM clips_split WHERE split IS NOT NULL",
    "promote_trip": "SELECT row_id, source_id FROM clips_split WHERE row_id % 2 = 0",
    "report_trip": "SELECT split AS value, count(*) AS n FROM clips_annotated GROUP BY 1",
    "document_defaults": "SELECT 'there' AS document, count(*) AS rows FROM clips_split UNION ALL SELECT 'missing', 0",
    "lines_trip": "SELECT source_id AS line, count(*) AS n FROM clips_split WHERE source_id IS NOT NULL GROUP BY 1",
    "checkpoint_trip": "SELECT row_id, source_id FROM clips_split WHERE row_id % 3 = 0",
    "class_folders": "SELECT gender_predicted, count(*) AS clips FROM clip_voice GROUP BY 1",
    # a head of 44 bytes and 64 samples of 4
    "wav_files": """SELECT row_id, 300::BIGINT AS length FROM (SELECT row_id, list_transform(embedding, lambda e: e::DOUBLE) AS e FROM clip_voice WHERE coalesce(embedding_ok, true) AND embedding IS NOT NULL)
        WHERE NOT isnan(list_dot_product(e, e)) AND list_dot_product(e, e) > 0""",
    "published_columns": "SELECT row_id, source_id, speaker_idx, has_punctuation FROM clips_split",
}
