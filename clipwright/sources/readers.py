"""Readers: tables, splits, CSV, JSON documents, listings, audio files, text lines and checkpoints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipwright.operators.metadata import union_splits

AUDIO = ("wav", "flac", "ogg", "aif", "aiff")


def read_table(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Parquet; with a schema, columns are read by it and nothing is inferred. Columns that a query doesn't use (audio, say) aren't read."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_splits(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Several split folders as one table with ``split``."""
    return union_splits({name: read_table(spark, p) for name, p in paths.items()})


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and given types; ids stay strings, with their leading zeros and blanks at the ends. An empty field is null, one in quotes an empty string."""
    return spark.read.csv(path, header=True, schema=schema, escape='"', multiLine=True, nullValue="\0", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document as one row; a missing file gives a row of nulls, so that nested fields get their defaults by coalesce."""
    if exists(spark, path):
        return spark.read.schema(schema).json(path, multiLine=True)
    return spark.range(1).select(F.from_json(F.lit("{}"), schema).alias("d")).select("d.*")


def list_audio(spark: SparkSession, folder: str, extensions: tuple[str, ...] = AUDIO, *, content: bool = False) -> DataFrame:
    """(path, length[, content]) of audio files under a folder; file bytes are read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join([*extensions, *(e.upper() for e in extensions)]) + "}").load(folder)
    return files.select("path", "length", *(["content"] if content else []))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of text files; a last line without a line end counts."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_checkpoint(spark: SparkSession, path: str, signature: str) -> DataFrame | None:
    """Rows kept under ``signature``, or None if there is no such checkpoint: another input's results are never taken over."""
    if not exists(spark, path):
        return None
    rows = spark.read.parquet(path)
    if "source_signature" not in rows.columns:
        return None
    rows = rows.filter(F.col("source_signature") == signature).drop("source_signature")
    return None if rows.isEmpty() else rows


def source_signature(df: DataFrame, record: str, order: str) -> str:
    """A digest of the ids in their order that needs no list of them: hashes of (position, id), added up, with the count."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.col(order), F.col(record)).cast("decimal(20,0)")).alias("s")).first()
    return f"{r['n']}-{r['s']}"


def id_digest(df: DataFrame, record: str, order: str, group: str) -> DataFrame:
    """(group, digest): SHA-1 of the newline-joined ids of each group in order; for groups that fit one row."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(record).cast("string").alias("i")))), lambda s: s["i"])
    return df.groupBy(group).agg(F.sha1(F.array_join(ids, "\n")).alias("digest"))
