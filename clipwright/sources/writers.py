"""Writers: tables promoted in one step, splits, reports, audio files, archives and checkpoints."""

from __future__ import annotations

import hashlib
import os
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.functions.audio import encode_wav
from clipwright.storage import drop_path


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def promote(df: DataFrame, target: str, *, partition_by: tuple[str, ...] = ()) -> None:
    """Write beside ``target``, then swap: the old table becomes a backup, the new one takes its place, the backup goes.

    A table may be rewritten from itself, as it is read to the end before it is moved. If the swap fails the backup is put back.
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    fresh, backup = target + ".tmp", target + ".backup"
    for stale in (fresh, backup):
        drop_path(spark, stale)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(fresh)
    (t, fs), (f, _), (b, _) = _fs(spark, target), _fs(spark, fresh), _fs(spark, backup)
    had = fs.exists(t)
    if had and not fs.rename(t, b):
        raise OSError(f"can't move {target} aside")
    if not fs.rename(f, t):
        if had:
            fs.rename(b, t)
        raise OSError(f"can't move the new table to {target}")
    drop_path(spark, backup)


def write_splits(df: DataFrame, target: str) -> None:
    promote(df, target, partition_by=("split",))


def report_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text, with nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    """A small report (a row or a few) as one JSON-lines file."""
    report_json(df).coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, *, single: bool = True) -> None:
    """With a header; blanks at the ends of a field stay, which Spark would cut otherwise."""
    out = (df.coalesce(1) if single else df).write.mode("overwrite")
    out.csv(path, header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_wavs(df: DataFrame, folder: str, *, name: str, samples: str, rate: str) -> DataFrame:
    """(name, ok, error): each clip written as a float WAV file in a folder of a file system all executors reach; a failing row doesn't stop the others.

    ``folder`` is a path or a URI (file, hdfs, s3 and others). Files are written under a temporary name and moved, so a task that runs twice leaves whole files.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (LocalFileSystem(), os.path.abspath(folder))
        system.create_dir(root, recursive=True)
        for pdf in batches:
            rows = []
            for n, x, r in zip(pdf["n"], pdf["x"], pdf["r"], strict=True):
                try:
                    if x is None:
                        raise ValueError("no samples")
                    path = f"{root}/{os.path.basename(f'{n}.wav')}"
                    fresh = f"{path}.{uuid.uuid4().hex}"
                    with system.open_output_stream(fresh) as f:
                        f.write(encode_wav(x, int(r)))
                    system.move(fresh, path)
                    rows.append((n, True, None))
                except (OSError, ValueError, TypeError) as e:
                    rows.append((n, False, str(e)))
            yield pd.DataFrame(rows, columns=["name", "ok", "error"])

    return df.select(F.col(name).cast("string").alias("n"), F.col(samples).alias("x"), F.col(rate).alias("r")).mapInPandas(run, "name string, ok boolean, error string")


def write_by_class(df: DataFrame, target: str, column: str) -> None:
    """A folder for each class."""
    df.write.mode("overwrite").partitionBy(column).parquet(target)


def append_checkpoint(df: DataFrame, path: str, signature: str) -> None:
    """Results of one batch, marked with the input they belong to."""
    df.withColumn("source_signature", F.lit(signature)).write.mode("append").parquet(path)


def content_digest(content: str = "content"):  # noqa: ANN201
    return F.sha2(F.col(content), 256)


def zip_folder(folder: str, target: str) -> str:
    """A checked archive of a local folder, moved into place when whole; its SHA-256."""
    with zipfile.ZipFile(target + ".tmp", "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in sorted(os.walk(folder)):
            for f in sorted(files):
                z.write(os.path.join(root, f), os.path.relpath(os.path.join(root, f), folder))
    with zipfile.ZipFile(target + ".tmp") as z:
        if bad := z.testzip():
            raise OSError(f"damaged entry {bad}")
    os.replace(target + ".tmp", target)
    digest = hashlib.sha256()
    with open(target, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def remove_if_there(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        drop_path(spark, p)


def with_run_time(df: DataFrame, into: str = "run_at") -> DataFrame:
    """A report with the time of the run, the same for all its rows."""
    return df.withColumn(into, F.current_timestamp())


def _at(audit: Mapping, *path: str):  # noqa: ANN202
    for p in path:
        audit = audit.get(p) if isinstance(audit, Mapping) else None
    return audit


# What the card tells of earlier phases, by the place in their audits
CARD_AUDITS = (
    ("Clips before speakers were found", ("before", "total_clips")), ("Source speakers", ("before", "unique_speakers")), ("Speakers found", ("speakers", "count")),
    ("Clips taken back from noise", ("speakers", "rescued_clips")), ("Clips left as noise", ("speakers", "noise_after_rescue")), ("Clips levelled", ("loudness", "normalized")),
    ("Clips within the tolerance", ("loudness", "skipped_within_tolerance")), ("Clips whose loudness can't be measured", ("loudness", "failed_loudness_measurement")), ("Rows the gender model learnt from", ("gender_model", "rows")),
)


def dataset_card(df: DataFrame, title: str, *, audits: Mapping | None = None, speaker: str = "source_speaker_id", license: str = "cc-by-4.0", languages: Sequence[str] = ("sna",), tasks: Sequence[str] = ("automatic-speech-recognition",)) -> str:
    """A release note in Markdown with a header of features and splits: clips, speakers and hours by split and over all, genders, and what the audits of earlier phases tell ("not recorded" where they don't)."""
    some = lambda c: F.col(c) if c in df.columns else F.lit(None)
    hours = F.sum(F.nanvl(some("duration").cast("double"), F.lit(None).cast("double"))) / 3600
    figures = [F.count(F.lit(1)).alias("clips"), F.countDistinct(speaker).alias("speakers"), hours.alias("hours")]
    rows = df.groupBy("split").agg(*figures).orderBy(F.asc_nulls_last("split")).collect()
    whole = df.agg(*figures).first()
    genders = df.groupBy(F.coalesce(some("gender").cast("string"), F.lit("unknown")).alias("g")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "g").collect()
    head = ["---", "dataset_info:", "  features:", *(line for f in df.schema for line in (f"  - name: {f.name}", f"    dtype: {f.dataType.simpleString()}"))]
    head += ["  splits:", *(line for r in rows for line in (f"  - name: {r['split']}", f"    num_examples: {r['clips']}"))]
    for key, values in (("task_categories", tasks), ("language", languages)):
        head += [f"{key}:", *(f"- {v}" for v in values)]
    head += [f"license: {license}", "---"]
    line = lambda name, r: f"| {name} | {r['clips']} | {r['speakers']} | {r['hours'] or 0:.2f} |"
    body = [f"# {title}", "", "| split | clips | speakers | hours |", "| --- | --- | --- | --- |", *(line(r["split"], r) for r in rows), line("all", whole), ""]
    body += ["| gender | clips |", "| --- | --- |", *(f"| {r['g']} | {r['n']} |" for r in genders), ""]
    found = [(name, _at(audits or {}, *path)) for name, path in CARD_AUDITS]
    return "\n".join([*head, "", *body, *(f"- {name}: {'not recorded' if v is None else v}" for name, v in found), ""])
