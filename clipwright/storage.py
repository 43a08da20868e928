"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that setting is absent (local tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="clipwright-")
        atexit.register(_remove, _OWN[app])
    return "file://" + _OWN[app]


def _remove(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system it lies in."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables written by one operator call. ``keep`` cuts lineage by writing Parquet; ``free`` deletes what is no longer read."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[self.n] = path
        out._cw_path = path  # type: ignore[attr-defined]
        return out

    def free(self, *dfs: DataFrame) -> None:
        for df in dfs:
            if path := getattr(df, "_cw_path", None):
                drop_path(self.spark, path)
                self.paths = {k: p for k, p in self.paths.items() if p != path}

    def free_all(self, *but: DataFrame) -> None:
        """Delete all tables but the given ones, once nothing reads the others any more."""
        kept = {getattr(df, "_cw_path", None) for df in but}
        for path in set(self.paths.values()) - kept:
            drop_path(self.spark, path)
        self.paths = {k: p for k, p in self.paths.items() if p in kept}
