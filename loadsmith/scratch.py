"""Scratch tables in the folder that ``spark.checkpoint.dir`` names.

Written tables cut the lineage, are computed once and survive lost executors, since
the folder is shared by the cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_collected: ContextVar[list[str] | None] = ContextVar("scratch_folders", default=None)


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    from loadsmith.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loadsmith-{name}-{uuid.uuid4().hex}"
    if (paths := _collected.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, every folder that ``scratch_path`` (and so ``materialize``) gave out in it.

    Write the result of an operator inside the block; a frame that is computed later would miss them.
    """
    paths: list[str] = []
    outer = _collected.set(paths)
    try:
        yield
    finally:
        _collected.reset(outer)
        for path in paths:
            remove(spark, path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; it stays there unless
    ``scratch_removed`` stands around the call."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Scratch tables of one run, removed when it ends:  ``with Scratch(spark) as keep: ...``"""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self):
        return self.table

    def table(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *failure) -> None:
        for path in self.paths:
            remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder (any file system that Spark can write to)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def remove_all(spark: SparkSession, paths: list[str]) -> None:
    """Delete many folders of one file system, some at a time."""
    if not paths:
        return
    (files, _), hadoop = _file_system(spark, paths[0]), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    with ThreadPoolExecutor(16) as pool:
        for _ in pool.map(lambda path: files.delete(hadoop(path), True), paths):
            pass


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does."""
    files, hadoop = _file_system(spark, path)
    try:
        out = files.create(hadoop, False)
    except Exception:
        if files.exists(hadoop):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    files, hadoop = _file_system(spark, path)
    if not files.exists(hadoop):
        return None
    stream = files.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """The folders in a folder and the seconds of their last change."""
    files, hadoop = _file_system(spark, path)
    if not files.exists(hadoop):
        return []
    return [(x.getPath().toString(), x.getModificationTime() / 1000) for x in files.listStatus(hadoop) if x.isDirectory()]
