"""Written steps: intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one if all run in this process (tests), else an error: executors elsewhere would each write to a disk of their own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or getattr(context, "_kinweave_shared", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='kinweave-')}"
        context._kinweave_shared = folder
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_end(spark: SparkSession):
    """Inside, Spark deletes the shuffle files of a query when it ends. Only for queries whose DataFrame is not run again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df once to the shared folder and reads it back: cuts the lineage, survives lost executors, and gives the planner a size."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with _shuffles_end(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinweave_path = path
    for tables in _open.get():
        tables.append(out)
    return out


#: The tables written so far inside each finish() that runs in this thread.
_open: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("_open", default=())


def finish(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """build()'s rows, written; the tables that it wrote on the way are deleted, as nothing reads them any more."""
    tables: list[DataFrame] = []
    before = _open.set((*_open.get(), tables))
    try:
        try:
            df = build()
        finally:
            _open.reset(before)
        return materialize(df, name)
    finally:
        discard(*tables)


def discard(*tables: DataFrame) -> None:
    """Deletes what materialize() wrote, when nothing lazy reads it any more."""
    for df in tables:
        path = getattr(df, "_kinweave_path", None)
        if path:
            delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
