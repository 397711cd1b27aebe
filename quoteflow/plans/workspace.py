"""Intermediate tables in the folder that all executors share, and scopes that remove them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from quoteflow.plans import files

# With it Spark removes the shuffle files of a query when it ends, and not when the driver's JVM next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The folders of the innermost scope.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local session may do without."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quoteflow-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, together with all others of this application."""
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/quoteflow-{application}/{name}-{uuid.uuid4().hex}"
    if (owned := _owned.get()) is not None:
        owned.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Owns the folders that are made inside it, and removes them at its end, also after an error.

    Read or write results before it ends: DataFrames are lazy, and one that was made inside may need
    its folders until then. Folders outside any scope stay until someone removes them. Scopes may be nested;
    a folder belongs to the innermost.
    """
    token = _owned.set([])
    try:
        yield
    finally:
        owned = _owned.get()
        _owned.reset(token)
        for path in owned:
            files.delete(spark, path)


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet. What it has shuffled for that is not read again, so those files go at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that outlives lost executors, computes ``df`` once however often
    it is used, and tells the planner its true size, on which Spark decides about broadcasting.
    """
    path = new_folder(df.sparkSession, name)
    write_once(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
