"""Written tables in the shared folder: they cut lineage, feed several readers and outlive executors."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="moodtide-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every node sees, as the session names it. A temporary one only in local mode."""
    folder = spark.conf.get(SHARED_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_FOLDER} to a folder that all nodes can reach")
    return _local_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/moodtide/{uuid.uuid4().hex}/{name}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows to an Arrow batch meanwhile, for tables that Python makes out of whole texts: the default of
    10,000 texts would take more memory than the work on them. What is written inside is planned with it."""
    before = spark.conf.get(ARROW_ROWS, None)
    spark.conf.set(ARROW_ROWS, BATCH_ROWS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_ROWS)
        else:
            spark.conf.set(ARROW_ROWS, before)


def store_texts(df: DataFrame, name: str) -> DataFrame:
    """``store`` in small batches."""
    with small_batches(df.sparkSession):
        return store(df, name)
