"""Report sets that change all at once.

A flow writes its tables into a generation, a folder of its own, and names it in the manifest when all are there. Readers
follow the last line of the manifest, so they see either the whole old set or the whole new one; what a flow that died
left behind is named nowhere. The manifest is a Parquet table that grows by one file, written as one job, per set.
Old generations stay, for readers that still hold them, until the owner of the folder removes them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Spark's name for the error of a path that does not exist.
MISSING_PATH = "PATH_NOT_FOUND"
MANIFEST = "manifest"
LINES = "number long, generation string"


def new_generation(folder: str) -> str:
    """Where the next set is written."""
    return f"{folder}/generation-{uuid.uuid4().hex}"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Published generations by number, none for a folder without a manifest."""
    try:
        return spark.read.schema(LINES).parquet(f"{folder}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != MISSING_PATH:
            raise
        return spark.createDataFrame([], LINES)


def current(spark: SparkSession, folder: str) -> str | None:
    """The folder of the last published set; of two sets with one number, that of the later name."""
    last = manifest(spark, folder).orderBy("number", "generation", ascending=False).first()
    return None if last is None else f"{folder}/{last['generation']}"


def publish(spark: SparkSession, folder: str, generation: str) -> None:
    """Make a written generation the one that readers see."""
    last = manifest(spark, folder).agg({"number": "max"}).first()[0] or 0
    line = spark.createDataFrame([(last + 1, generation.rsplit("/", 1)[1])], LINES)
    line.coalesce(1).write.mode("append").parquet(f"{folder}/{MANIFEST}")
