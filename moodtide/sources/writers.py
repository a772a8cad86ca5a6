"""Parquet tables and CSV reports, written by the tasks; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from moodtide.operators.reports import sample_rows
from moodtide.schemas import NULL_LIKE, NULL_MARK

FILE_ROWS = 5_000_000
# A CSV file with line breaks in its fields is read by one task.
REPORT_FILE_ROWS = 100_000
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_table(df: DataFrame, path: str, *partition_by: str, file_rows: int = FILE_ROWS) -> None:
    """Replace a Parquet table. Files are cut by rows, so a large class does not become one file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy(*partition_by).parquet(path)


def marked_nulls(df: DataFrame) -> DataFrame:
    """Texts as they go into a CSV file: NULL as ``\\N``, a text of backslashes and N with one backslash more.

    The marker keeps a NULL apart from an empty text, and a row of one NULL from a blank line.
    """
    strings = [field.name for field in df.schema if field.dataType == StringType()]
    escaped = lambda c: F.when(c.rlike(NULL_LIKE), F.concat(F.lit("\\"), c)).otherwise(c)
    return df.withColumns({name: F.coalesce(escaped(F.col(name)), F.lit(NULL_MARK)) for name in strings})


def write_report(df: DataFrame, path: str, file_rows: int = REPORT_FILE_ROWS) -> None:
    """Replace a CSV report with a header row; white space is kept, files are cut by rows."""
    options = {"header": True, "escape": '"', "timestampFormat": TIMESTAMP_FORMAT, "maxRecordsPerFile": file_rows}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": NULL_MARK}
    marked_nulls(df).write.mode("overwrite").options(**options).csv(path)


def write_sample(df: DataFrame, path: str, n: int, *order: str) -> None:
    """The first ``n`` rows of a total order as a CSV report."""
    write_report(sample_rows(df, n, *order), path)
