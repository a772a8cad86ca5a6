"""CSV and Parquet tables under declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from moodtide.schemas import NULL_LIKE, NULL_MARK, POSTS, REPORTS
from moodtide.sources.generations import MISSING_PATH, current


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which reads the data once more.

    ``multi_line`` is needed for text with line breaks and makes each file one task: leave it off for
    large inputs and keep those in Parquet.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # An empty field is NULL like the marker, a quoted empty field an empty text.
    return unmarked_nulls(reader.option("nullValue", NULL_MARK).schema(schema).csv(path))


RAW, PROBLEM = "_raw", "_problem"
FIELDS, UNREADABLE = "number of fields", "unreadable "


def read_checked(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, header: bool = True
) -> DataFrame:
    """CSV whose bad rows are told apart: the columns of ``schema``, ``_problem`` and ``_raw`` (both NULL in sound rows).

    A row is bad when it has too few or too many fields (``number of fields``) or a field that is no value of its
    column (``unreadable <column>``, the first such one; unreadable fields are NULL). Nothing is read twice: the problem
    is worked out from the raw text of bad rows alone.
    """
    options = {"header": header, "multiLine": multi_line, "escape": '"', "nullValue": NULL_MARK, "columnNameOfCorruptRecord": RAW}
    rows = spark.read.options(**options).schema(StructType([*schema.fields, StructField(RAW, StringType())])).csv(path)
    # The same text with all columns as strings fails only where their number is wrong.
    texts = ", ".join(f"`{name}` string" for name in [*schema.names, RAW])
    cells = F.from_csv(F.col(RAW), F.lit(texts), {"escape": '"', "columnNameOfCorruptRecord": RAW})
    unreadable = [
        F.when(F.col(f.name).isNull() & cells[f.name].isNotNull() & (cells[f.name] != NULL_MARK), F.lit(UNREADABLE + f.name)) for f in schema
    ]
    problem = F.when(cells[RAW].isNotNull(), F.lit(FIELDS)).otherwise(F.coalesce(*unreadable, F.lit(FIELDS)))
    marked = rows.withColumn(PROBLEM, F.when(F.col(RAW).isNotNull(), problem))
    strings = [f.name for f in schema if f.dataType == StringType()]
    return marked.withColumns({name: _unmarked(name) for name in strings}).select(*schema.names, PROBLEM, RAW)


def quarantined(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound rows under their schema, and the bad ones as (_problem, _raw). ``checked`` should be a stored table."""
    return checked.filter(F.col(PROBLEM).isNull()).drop(PROBLEM, RAW), checked.filter(F.col(PROBLEM).isNotNull()).select(PROBLEM, RAW)


def problem_counts(checked: DataFrame) -> DataFrame:
    """Bad rows by problem, most frequent first."""
    bad = checked.filter(F.col(PROBLEM).isNotNull()).groupBy(F.col(PROBLEM).alias("problem"))
    return bad.agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "problem")


def _unmarked(name: str) -> Column:
    return F.when(F.col(name).rlike(NULL_LIKE), F.substring(F.col(name), F.lit(2), F.length(name))).otherwise(F.col(name))


def unmarked_nulls(df: DataFrame) -> DataFrame:
    """Undo what the writer does to texts that look like the NULL marker."""
    strings = [field.name for field in df.schema if field.dataType == StringType()]
    return df.withColumns({name: _unmarked(name) for name in strings})


def read_posts(
    spark: SparkSession, path: str, schema: StructType | None = POSTS, multi_line: bool = False
) -> DataFrame:
    return read_csv(spark, path, schema, multi_line)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, bool]:
    """A written report, or an empty table of its schema and False when it does not exist."""
    try:
        return read_csv(spark, path, schema, multi_line=True), True
    except AnalysisException as error:
        if error.getCondition() != MISSING_PATH:
            raise
        return spark.createDataFrame([], schema), False


def read_reports(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> tuple[dict[str, DataFrame], list[str]] | None:
    """Named reports of a folder and the names that are missing; None when none is there.

    Of a folder with a manifest the reports of its last published set.
    """
    tables, missing = {}, []
    folder = current(spark, folder) or folder
    for name in names if names is not None else list(REPORTS):
        tables[name], found = read_or_empty(spark, f"{folder}/{name}", REPORTS[name])
        if not found:
            missing.append(name)
    return None if len(missing) == len(tables) else (tables, missing)


def rows_to_table(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """Rows held by the caller as a table of a declared schema."""
    return spark.createDataFrame(rows, schema)
