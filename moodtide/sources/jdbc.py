"""Database tables over JDBC, read in parallel when the caller names a range."""

from __future__ import annotations

import configparser
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Default port, driver class and URL form of the database the tables live in.
DEFAULT_PORT = "3306"
DEFAULT_DRIVER = "com.mysql.jdbc.Driver"
URL_FORM = "jdbc:mysql://{host}:{port}/{database}"
REQUIRED_SETTINGS = ("host", "database", "user", "password")
DEFAULT_SECTION = "mysql_db"
FETCH_ROWS = 10_000
# This driver holds the whole result in memory unless it is told to use a cursor.
CURSOR_FETCH = {"com.mysql.jdbc.Driver": "useCursorFetch", "com.mysql.cj.jdbc.Driver": "useCursorFetch"}

NO_DRIVER_SIGNS = ("No suitable driver", "ClassNotFoundException")


class DriverMissing(RuntimeError):
    """The JDBC driver class is not on the class path."""


@dataclass(frozen=True)
class KeyRange:
    """A numeric, date or timestamp column and the bounds that split a read into partitions.

    Bounds shape the partitions only; rows outside them are read too.
    """

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def connection(settings: Mapping[str, str | None], driver: str = DEFAULT_DRIVER) -> tuple[str, dict[str, str]]:
    """URL and properties from host, port, database, user and password."""
    for name in REQUIRED_SETTINGS:
        if not settings.get(name):
            raise ValueError(f"connection setting '{name}' is missing or empty")
    url = URL_FORM.format(
        host=settings["host"], port=settings.get("port") or DEFAULT_PORT, database=settings["database"]
    )
    properties = {"user": settings["user"], "password": settings["password"], "driver": driver}
    if driver in CURSOR_FETCH:
        properties[CURSOR_FETCH[driver]] = "true"
    return url, properties


def hash_predicates(column: str, partitions: int, hash_function: str = "CRC32") -> list[str]:
    """Predicates that deal the rows by a text key, each row once; rows without a key go with the first part."""
    if partitions < 1:
        raise ValueError("at least one partition is needed")
    parts = [f"MOD({hash_function}({column}), {partitions}) = {i}" for i in range(partitions)]
    return [f"({parts[0]} OR {column} IS NULL)", *parts[1:]]


def settings_from_ini(path: str, section: str = DEFAULT_SECTION) -> dict[str, str]:
    """Connection settings from an INI file kept outside the repository."""
    parser = configparser.ConfigParser(interpolation=None)
    if not parser.read(path):
        raise FileNotFoundError(f"no settings file at {path}")
    if section not in parser:
        raise KeyError(f"settings file {path} has no section '{section}'")
    return dict(parser[section])


def read_options(
    url: str, table: str, properties: Mapping[str, str], split: KeyRange | None = None, fetch_rows: int = FETCH_ROWS
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **properties}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    table: str,
    url: str,
    properties: Mapping[str, str],
    split: KeyRange | None = None,
    predicates: list[str] | None = None,
    fetch_rows: int = FETCH_ROWS,
    whole_table: bool = False,
) -> DataFrame:
    """A table in parallel parts: by a key range, or one part per predicate (``hash_predicates`` for text keys).

    Predicates must cover every row once, the NULL key included. A table read in one piece, by a
    single task, has to be asked for with ``whole_table``.
    """
    if split is None and predicates is None and not whole_table:
        raise ValueError(f"reading {table} in one task needs whole_table=True; else name a key range or predicates")
    try:
        if predicates is not None:
            with_fetch = {**properties, "fetchsize": str(fetch_rows)}
            return spark.read.jdbc(url, table, predicates=predicates, properties=with_fetch)
        return spark.read.format("jdbc").options(**read_options(url, table, properties, split, fetch_rows)).load()
    except Exception as error:
        if any(sign in str(error) for sign in NO_DRIVER_SIGNS):
            hint = f"JDBC driver {properties.get('driver')} not found; add its jar with spark.jars"
            raise DriverMissing(hint) from error
        raise
