"""Day strings and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_FORMAT = "yyyy-MM-dd"


def day_string(seconds: Column, zone: str | None = None) -> Column:
    """Epoch seconds to a ``yyyy-MM-dd`` string, in the session time zone or in a named one.

    With a name the session does not matter: the wall clock is computed without it, so its
    daylight-saving changes cannot move a record to another day.
    """
    if zone is None:
        return F.date_format(F.timestamp_seconds(seconds), DAY_FORMAT)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("SECOND", seconds, epoch))
    return F.date_format(local.cast("date"), DAY_FORMAT)


def parse_day(day: Column) -> Column:
    """Day string to a date, for ordering and calendar parts."""
    return F.to_date(day, DAY_FORMAT)


def shift_day(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days)


def calendar_parts(day: Column) -> dict[str, Column]:
    """Calendar features of a date; Sunday is day 1. Training and forecasting both use this."""
    return {"day_of_week": F.dayofweek(day), "month": F.month(day), "year": F.year(day)}
