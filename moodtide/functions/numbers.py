"""Repair of numeric text, epoch units and score limits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# An optional sign and digits; a decimal part may follow and is cut off.
WHOLE_NUMBER_PATTERN = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"


def repair_count(text: Column) -> Column:
    """Numeric text as a long: NULL and blank are 0, ``1.5`` is 1, other text and overflow are NULL.

    The plain ``cast`` of a Spark 3 session (ANSI off) gives these values, but for a number without an
    integer part (``.5``), which is NULL here; under ANSI the cast would raise.
    Unreadable text is made NULL before the cast: a failing ``try_cast`` costs an exception per row.
    """
    digits = F.nullif(F.regexp_extract(text, WHOLE_NUMBER_PATTERN, 1), F.lit(""))
    return F.when(text.isNull() | (F.trim(text) == ""), F.lit(0).cast("long")).otherwise(digits.try_cast("long"))


def epoch_seconds(millis: Column) -> Column:
    """Epoch milliseconds to whole seconds, cut towards zero."""
    return (millis / 1000).cast("long")


def clamp_score(score: Column) -> Column:
    """Limit a score to [0, 1]. NaN becomes 0; NULL stays NULL (``least``/``greatest`` would skip it)."""
    limited = F.greatest(F.lit(0.0), F.least(F.nanvl(score, F.lit(0.0)), F.lit(1.0)))
    return F.when(score.isNotNull(), limited)
