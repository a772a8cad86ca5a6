"""Score to opinion class."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from moodtide.schemas import NEGATIVE, NEGATIVE_TO, NEUTRAL, POSITIVE, POSITIVE_FROM, UNKNOWN


def opinion_class(
    score: Column, positive_from: float = POSITIVE_FROM, negative_to: float = NEGATIVE_TO
) -> Column:
    """NULL is unknown; both limits are inclusive and compared as doubles."""
    value = score.cast("double")
    return (
        F.when(value.isNull(), UNKNOWN)
        .when(value >= F.lit(float(positive_from)), POSITIVE)
        .when(value <= F.lit(float(negative_to)), NEGATIVE)
        .otherwise(NEUTRAL)
    )
