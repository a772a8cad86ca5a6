"""Opinion and trend analytics for short texts, as Spark DataFrame transformations.

The names below are the usual way in; everything else is in ``functions``, ``operators``,
``sources`` and ``plans``.
"""

from moodtide.operators.polarity import classify, fit_polarity_model, score_records, score_text, score_with
from moodtide.operators.records import text_union
from moodtide.operators.series import daily_series, trend_features
from moodtide.plans.notes import analyse_notes
from moodtide.plans.posts import analyse_posts
from moodtide.plans.trend import Trend, forecast_trend
from moodtide.storage import store

__all__ = [
    "Trend",
    "analyse_notes",
    "analyse_posts",
    "classify",
    "daily_series",
    "fit_polarity_model",
    "forecast_trend",
    "score_records",
    "score_text",
    "score_with",
    "store",
    "text_union",
    "trend_features",
]
