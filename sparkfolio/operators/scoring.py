"""Scoring of the latest date and recommendations.

The latest date is a scalar subquery: it stays in the plan, and on a stored
table its value reaches the scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.operators.quality import drop_missing
from sparkfolio.schemas import FEATURES, FUTURE_COLUMNS


def latest_rows(df: DataFrame, date_col: str = "trade_date",
                require: Sequence[str] = FEATURES, date: dt.date | None = None) -> DataFrame:
    """Rows on the latest date of ``df`` with all ``require`` columns present. ``date``: the latest date where it is
    known (:func:`~sparkfolio.sources.readers.stored_max` of a stored table), so that ``df`` is read once."""
    newest = df.select(F.max(date_col)).scalar() if date is None else F.lit(date)
    latest = df.filter(F.col(date_col) == newest)
    return drop_missing(latest, list(require)) if require else latest


def recommendation(scored: DataFrame) -> DataFrame:
    """BUY when the predicted return is positive, else HOLD; prediction in %."""
    return scored.select("symbol", "trade_date", "close", "prediction").withColumns({
        "recommendation": F.when(F.col("prediction") > 0, F.lit("BUY")).otherwise(F.lit("HOLD")),
        "prediction_pct": F.col("prediction") * 100,
    }).select(*FUTURE_COLUMNS)


def top_buys(recs: DataFrame, n: int = 5) -> DataFrame:
    """The n best BUY recommendations (top-k: TakeOrderedAndProject)."""
    return recs.filter(F.col("recommendation") == "BUY") \
        .orderBy(F.col("prediction").desc(), F.col("symbol").asc()) \
        .select("symbol", "close", "prediction_pct", "recommendation").limit(n)
