"""Events relabelled by stock band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.bands import relabelled
from stockweave.functions.numbers import nan_to_null


def relabel(events: DataFrame, activity: str = "activity") -> DataFrame:
    """Replace the activity of events that carry stock, safety stock and overstock level."""
    bounds = ["stock_before", "stock_after", "safety_stock", "overstock_level"]
    known = events.withColumns({c: nan_to_null(F.col(c)) for c in bounds})
    return relabelled(known, activity, *bounds)
