"""Join hints.

Dimensions are read from written tables, so Spark knows their bytes and picks
broadcast or shuffle joins itself (``autoBroadcastJoinThreshold``, AQE).  Only
the calendar is hinted: it has one row per day, whatever the data's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(df: DataFrame) -> DataFrame:
    """Hint that ``df``, with at most one row per day, is to be broadcast."""
    return F.broadcast(df)
