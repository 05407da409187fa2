"""Day-by-day loading with a one-day look-back for late rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKBACK = dt.timedelta(days=1)


def reload_from(newest: dt.date | None) -> dt.date | None:
    """First day to load again: the day before the newest one that has rows.

    None means load everything: the target has no rows. The day reaches the scans as a literal,
    which prunes partitions and row groups.
    """
    return None if newest is None else newest - LOOKBACK


def since(df: DataFrame, column: str, first: dt.date | None) -> DataFrame:
    return df if first is None else df.where(F.col(column) >= F.lit(first))
