"""Keep the newest copy of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: str, newest: str) -> DataFrame:
    """One row per non-null key: the one with the latest ``newest``.

    All other columns break ties, so reruns pick the same row. Because only rank 1 is kept,
    Spark drops the losers of each map task before the shuffle (WindowGroupLimit): a key with
    any number of copies sends at most one row per task.
    """
    ties = [c for c in df.columns if c not in (key, newest)]
    order = [F.desc_nulls_last(c) for c in (newest, *ties)]
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
        .where("_rank = 1")
        .drop("_rank")
    )
