"""How old the newest row of each source is."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.operators.checks import union_all


class Limits(NamedTuple):
    loaded_at: str
    warn_hours: int
    error_hours: int


# The agreed limits per source.
LIMITS = {
    "trips_raw": Limits("updated_at", 1, 2),
    "drivers_raw": Limits("updated_at", 6, 24),
    "riders_raw": Limits("created_at", 12, 48),
    "payments_raw": Limits("created_at", 2, 6),
    "cities_raw": Limits("launch_date", 1, 2),
    "driver_status_events_raw": Limits("event_timestamp", 1, 3),
}


def source_freshness(
    sources: Mapping[str, DataFrame], now: dt.datetime | None = None, limits: Mapping[str, Limits] = LIMITS
) -> DataFrame:
    """One row per source: newest load time, its age and the status; an empty source is an error."""
    clock = F.current_timestamp() if now is None else F.lit(now)

    def one(name: str, limit: Limits) -> DataFrame:
        age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), clock) / F.lit(1e6)
        status = (
            F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > limit.error_hours * 3600), "error")
            .when(F.col("age_seconds") > limit.warn_hours * 3600, "warn")
            .otherwise("pass")
        )
        return (
            sources[name]
            .agg(F.max(F.col(limit.loaded_at).cast("timestamp")).alias("max_loaded_at"))
            .withColumn("age_seconds", age)
            .select(F.lit(name).alias("source"), "max_loaded_at", "age_seconds", status.alias("status"))
        )

    return union_all([one(name, limit) for name, limit in limits.items()])
