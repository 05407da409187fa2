"""Online time per driver and day from status events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faremill.functions.times import whole_minutes

OPEN_SESSION = "interval 8 hours"


def daily_online_hours(events: DataFrame) -> DataFrame:
    """Hours from each online event to the driver's next event, summed on the start day.

    The next event is of any status; without one, the session counts 8 hours. Only whole minutes count.
    The log crosses the network once, dealt by driver and clock hour: that spreads a driver with very
    many events, or a flooded day, over many tasks. Inside an hour the next event is near at hand; for the
    last one it is the first of the driver's next active hour, so from then on one row an hour is enough.
    Between those two steps and the sum per day no further exchange is needed.
    """
    at, hour = F.col("event_timestamp"), F.date_trunc("hour", "event_timestamp").alias("hour")
    log = events.where("driver_id is not null and event_timestamp is not null").select(
        "driver_id", "event_date", hour, "event_timestamp", "event_id", (F.col("driver_online_status") == "online").alias("online")
    )
    in_hour = W.partitionBy("driver_id", "hour").orderBy("event_timestamp", "event_id")
    is_last = F.col("next_at").isNull()
    hours = (
        log.withColumn("next_at", F.lead("event_timestamp").over(in_hour))
        .groupBy("driver_id", "hour", "event_date")
        .agg(
            F.min("event_timestamp").alias("first_at"),
            F.max("event_timestamp").alias("last_at"),
            F.bool_or(is_last & F.col("online")).alias("stays_online"),
            F.bool_or("online").alias("any_online"),
            F.sum(F.when(F.col("online") & ~is_last, whole_minutes(at, F.col("next_at")))).alias("inner_minutes"),
        )
    )
    by_driver = W.partitionBy("driver_id").orderBy("hour")
    until = F.coalesce("next_at", F.col("last_at") + F.expr(OPEN_SESSION))
    open_minutes = F.when(F.col("stays_online"), whole_minutes(F.col("last_at"), until)).otherwise(0)
    return (
        hours.withColumn("next_at", F.lead("first_at").over(by_driver))
        .groupBy("driver_id", F.col("event_date").alias("activity_date"))
        .agg(
            F.sum(F.coalesce("inner_minutes", F.lit(0)) + open_minutes).alias("minutes"),
            F.bool_or("any_online").alias("any_online"),
        )
        .where("any_online")
        .select("driver_id", "activity_date", F.round(F.col("minutes") / F.lit(60.0), 2).alias("online_hours"))
    )
