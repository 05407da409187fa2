"""Trips with everything known about them, and lifetime figures per driver and rider."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.config import Settings
from faremill.functions import numbers as n
from faremill.functions.times import days_between, duration_minutes, month_key
from faremill.operators.payments import CHOSEN, payment_rollup


def _flag(condition: Column) -> Column:
    """True or false; unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def int_trips_enriched(
    trips: DataFrame,
    payments: DataFrame,
    cities: DataFrame,
    drivers: DataFrame,
    riders: DataFrame,
    settings: Settings,
    deal: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One wide row per trip.

    ``deal`` moves the joined rows, which have their ``trip_date``, before the columns that follow from
    others are added: a writer that wants rows by day moves a sixth less.

    Payments join on the column the trips were deduplicated by, so only the rolled-up payments
    move. No side is marked for broadcast: Spark broadcasts one only below its size threshold and
    otherwise sort-merges, splitting the partition of a hot driver or rider at run time.
    """
    joined = (
        trips.join(payment_rollup(payments), "trip_id", "left")
        .join(cities.select("city_id", "city_name", F.col("country").alias("city_country")), "city_id", "left")
        .join(drivers.select("driver_id", "driver_status", F.col("rating").alias("driver_rating")), "driver_id", "left")
        .join(
            riders.select(
                "rider_id",
                F.col("signup_date").alias("rider_signup_date"),
                F.col("country").alias("rider_country"),
                "referral_code",
            ),
            "rider_id",
            "left",
        )
    )
    requested = F.col("requested_at")
    joined = deal(joined.withColumn("trip_date", F.to_date(requested)))
    successes = F.coalesce("success_payment_count", F.lit(0))
    extreme = _flag(F.col("surge_multiplier") > F.lit(settings.extreme_surge))
    duplicate = successes > 1
    unpaid = _flag(F.col("trip_status") == "completed") & (successes == 0)
    fare = F.col("actual_fare")
    return joined.select(
        "trip_id",
        "rider_id",
        "driver_id",
        "vehicle_id",
        "city_id",
        "requested_at",
        "pickup_at",
        "dropoff_at",
        "created_at",
        "updated_at",
        "trip_date",
        F.year(requested).cast("long").alias("trip_year"),
        F.month(requested).cast("long").alias("trip_month"),
        month_key(requested).alias("trip_month_key"),
        "trip_status",
        "payment_method",
        duration_minutes(F.col("pickup_at"), F.col("dropoff_at")).alias("trip_duration_minutes"),
        "estimated_fare",
        "actual_fare",
        n.net_revenue(fare, F.col("processing_fee"), settings.platform_fee_rate).alias("net_revenue"),
        n.numeric(fare - F.col("estimated_fare")).alias("fare_variance"),
        "surge_multiplier",
        n.surge_share(fare, F.col("surge_multiplier")).alias("surge_revenue_contribution"),
        "is_corporate",
        F.when(F.col("is_corporate"), "corporate").otherwise("personal").alias("trip_type"),
        *CHOSEN,
        F.coalesce("failed_payment_count", F.lit(0)).alias("failed_payment_count"),
        successes.alias("success_payment_count"),
        "city_name",
        "city_country",
        "driver_status",
        "driver_rating",
        "rider_signup_date",
        "rider_country",
        "referral_code",
        extreme.alias("is_extreme_surge"),
        duplicate.alias("has_duplicate_payment"),
        unpaid.alias("is_completed_without_payment"),
        (extreme | duplicate | unpaid).alias("is_fraud_suspect"),
    )


def _completed(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("trip_status") == "completed")


def int_driver_lifetime_stats(trips: DataFrame, events: DataFrame, settings: Settings) -> DataFrame:
    totals = (
        _completed(trips)
        .groupBy("driver_id")
        .agg(
            F.count(F.lit(1)).alias("lifetime_trips"),
            n.numeric_sum(F.col("actual_fare")).alias("lifetime_gross_revenue"),
            n.numeric_sum(F.col("net_revenue")).alias("lifetime_net_revenue"),
            n.numeric_avg(F.col("actual_fare")).alias("avg_fare_per_trip"),
            n.hundredths_avg(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
            n.numeric_avg(F.col("driver_rating")).alias("avg_driver_rating"),
            F.min("trip_date").alias("first_trip_date"),
            F.max("trip_date").alias("last_trip_date"),
            F.count_if("is_corporate").alias("corporate_trips"),
            F.count_if(~F.col("is_corporate")).alias("personal_trips"),
            F.count_if(F.col("surge_multiplier") > 1).alias("surge_trips"),
        )
    )
    last_online = (
        events.where(F.col("driver_online_status") == "online")
        .groupBy("driver_id")
        .agg(F.max("event_timestamp").alias("last_online_at"))
    )
    idle = days_between(settings.today(), F.col("last_trip_date"))
    return (
        totals.join(last_online, "driver_id", "left")
        .withColumn("days_since_last_trip", idle)
        .withColumn("is_churned", _flag(F.col("days_since_last_trip") >= settings.churn_days))
    )


def int_rider_lifetime_value(trips: DataFrame, settings: Settings) -> DataFrame:
    totals = (
        _completed(trips)
        .groupBy("rider_id", "rider_signup_date", "rider_country", "referral_code")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            n.numeric_sum(F.col("actual_fare")).alias("total_gross_spend"),
            n.numeric_sum(F.col("net_revenue")).alias("rider_ltv"),
            n.numeric_avg(F.col("actual_fare")).alias("avg_fare"),
            F.min("trip_date").alias("first_trip_date"),
            F.max("trip_date").alias("last_trip_date"),
            F.count_if("is_corporate").alias("corporate_trips"),
            F.count_if(F.col("payment_method") == "card").alias("card_trips"),
            F.count_if(F.col("payment_method") == "cash").alias("cash_trips"),
        )
        .withColumn("days_since_last_trip", days_between(settings.today(), F.col("last_trip_date")))
        .withColumn("signup_cohort", month_key(F.col("rider_signup_date")))
    )
    return totals.withColumn("rider_segment", rider_segment()).withColumn(
        "is_referred", F.col("referral_code").isNotNull()
    )


def rider_segment() -> Column:
    """Frequency and recency class; the first rule that holds decides."""
    trips, idle = F.col("total_trips"), F.col("days_since_last_trip")
    return (
        F.when((trips >= 20) & (idle <= 30), "champion")
        .when((trips >= 10) & (idle <= 60), "loyal")
        .when(idle <= 30, "recent")
        .when(idle.between(31, 90), "at_risk")
        .otherwise("churned")
    )
