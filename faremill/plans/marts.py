"""Finance, operations and fraud marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions import numbers as n
from faremill.functions.keys import surrogate_key
from faremill.operators.sessions import daily_online_hours


def fct_daily_revenue(trips: DataFrame, cities: DataFrame) -> DataFrame:
    """Completed trips per day, city and trip type; names join after the aggregation."""
    daily = (
        trips.where(F.col("trip_status") == "completed")
        .groupBy("trip_date", "city_id", "trip_type")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            n.numeric_sum(F.col("gross_revenue")).alias("gross_revenue"),
            n.numeric_sum(F.col("net_revenue")).alias("net_revenue"),
            n.numeric_sum(F.col("processing_fee")).alias("total_processing_fees"),
            n.numeric_sum(F.col("surge_revenue_contribution")).alias("surge_revenue"),
            n.numeric_avg(F.col("surge_multiplier")).alias("avg_surge_multiplier"),
            n.hundredths_avg(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
            n.numeric_avg(F.col("gross_revenue")).alias("avg_fare"),
            F.count_if("is_extreme_surge").alias("extreme_surge_trips"),
            F.count_if("has_duplicate_payment").alias("duplicate_payment_trips"),
            F.count_if("is_fraud_suspect").alias("fraud_suspect_trips"),
        )
    )
    names = cities.select("city_id", "city_name", "country")
    return daily.join(names, "city_id", "left").select(
        surrogate_key("trip_date", "city_id", "trip_type").alias("fct_daily_revenue_sk"),
        "trip_date",
        "city_id",
        "city_name",
        "country",
        "trip_type",
        "total_trips",
        "gross_revenue",
        "net_revenue",
        "total_processing_fees",
        "surge_revenue",
        n.money_percent(F.col("surge_revenue"), F.col("gross_revenue"), 2).alias("surge_revenue_pct"),
        "avg_surge_multiplier",
        "avg_trip_duration_minutes",
        "avg_fare",
        "extreme_surge_trips",
        "duplicate_payment_trips",
        "fraud_suspect_trips",
    )


def _sum_if(condition: Column, amount: str) -> Column:
    return n.numeric_sum(F.when(condition, n.numeric(F.col(amount))).otherwise(n.zero()))


def fct_payment_reliability(payments: DataFrame, trips: DataFrame) -> DataFrame:
    """Payment attempts per day, city, provider and currency; unknown trips keep a null city."""
    succeeded = F.col("payment_status") == "success"
    failed = F.col("payment_status") == "failed"
    attempts = (
        payments.join(trips.select("trip_id", "city_id", "trip_status"), "trip_id", "left")
        .groupBy(F.to_date("created_at").alias("payment_date"), "city_id", "payment_provider", "currency")
        .agg(
            F.count(F.lit(1)).alias("total_attempts"),
            F.count_if(succeeded).alias("successful_payments"),
            F.count_if(failed).alias("failed_payments"),
            F.count_if(failed & (F.col("trip_status") == "completed")).alias("failed_on_completed_trip"),
            _sum_if(succeeded, "amount").alias("total_collected"),
            _sum_if(failed, "amount").alias("total_failed_amount"),
            _sum_if(succeeded, "processing_fee").alias("total_fees"),
        )
    )
    key = surrogate_key("payment_date", "city_id", "payment_provider", "currency")
    failure_rate = n.safe_divide(F.col("failed_payments"), F.col("total_attempts")) * 100
    return attempts.select(
        key.alias("fct_payment_reliability_sk"),
        "*",
        failure_rate.alias("payment_failure_rate_pct"),
        n.numeric(F.col("total_collected") - F.col("total_fees")).alias("net_collected"),
    )


def fct_driver_activity(trips: DataFrame, events: DataFrame) -> DataFrame:
    """Completed trips per driver, city and day, with the driver's online hours of that day."""
    work = (
        trips.where(F.col("trip_status") == "completed")
        .groupBy("driver_id", "city_id", F.col("trip_date").alias("activity_date"))
        .agg(
            F.count(F.lit(1)).alias("trips_completed"),
            n.numeric_sum(F.col("gross_revenue")).alias("gross_revenue"),
            n.numeric_sum(F.col("net_revenue")).alias("net_revenue"),
            n.hundredths_avg(F.col("trip_duration_minutes")).alias("avg_trip_duration_minutes"),
            F.count_if("is_corporate").alias("corporate_trips"),
            F.count_if(F.col("surge_multiplier") > 1).alias("surge_trips"),
        )
    )
    # Hours carry two decimals, so the quotient is taken in decimals: halves round as they should.
    revenue_rate = n.safe_divide(F.col("gross_revenue"), n.numeric(F.col("online_hours"))).cast("double")
    return work.join(daily_online_hours(events), ["driver_id", "activity_date"], "left").select(
        surrogate_key("driver_id", "activity_date").alias("fct_driver_activity_sk"),
        "driver_id",
        "city_id",
        "activity_date",
        "trips_completed",
        "gross_revenue",
        "net_revenue",
        "avg_trip_duration_minutes",
        "corporate_trips",
        "surge_trips",
        F.coalesce("online_hours", F.lit(0.0)).alias("online_hours"),
        revenue_rate.alias("revenue_per_online_hour"),
    )


def fraud_category() -> Column:
    surge, duplicate = F.col("is_extreme_surge"), F.col("has_duplicate_payment")
    return (
        F.when(surge & duplicate, "multiple_indicators")
        .when(surge, "extreme_surge")
        .when(duplicate, "duplicate_payment")
        .when(F.col("is_completed_without_payment"), "completed_no_payment")
        .otherwise("other")
    )


def fct_fraud_monitoring(trips: DataFrame, drivers: DataFrame, riders: DataFrame) -> DataFrame:
    """Suspect trips; ``city_name`` is the driver's home city, ``city_id`` the trip's."""
    return (
        trips.where("is_fraud_suspect")
        .join(drivers.select("driver_id", "city_name", "driver_tier", "driver_status"), "driver_id", "left")
        .join(
            riders.select("rider_id", "rider_segment", F.col("total_trips").alias("rider_total_trips")),
            "rider_id",
            "left",
        )
        .select(
            "trip_id",
            "trip_date",
            "city_id",
            "driver_id",
            "rider_id",
            "trip_status",
            "gross_revenue",
            "net_revenue",
            "surge_multiplier",
            "payment_method",
            "payment_status",
            "is_extreme_surge",
            "has_duplicate_payment",
            "is_completed_without_payment",
            fraud_category().alias("fraud_category"),
            "city_name",
            "driver_tier",
            "driver_status",
            "rider_segment",
            "rider_total_trips",
            "requested_at",
            "payment_created_at",
        )
    )
