"""Star schema: trip facts and the driver, rider and city dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.config import Settings
from faremill.functions.keys import surrogate_key
from faremill.functions.numbers import money_or_zero, numeric_sum
from faremill.functions.times import month_boundaries


def fct_trips(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        surrogate_key("trip_id").alias("fct_trip_sk"),
        "trip_id",
        "rider_id",
        "driver_id",
        "vehicle_id",
        "city_id",
        "payment_id",
        "trip_date",
        "trip_year",
        "trip_month",
        "trip_month_key",
        "trip_status",
        "payment_method",
        "payment_status",
        "payment_provider",
        "trip_type",
        "is_corporate",
        "trip_duration_minutes",
        "estimated_fare",
        F.col("actual_fare").alias("gross_revenue"),
        "net_revenue",
        "fare_variance",
        "processing_fee",
        "payment_amount",
        "surge_multiplier",
        "surge_revenue_contribution",
        "is_extreme_surge",
        "has_duplicate_payment",
        "is_completed_without_payment",
        "is_fraud_suspect",
        "failed_payment_count",
        "success_payment_count",
        "requested_at",
        "pickup_at",
        "dropoff_at",
        "payment_created_at",
        "created_at",
        "updated_at",
    )


def driver_tier(trips: Column) -> Column:
    return (
        F.when(trips >= 500, "platinum").when(trips >= 200, "gold").when(trips >= 50, "silver").otherwise("bronze")
    )


def dim_drivers(drivers: DataFrame, cities: DataFrame, stats: DataFrame, settings: Settings) -> DataFrame:
    trips = F.coalesce("lifetime_trips", F.lit(0))
    return (
        drivers.join(cities.select("city_id", "city_name", "country"), "city_id", "left")
        .join(stats, "driver_id", "left")
        .select(
            "driver_id",
            "vehicle_id",
            "city_id",
            "city_name",
            "country",
            "driver_status",
            "rating",
            "onboarding_date",
            month_boundaries(settings.today(), F.col("onboarding_date")).alias("tenure_months"),
            trips.alias("lifetime_trips"),
            money_or_zero(F.col("lifetime_gross_revenue")).alias("lifetime_gross_revenue"),
            money_or_zero(F.col("lifetime_net_revenue")).alias("lifetime_net_revenue"),
            "avg_fare_per_trip",
            "avg_trip_duration_minutes",
            "first_trip_date",
            "last_trip_date",
            "corporate_trips",
            "personal_trips",
            "days_since_last_trip",
            "is_churned",
            "last_online_at",
            driver_tier(trips).alias("driver_tier"),
            "created_at",
            "updated_at",
        )
    )


def dim_riders(riders: DataFrame, ltv: DataFrame) -> DataFrame:
    return riders.join(ltv.drop("referral_code"), "rider_id", "left").select(
        "rider_id",
        "signup_date",
        "country",
        "referral_code",
        F.coalesce("total_trips", F.lit(0)).alias("total_trips"),
        money_or_zero(F.col("total_gross_spend")).alias("total_gross_spend"),
        money_or_zero(F.col("rider_ltv")).alias("rider_ltv"),
        "avg_fare",
        "first_trip_date",
        "last_trip_date",
        "days_since_last_trip",
        "corporate_trips",
        "signup_cohort",
        "rider_segment",
        "is_referred",
        "created_at",
    )


def dim_cities(cities: DataFrame, enriched: DataFrame, settings: Settings) -> DataFrame:
    totals = (
        enriched.where(F.col("trip_status") == "completed")
        .groupBy("city_id")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            numeric_sum(F.col("actual_fare")).alias("total_gross_revenue"),
            F.min("trip_date").alias("first_trip_date"),
            F.max("trip_date").alias("last_trip_date"),
        )
    )
    return cities.join(totals, "city_id", "left").select(
        "city_id",
        "city_name",
        "country",
        "launch_date",
        month_boundaries(settings.today(), F.col("launch_date")).alias("months_since_launch"),
        F.coalesce("total_trips", F.lit(0)).alias("total_trips"),
        money_or_zero(F.col("total_gross_revenue")).alias("total_gross_revenue"),
        "first_trip_date",
        "last_trip_date",
    )


def driver_versions(drivers: DataFrame) -> DataFrame:
    """The driver columns whose history is kept."""
    return drivers.select(
        "driver_id",
        "vehicle_id",
        "city_id",
        "driver_status",
        "rating",
        "onboarding_date",
        "created_at",
        "updated_at",
    )
