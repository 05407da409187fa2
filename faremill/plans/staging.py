"""Staging: one typed, normalised, deduplicated table per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.numbers import numeric
from faremill.functions.text import lower_trim, title_case, upper_trim
from faremill.operators.dedup import newest_per_key


def _text(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


def _time(*names: str):
    return [F.col(n).cast("timestamp").alias(n) for n in names]


def _money(*names: str):
    return [numeric(F.col(n)).alias(n) for n in names]


def stg_trips(raw: DataFrame) -> DataFrame:
    return newest_per_key(raw, "trip_id", "updated_at").select(
        *_text("trip_id", "rider_id", "driver_id", "vehicle_id", "city_id"),
        *_time("requested_at", "pickup_at", "dropoff_at", "created_at", "updated_at"),
        lower_trim(F.col("status")).alias("trip_status"),
        lower_trim(F.col("payment_method")).alias("payment_method"),
        F.col("is_corporate").cast("boolean").alias("is_corporate"),
        *_money("estimated_fare", "actual_fare", "surge_multiplier"),
    )


def stg_drivers(raw: DataFrame) -> DataFrame:
    return newest_per_key(raw, "driver_id", "updated_at").select(
        *_text("driver_id", "vehicle_id", "city_id"),
        lower_trim(F.col("driver_status")).alias("driver_status"),
        *_money("rating"),
        F.col("onboarding_date").cast("date").alias("onboarding_date"),
        *_time("created_at", "updated_at"),
    )


def stg_riders(raw: DataFrame) -> DataFrame:
    return newest_per_key(raw, "rider_id", "created_at").select(
        *_text("rider_id"),
        F.col("signup_date").cast("date").alias("signup_date"),
        upper_trim(F.col("country")).alias("country"),
        *_text("referral_code"),
        *_time("created_at"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return newest_per_key(raw, "payment_id", "created_at").select(
        *_text("payment_id", "trip_id"),
        lower_trim(F.col("payment_status")).alias("payment_status"),
        lower_trim(F.col("payment_provider")).alias("payment_provider"),
        *_money("amount"),
        numeric(F.col("fee")).alias("processing_fee"),
        upper_trim(F.col("currency")).alias("currency"),
        *_time("created_at"),
    )


def stg_cities(raw: DataFrame) -> DataFrame:
    """Cities come without copies; none are removed."""
    return raw.where("city_id is not null").select(
        *_text("city_id"),
        title_case(F.col("city_name")).alias("city_name"),
        upper_trim(F.col("country")).alias("country"),
        F.col("launch_date").cast("date").alias("launch_date"),
    )


def stg_driver_status_events(raw: DataFrame) -> DataFrame:
    return newest_per_key(raw, "event_id", "event_timestamp").select(
        *_text("event_id", "driver_id"),
        lower_trim(F.col("status")).alias("driver_online_status"),
        *_time("event_timestamp"),
        F.to_date("event_timestamp").alias("event_date"),
    )
