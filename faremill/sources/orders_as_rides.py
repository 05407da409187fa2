"""Ride data derived from an order-processing data set.

Orders become trips, suppliers drivers, customers riders, nations cities, order lines payment
attempts and web events driver status changes. The result covers duplicate copies, untrimmed
text, retried payments, extreme surge and negative durations. Amounts, days and conditions are
the fixed values of FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.sources.raw import conform

TABLES = ["nation", "supplier", "customer", "orders", "lineitem", "events"]
DAY = 86_400


def _at(year: int, month: int, day: int, seconds: Column | int = 0) -> Column:
    """UTC timestamp a number of seconds after the start of a day."""
    start = int(dt.datetime(year, month, day, tzinfo=dt.UTC).timestamp())
    return F.timestamp_seconds(F.lit(start).cast("long") + seconds)


def _day(year: int, month: int, day: int, days: Column) -> Column:
    return F.date_add(F.lit(dt.date(year, month, day)), days.cast("int"))


def _with_old_copy(df: DataFrame, has_old: Column) -> DataFrame:
    """Copy 1 of every row and, where asked, an outdated copy 0."""
    return df.withColumn("k", F.explode(F.when(has_old, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))


def _cities(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.select(
        key.alias("city_id"),
        F.concat(F.lit("new-port of "), F.lower("n_name")).alias("city_name"),
        F.when(F.col("n_regionkey") % 2 == 0, " gb ").otherwise("ng").alias("country"),
        _day(2019, 1, 15, key * 37).alias("launch_date"),
    )


def _drivers(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    status = (
        F.when((F.col("k") == 0) | (key % 10 == 1), "Inactive")
        .when(key % 10 == 0, "suspended ")
        .otherwise(" ACTIVE")
    )
    return _with_old_copy(supplier, key % 5 == 0).select(
        key.alias("driver_id"),
        (key * 3 + F.col("k")).alias("vehicle_id"),
        F.col("s_nationkey").alias("city_id"),
        status.alias("driver_status"),
        ((10 + key % 41).cast("decimal(10,1)") / 10).alias("rating"),
        _day(2020, 1, 1, key * 7 % 1400).alias("onboarding_date"),
        _at(2020, 1, 1).alias("created_at"),
        _at(2024, 1, 1, F.col("k") * 10 * DAY).alias("updated_at"),
    )


def _riders(customer: DataFrame) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return _with_old_copy(customer, key % 7 == 0).select(
        key.alias("rider_id"),
        _day(2022, 1, 1, key % 700).alias("signup_date"),
        F.when(nation % 2 == 0, " gb").otherwise("Ng ").alias("country"),
        F.when(key % 3 == 0, F.concat(F.lit("REF"), nation.cast("string"))).alias("referral_code"),
        _at(2022, 1, 1, F.col("k") * DAY).alias("created_at"),
    )


def _trips(orders: DataFrame, customer: DataFrame, supplier: DataFrame) -> DataFrame:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    drivers = supplier.select(F.count(F.lit(1))).scalar()
    fare = F.col("o_totalprice").cast("decimal(18,2)")
    driver = (
        F.when(order % 3 == 0, cust % 5)
        .when(order % 3 == 1, 5 + cust % 10)
        .when(cust % 2 == 0, cust)
        .otherwise(15 + cust % 30)
    )
    method = {"1-URGENT": "Card", "2-HIGH": "wallet", "3-MEDIUM": " cash"}
    payment_method = F.lit("card ")
    for priority, text in method.items():
        payment_method = F.when(F.col("o_orderpriority") == priority, text).otherwise(payment_method)
    surge = F.when(order % 5 < 3, 0).otherwise(order % 105).cast("decimal(10,1)") / 10 + 1
    booked = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        order.alias("trip_id"),
        "o_orderstatus",
        F.when(order % 4 == 0, cust % 20).otherwise(cust).alias("rider_id"),
        (driver % drivers).alias("driver_id"),
        F.col("c_nationkey").alias("city_id"),
        payment_method.alias("payment_method"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_corporate"),
        fare.alias("actual_fare"),
        (fare - order % 7).alias("estimated_fare"),
        surge.alias("surge_multiplier"),
    )
    trip, k = F.col("trip_id"), F.col("k")
    status = (
        F.when((k == 0) & (trip % 10 == 0), "no_show")
        .when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", " Completed ")
        .when(trip % 2 == 0, "cancelled")
        .otherwise("NO_SHOW")
    )
    day = trip % 30 - F.when(F.col("rider_id") % 10 == 9, 120).otherwise(0)
    asked = day * DAY + trip * 7919 % DAY
    waited = trip % 900
    ran = F.col("status").contains("omplet")
    return (
        _with_old_copy(booked, trip % 10 == 0)
        .withColumn("status", status)
        .withColumn("vehicle_id", F.col("driver_id") * 3 + 1)
        .withColumn("requested_at", _at(2024, 1, 1, asked))
        .withColumn("pickup_at", F.when(ran, _at(2024, 1, 1, asked + waited)))
        .withColumn("dropoff_at", F.when(ran, _at(2024, 1, 1, asked + waited + trip % 5400 - 20)))
        .withColumn("created_at", F.col("requested_at"))
        .withColumn("updated_at", _at(2024, 1, 1, asked + 3600 * (1 + k)))
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    order = F.col("l_orderkey")
    return lineitem.select(
        (order * 10 + F.col("l_linenumber")).alias("payment_id"),
        order.alias("trip_id"),
        F.when(F.col("l_returnflag") == "R", " FAILED").otherwise("success").alias("payment_status"),
        F.when(F.col("l_linestatus") == "F", "Stripe").otherwise("paypal ").alias("payment_provider"),
        amount.alias("amount"),
        (amount * F.col("l_tax").cast("decimal(4,2)")).alias("fee"),
        F.when(F.col("l_suppkey") % 2 == 0, "gbp").otherwise(" NGN").alias("currency"),
        _at(2024, 1, 1, order % 30 * DAY + F.col("l_partkey") * 37 % DAY).alias("created_at"),
    )


def _status_events(events: DataFrame, supplier: DataFrame) -> DataFrame:
    drivers = supplier.select(F.count(F.lit(1))).scalar()
    online = F.col("event_type").isin("click", "view", "purchase")
    return events.select(
        "event_id",
        (F.col("user_id") % drivers).alias("driver_id"),
        F.when(online, " Online").otherwise("offline").alias("status"),
        F.col("ts").alias("event_timestamp"),
    )


def ride_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six raw ride tables over ``<folder>/{orders,lineitem,...}.parquet``."""
    nation, supplier, customer, orders, lineitem, events = (
        spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES
    )
    derived = {
        "cities_raw": _cities(nation),
        "drivers_raw": _drivers(supplier),
        "riders_raw": _riders(customer),
        "trips_raw": _trips(orders, customer, supplier),
        "payments_raw": _payments(lineitem),
        "driver_status_events_raw": _status_events(events, supplier),
    }
    return {name: conform(df, name) for name, df in derived.items()}
