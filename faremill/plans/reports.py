"""The ten standard reports. Each ends in a global sort of an already aggregated result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions import numbers as n

TOP_DRIVERS = 10


def daily_revenue_by_city(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("trip_date", "city_name")
        .agg(
            n.numeric_sum(F.col("gross_revenue")).alias("gross_revenue"),
            n.numeric_sum(F.col("net_revenue")).alias("net_revenue"),
            F.sum("total_trips").alias("total_trips"),
        )
        .withColumn("net_margin_pct", n.money_percent(F.col("net_revenue"), F.col("gross_revenue"), 1))
        .orderBy(F.desc("trip_date"), F.desc("gross_revenue"))
    )


def gross_vs_net(trips: DataFrame) -> DataFrame:
    gross, net = F.col("gross_revenue"), F.col("net_revenue")
    return (
        trips.where(F.col("trip_status") == "completed")
        .groupBy("trip_month_key", "trip_type")
        .agg(n.numeric_sum(gross).alias("gross_revenue"), n.numeric_sum(net).alias("net_revenue"))
        .withColumn("total_deductions", n.numeric(gross - net))
        .withColumn("margin_pct", n.money_percent(net, gross, 1))
        .orderBy("trip_month_key", "trip_type")
    )


def top_drivers(activity: DataFrame, drivers: DataFrame) -> DataFrame:
    """Ten drivers with the highest revenue; ``driver_id`` decides between equals.

    Days are added up per driver before the join, which then meets one row per driver on each side
    and needs no further shuffle.
    """
    totals = activity.groupBy("driver_id").agg(
        n.numeric_sum(F.col("gross_revenue")).alias("gross_revenue"),
        n.numeric_sum(F.col("net_revenue")).alias("net_revenue"),
        F.sum("trips_completed").alias("trips_completed"),
        (F.sum(F.round(F.col("online_hours") * 100).cast("long")) / 100).alias("total_online_hours"),
    )
    return (
        totals.join(drivers, "driver_id")
        .select(
            "driver_id",
            "city_name",
            "driver_tier",
            "driver_status",
            "gross_revenue",
            "net_revenue",
            "trips_completed",
            n.numeric(F.round("rating", 2)).alias("avg_rating"),
            "total_online_hours",
        )
        .orderBy(F.desc("gross_revenue"), "driver_id")
        .limit(TOP_DRIVERS)
    )


def rider_ltv_by_segment(riders: DataFrame) -> DataFrame:
    return (
        riders.groupBy("rider_segment")
        .agg(
            F.count(F.lit(1)).alias("rider_count"),
            n.numeric(F.round(n.numeric_avg(F.col("rider_ltv")), 2)).alias("avg_ltv"),
            F.round(F.avg("total_trips"), 1).alias("avg_trips"),
            F.round(F.avg("days_since_last_trip")).alias("avg_days_since_last_trip"),
            n.numeric_sum(F.col("rider_ltv")).alias("segment_total_ltv"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def payment_failure_rate(reliability: DataFrame) -> DataFrame:
    rate = F.col("payment_failure_rate_pct")
    return reliability.orderBy(F.desc("payment_date"), rate.desc()).select(
        "payment_date",
        "payment_provider",
        "total_attempts",
        "successful_payments",
        "failed_payments",
        F.round(rate, 2).alias("failure_rate_pct"),
        "failed_on_completed_trip",
        F.col("total_failed_amount").alias("at_risk_revenue"),
    )


def surge_impact(trips: DataFrame, cities: DataFrame) -> DataFrame:
    """Days and cities with their surge share.

    Trips are added up per city id first: only those totals meet the names and are added again
    where two ids share a name.
    """
    surging = F.col("surge_multiplier") > 1
    per_id = (
        trips.where(F.col("trip_status") == "completed")
        .groupBy("trip_date", "city_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count_if(surging).alias("surging"),
            n.numeric_sum(F.when(surging, F.col("surge_multiplier"))).alias("multipliers"),
            n.numeric_sum(F.col("surge_revenue_contribution")).alias("surge_revenue"),
            n.numeric_sum(F.col("gross_revenue")).alias("gross_revenue"),
        )
    )
    revenue, gross = F.sum("surge_revenue"), F.sum("gross_revenue")
    return (
        per_id.join(cities.select("city_id", "city_name"), "city_id", "left")
        .groupBy("trip_date", "city_name")
        .agg(
            F.sum("trips").alias("total_trips"),
            F.sum("surging").alias("surge_trips"),
            n.percent(F.sum("surging"), F.sum("trips"), 1).alias("surge_trip_pct"),
            n.numeric(F.round(n.numeric_ratio(F.sum("multipliers"), F.sum("surging")), 2)).alias("avg_surge_multiplier"),
            n.numeric(revenue).alias("total_surge_revenue"),
            n.money_percent(revenue, gross, 1).alias("surge_revenue_pct"),
        )
        .orderBy(F.desc("trip_date"), F.desc("total_surge_revenue"))
    )


def driver_churn(drivers: DataFrame) -> DataFrame:
    churned = F.count_if("is_churned")
    return (
        drivers.groupBy("city_name", "driver_tier", "driver_status")
        .agg(
            F.count(F.lit(1)).alias("total_drivers"),
            churned.alias("churned_drivers"),
            n.percent(churned, F.count(F.lit(1)), 1).alias("churn_rate_pct"),
            F.round(F.avg("days_since_last_trip")).alias("avg_days_inactive"),
        )
        .orderBy(F.desc("churn_rate_pct"))
    )


def fraud_summary(fraud: DataFrame) -> DataFrame:
    """Suspect trips per day and category; the set of names is bounded by the number of cities."""
    cities = F.collect_set("city_name")
    return (
        fraud.groupBy("trip_date", "fraud_category")
        .agg(
            F.count(F.lit(1)).alias("suspect_trips"),
            n.numeric_sum(F.col("gross_revenue")).alias("at_risk_revenue"),
            F.when(F.size(cities) > 0, F.array_join(F.sort_array(cities), ",")).alias("affected_cities"),
        )
        .orderBy(F.desc("at_risk_revenue"))
    )


def city_profitability(revenue: DataFrame, cities: DataFrame) -> DataFrame:
    place = cities.select("city_id", "city_name", "country", "months_since_launch")
    return (
        revenue.drop("city_name", "country")
        .join(place, "city_id")
        .groupBy("city_name", "country", "months_since_launch")
        .agg(
            n.numeric_sum(F.col("gross_revenue")).alias("total_gross_revenue"),
            n.numeric_sum(F.col("net_revenue")).alias("total_net_revenue"),
            F.sum("total_trips").alias("total_trips"),
            n.numeric(F.round(n.numeric_avg(F.col("avg_fare")), 2)).alias("avg_fare"),
            n.numeric_sum(F.col("surge_revenue")).alias("total_surge_revenue"),
            F.sum("fraud_suspect_trips").alias("fraud_suspect_trips"),
        )
        .orderBy(F.desc("total_net_revenue"))
    )


def driver_history(history: DataFrame) -> DataFrame:
    record_type = F.when(F.col("dbt_valid_to").isNull(), "current").otherwise("historical")
    return history.orderBy("driver_id", "dbt_valid_from").select(
        "driver_id",
        "driver_status",
        "vehicle_id",
        "rating",
        "dbt_valid_from",
        "dbt_valid_to",
        record_type.alias("record_type"),
    )
