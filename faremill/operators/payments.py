"""Everything a trip needs to know about its payments, in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHOSEN = ["payment_id", "payment_status", "payment_provider", "payment_amount", "processing_fee", "currency",
          "payment_created_at"]


def payment_rollup(payments: DataFrame) -> DataFrame:
    """One row per trip: the chosen payment and the counts of failed and successful attempts.

    The chosen payment is the newest successful one, or the newest of any status. It is the
    maximum of a struct, so Spark combines attempts before the shuffle and a trip with very many
    attempts is no burden to one task.
    """
    succeeded = F.col("payment_status") == "success"
    candidate = F.struct(
        F.coalesce(succeeded, F.lit(False)).alias("succeeded"),
        F.col("created_at").alias("payment_created_at"),
        "payment_id",
        "payment_status",
        "payment_provider",
        F.col("amount").alias("payment_amount"),
        "processing_fee",
        "currency",
    )
    return (
        payments.where(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(
            F.max(candidate).alias("best"),
            F.count_if(F.col("payment_status") == "failed").alias("failed_payment_count"),
            F.count_if(succeeded).alias("success_payment_count"),
        )
        .select(
            "trip_id",
            *[F.col(f"best.{c}").alias(c) for c in CHOSEN],
            "failed_payment_count",
            "success_payment_count",
        )
    )
