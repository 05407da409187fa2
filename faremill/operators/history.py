"""Type 2 history: which row versions stay, close or open when new source rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.keys import version_key

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
OPEN, CLOSED = "open", "closed"


def as_new_versions(rows: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Source rows as open versions."""
    stamp = F.col(updated_at)
    return rows.select(
        "*",
        version_key(F.col(key), stamp).alias("dbt_scd_id"),
        stamp.alias("dbt_updated_at"),
        stamp.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
        F.lit(OPEN).alias("state"),
    )


def next_versions(open_rows: DataFrame, source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Open versions after this run, and the versions this run closes (``state`` tells which).

    ``open_rows`` and ``source`` hold each key at most once. A source row replaces the open
    version when its ``updated_at`` is later; a key missing from the source stays open. One join
    gives every row its fate.
    """
    new = as_new_versions(source, key, updated_at)
    columns = new.columns
    old = open_rows.withColumn("state", F.lit(OPEN)).select(*columns)
    pairs = old.select(key, F.struct(*columns).alias("old")).join(
        new.select(key, F.struct(*columns).alias("new")), key, "full_outer"
    )
    known, arrived = F.col("old").isNotNull(), F.col("new").isNotNull()
    replaced = F.coalesce(F.col(f"new.{updated_at}") > F.col("old.dbt_valid_from"), F.lit(False))
    closed = F.col("old").withField("dbt_valid_to", F.col(f"new.{updated_at}")).withField("state", F.lit(CLOSED))
    versions = F.array(
        F.when(known & ~replaced, F.col("old")),
        F.when(replaced, closed),
        F.when(arrived & (~known | replaced), F.col("new")),
    )
    return pairs.select(F.explode(versions).alias("v")).where("v is not null").select("v.*")
