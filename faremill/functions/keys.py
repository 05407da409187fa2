"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a null becomes before hashing, so that existing keys stay the same.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    """md5 over the columns as text, joined by a hyphen."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def version_key(key: Column, updated_at: Column) -> Column:
    """md5 that identifies one version of a row in a history table."""
    stamp = F.concat(updated_at.cast("string"), F.lit("+00"))
    return F.md5(F.concat(F.coalesce(key, F.lit("")), F.lit("|"), F.coalesce(stamp, F.lit(""))))
