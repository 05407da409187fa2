"""The six raw tables: their schemas and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faremill.functions.numbers import NUMERIC


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _DAY, _TIME = T.StringType(), T.DateType(), T.TimestampType()

SCHEMAS: dict[str, T.StructType] = {
    "trips_raw": _schema(
        trip_id=_TEXT,
        rider_id=_TEXT,
        driver_id=_TEXT,
        vehicle_id=_TEXT,
        city_id=_TEXT,
        status=_TEXT,
        payment_method=_TEXT,
        is_corporate=T.BooleanType(),
        estimated_fare=NUMERIC,
        actual_fare=NUMERIC,
        surge_multiplier=NUMERIC,
        requested_at=_TIME,
        pickup_at=_TIME,
        dropoff_at=_TIME,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "drivers_raw": _schema(
        driver_id=_TEXT,
        vehicle_id=_TEXT,
        city_id=_TEXT,
        driver_status=_TEXT,
        rating=NUMERIC,
        onboarding_date=_DAY,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "riders_raw": _schema(
        rider_id=_TEXT, signup_date=_DAY, country=_TEXT, referral_code=_TEXT, created_at=_TIME
    ),
    "payments_raw": _schema(
        payment_id=_TEXT,
        trip_id=_TEXT,
        payment_status=_TEXT,
        payment_provider=_TEXT,
        amount=NUMERIC,
        fee=NUMERIC,
        currency=_TEXT,
        created_at=_TIME,
    ),
    "cities_raw": _schema(city_id=_TEXT, city_name=_TEXT, country=_TEXT, launch_date=_DAY),
    "driver_status_events_raw": _schema(
        event_id=_TEXT, driver_id=_TEXT, status=_TEXT, event_timestamp=_TIME
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast to the raw schema; a column that already fits is left as it is."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])


def read_raw_files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Parquet folders ``<folder>/<table>``, read with the declared schema."""
    return {t: spark.read.schema(s).parquet(f"{folder}/{t}") for t, s in SCHEMAS.items()}


def read_raw_catalog(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Catalog tables ``<database>.<table>``."""
    return {t: conform(spark.table(f"{database}.{t}"), t) for t in SCHEMAS}
