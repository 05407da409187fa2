"""Which checks apply to which columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.operators import checks as c

# Accepted texts per column.
TRIP_STATUS = ["completed", "cancelled", "no_show"]
PAYMENT_METHOD = ["card", "wallet", "cash"]
DRIVER_STATUS = ["active", "suspended", "inactive"]
PAYMENT_STATUS = ["success", "failed"]
PAYMENT_PROVIDER = ["stripe", "paypal"]
ONLINE_STATUS = ["online", "offline"]
DRIVER_TIER = ["bronze", "silver", "gold", "platinum"]
RIDER_SEGMENT = ["champion", "loyal", "recent", "at_risk", "churned"]
FRAUD_CATEGORY = ["extreme_surge", "duplicate_payment", "completed_no_payment", "multiple_indicators", "other"]

NOT_NULL = {
    "trips_raw": ["trip_id", "rider_id", "driver_id", "city_id", "status", "requested_at"],
    "drivers_raw": ["driver_id", "driver_status", "city_id"],
    "riders_raw": ["rider_id", "signup_date"],
    "payments_raw": ["payment_id", "trip_id", "payment_status", "amount", "created_at"],
    "cities_raw": ["city_id", "city_name", "country"],
    "driver_status_events_raw": ["event_id", "driver_id", "status", "event_timestamp"],
    "stg_trips": ["trip_id", "rider_id", "driver_id", "city_id", "actual_fare", "requested_at"],
    "stg_drivers": ["driver_id", "city_id"],
    "stg_riders": ["rider_id", "signup_date"],
    "stg_payments": ["payment_id", "trip_id", "amount"],
    "stg_cities": ["city_id", "city_name", "country"],
    "stg_driver_status_events": ["event_id", "driver_id", "event_timestamp", "event_date"],
    "fct_trips": ["fct_trip_sk", "trip_id", "trip_date"],
    "dim_drivers": ["driver_id"],
    "dim_riders": ["rider_id"],
    "dim_cities": ["city_id", "city_name"],
    "fct_daily_revenue": ["fct_daily_revenue_sk"],
    "fct_payment_reliability": ["fct_payment_reliability_sk"],
    "fct_driver_activity": ["fct_driver_activity_sk"],
    "fct_fraud_monitoring": ["trip_id"],
}

UNIQUE = {
    "trips_raw": ["trip_id"],
    "drivers_raw": ["driver_id"],
    "riders_raw": ["rider_id"],
    "payments_raw": ["payment_id"],
    "cities_raw": ["city_id"],
    "driver_status_events_raw": ["event_id"],
    "stg_trips": ["trip_id"],
    "stg_drivers": ["driver_id"],
    "stg_riders": ["rider_id"],
    "stg_payments": ["payment_id"],
    "stg_cities": ["city_id"],
    "stg_driver_status_events": ["event_id"],
    "fct_trips": ["fct_trip_sk", "trip_id"],
    "dim_drivers": ["driver_id"],
    "dim_riders": ["rider_id"],
    "dim_cities": ["city_id"],
    "fct_daily_revenue": ["fct_daily_revenue_sk"],
    "fct_payment_reliability": ["fct_payment_reliability_sk"],
    "fct_driver_activity": ["fct_driver_activity_sk"],
    "fct_fraud_monitoring": ["trip_id"],
}

ACCEPTED_VALUES = {
    "trips_raw": {"status": TRIP_STATUS, "payment_method": PAYMENT_METHOD},
    "drivers_raw": {"driver_status": DRIVER_STATUS},
    "payments_raw": {"payment_status": PAYMENT_STATUS, "payment_provider": PAYMENT_PROVIDER},
    "driver_status_events_raw": {"status": ONLINE_STATUS},
    "stg_trips": {"trip_status": TRIP_STATUS, "payment_method": PAYMENT_METHOD},
    "stg_drivers": {"driver_status": DRIVER_STATUS},
    "stg_payments": {"payment_status": PAYMENT_STATUS},
    "stg_driver_status_events": {"driver_online_status": ONLINE_STATUS},
    "fct_trips": {"trip_status": TRIP_STATUS},
    "dim_drivers": {"driver_status": DRIVER_STATUS, "driver_tier": DRIVER_TIER},
    "dim_riders": {"rider_segment": RIDER_SEGMENT},
    "fct_fraud_monitoring": {"fraud_category": FRAUD_CATEGORY},
}

#: child table -> key -> parent table; the key has the same name on both sides.
RELATIONSHIPS = {
    "trips_raw": {"rider_id": "riders_raw", "driver_id": "drivers_raw", "city_id": "cities_raw"},
    "drivers_raw": {"city_id": "cities_raw"},
    "payments_raw": {"trip_id": "trips_raw"},
    "driver_status_events_raw": {"driver_id": "drivers_raw"},
    "stg_trips": {"rider_id": "stg_riders", "driver_id": "stg_drivers", "city_id": "stg_cities"},
    "stg_drivers": {"city_id": "stg_cities"},
    "stg_payments": {"trip_id": "stg_trips"},
    "stg_driver_status_events": {"driver_id": "stg_drivers"},
}

EXPRESSION_IS_TRUE = {"stg_trips": ["actual_fare"], "stg_payments": ["amount"]}

NO_NEGATIVE_REVENUE = {
    "fct_trips": ["gross_revenue", "net_revenue"],
    "dim_drivers": ["lifetime_gross_revenue"],
    "dim_riders": ["rider_ltv"],
    "fct_daily_revenue": ["gross_revenue", "net_revenue"],
    "fct_driver_activity": ["gross_revenue"],
}

POSITIVE_TRIP_DURATION = {"fct_trips": ["trip_duration_minutes"]}
COMPLETED_HAS_PAYMENT = {"fct_trips": ["success_payment_count"]}


#: Checks that are conditions on single rows: declared columns and what fails.
ROW_CHECKS: dict[str, tuple[c.Columns, c.Fails]] = {
    "dq_not_null": (NOT_NULL, c.is_missing),
    "dq_expression_is_true": (EXPRESSION_IS_TRUE, c.is_negative),
    "dq_no_negative_revenue": (NO_NEGATIVE_REVENUE, c.is_negative),
    "dq_positive_trip_duration": (POSITIVE_TRIP_DURATION, c.is_not_positive_when_completed),
    "dq_completed_has_payment": (COMPLETED_HAS_PAYMENT, c.is_zero_when_completed),
}

#: Checks that compare values over a table or between tables, and their declarations.
VALUE_CHECKS: dict[str, tuple[Callable[..., DataFrame], dict]] = {
    "dq_unique": (c.unique, UNIQUE),
    "dq_accepted_values": (c.accepted_values, ACCEPTED_VALUES),
    "dq_relationships": (c.relationships, RELATIONSHIPS),
}

CHECKS: tuple[str, ...] = (*ROW_CHECKS, *VALUE_CHECKS)


def checked_tables(name: str) -> list[str]:
    """The tables that a check reads."""
    declared = ROW_CHECKS[name][0] if name in ROW_CHECKS else VALUE_CHECKS[name][1]
    parents = [p for keys in RELATIONSHIPS.values() for p in keys.values()] if name == "dq_relationships" else []
    return list(dict.fromkeys([*declared, *parents]))


def run_check(name: str, tables: c.Tables) -> DataFrame:
    """``model, column_name, failures`` of one check."""
    if name in ROW_CHECKS:
        return c.count_failing_rows(tables, {name: ROW_CHECKS[name]}).drop("check")
    run, declared = VALUE_CHECKS[name]
    return run(tables, declared)


def all_checks(tables: c.Tables, model: str | None = None) -> DataFrame | None:
    """``check, model, column_name, failures`` of every check, or of those on one table (None without any)."""

    def chosen(declared: dict) -> dict:
        return {m: declared[m] for m in declared if model in (None, m)}

    by_row = {name: (chosen(declared), fails) for name, (declared, fails) in ROW_CHECKS.items() if chosen(declared)}
    parts = [c.count_failing_rows(tables, by_row)] if by_row else []
    for name, (run, declared) in VALUE_CHECKS.items():
        if chosen(declared):
            parts.append(run(tables, chosen(declared)).select(F.lit(name).alias("check"), "*"))
    return c.union_all(parts) if parts else None


def failing(name: str, tables: c.Tables, model: str, column: str) -> DataFrame:
    """What fails one check of one column: rows, or values and how often they occur. Nothing runs yet."""
    declared = ROW_CHECKS[name][0] if name in ROW_CHECKS else VALUE_CHECKS[name][1]
    if column not in declared.get(model, ()):
        raise ValueError(f"{name} is not declared for {model}.{column}")
    if name in ROW_CHECKS:
        return c.rows_where(ROW_CHECKS[name][1])(tables, model, column)
    if name == "dq_unique":
        return c.repeated_values(tables, model, column)
    if name == "dq_accepted_values":
        return c.unwanted_values(tables, model, column, ACCEPTED_VALUES[model][column])
    return c.orphans(tables, model, column, RELATIONSHIPS[model][column])
