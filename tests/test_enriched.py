import datetime as dt
from decimal import Decimal

import pytest
from conftest import ts

from faremill.plans import core, intermediate, marts, staging


@pytest.fixture
def enrich(raw, settings):
    def run(**tables):
        r = raw(**tables)
        df = intermediate.int_trips_enriched(
            staging.stg_trips(r["trips_raw"]),
            staging.stg_payments(r["payments_raw"]),
            staging.stg_cities(r["cities_raw"]),
            staging.stg_drivers(r["drivers_raw"]),
            staging.stg_riders(r["riders_raw"]),
            settings,
        )
        return df, {x.trip_id: x for x in df.collect()}

    return run


def trip(trip_id="1", status="completed", **more):
    base = dict(
        trip_id=trip_id, status=status, rider_id="r", driver_id="d", city_id="c", actual_fare=100, estimated_fare=90,
        surge_multiplier=1, is_corporate=False, requested_at=ts("05 10:00:00"), updated_at=ts("05 11:00:00"),
    )
    return {**base, **more}


def payment(payment_id, status, hour, fee, trip_id="1", **more):
    return dict(payment_id=payment_id, trip_id=trip_id, payment_status=status, amount=100, fee=fee,
                created_at=ts(f"05 {hour:02d}:00:00"), **more)


def test_newest_success_is_chosen_over_newer_failure(enrich):
    _, got = enrich(
        trips=[trip()],
        payments=[payment("p1", "success", 10, 1), payment("p2", "success", 11, 2), payment("p3", "failed", 12, 3)],
    )
    t = got["1"]
    assert (t.payment_id, t.failed_payment_count, t.success_payment_count) == ("p2", 1, 2)
    assert t.has_duplicate_payment and t.is_fraud_suspect and t.net_revenue == Decimal("78")


def test_fee_of_a_failed_payment_counts_without_success(enrich):
    _, got = enrich(trips=[trip()], payments=[payment("p1", "failed", 10, 3), payment("p2", "failed", 9, 5)])
    t = got["1"]
    assert (t.payment_id, t.net_revenue) == ("p1", Decimal("77"))
    assert t.is_completed_without_payment and t.is_fraud_suspect


def test_payment_ties_and_missing_times(enrich):
    _, got = enrich(
        trips=[trip()],
        payments=[payment("p1", "success", 10, 1), payment("p2", "success", 10, 2),
                  {**payment("p9", "success", 10, 9), "created_at": None}],
    )
    assert got["1"].payment_id == "p2"


def test_cash_trip_without_payment_rows_is_suspect_only_if_completed(enrich):
    _, got = enrich(trips=[trip("1", payment_method="cash"), trip("2", "cancelled", payment_method="cash")])
    assert got["1"].is_completed_without_payment and not got["2"].is_completed_without_payment
    assert not got["2"].is_fraud_suspect
    assert (got["1"].failed_payment_count, got["1"].success_payment_count) == (0, 0)


@pytest.mark.parametrize("surge, extreme", [(10, False), (10.1, True), (None, False)])
def test_extreme_surge_is_strict(enrich, surge, extreme):
    _, got = enrich(trips=[trip("1", "cancelled", surge_multiplier=surge)])
    assert (got["1"].is_extreme_surge, got["1"].is_fraud_suspect) == (extreme, extreme)


def test_missing_amounts(enrich):
    _, got = enrich(trips=[trip(actual_fare=None)], payments=[payment("p1", "success", 10, 3)])
    assert got["1"].net_revenue == Decimal("-3") and got["1"].fare_variance is None


def test_dimensions_join_left(enrich):
    _, got = enrich(
        trips=[trip("1"), trip("2", rider_id="x", driver_id=None, city_id="x")],
        cities=[dict(city_id="c", city_name="old town", country="gb")],
        drivers=[dict(driver_id="d", driver_status=" Active", rating=4.5, updated_at=ts("01 00:00:00"))],
        riders=[dict(rider_id="r", country="gb", referral_code="R1", signup_date=dt.date(2023, 5, 1))],
    )
    t = got["1"]
    assert (t.city_name, t.city_country, t.driver_status, t.referral_code) == ("Old Town", "GB", "active", "R1")
    assert (t.trip_year, t.trip_month, t.trip_month_key, t.trip_type) == (2024, 1, "2024-01", "personal")
    assert got["2"].city_name is None and got["2"].driver_status is None and got["2"].rider_country is None


@pytest.mark.parametrize(
    "trips, last_day, segment",
    [
        (20, 30, "champion"), (20, 31, "loyal"), (19, 30, "loyal"), (10, 60, "loyal"), (10, 61, "at_risk"),
        (9, 30, "recent"), (1, 31, "at_risk"), (1, 90, "at_risk"), (50, 91, "churned"),
    ],
)
def test_rider_segments(spark, trips, last_day, segment):
    df = spark.createDataFrame([(trips, last_day)], "total_trips long, days_since_last_trip long")
    assert df.select(intermediate.rider_segment().alias("s")).first().s == segment


@pytest.mark.parametrize("trips, tier", [(0, "bronze"), (49, "bronze"), (50, "silver"), (200, "gold"), (500, "platinum")])
def test_driver_tiers(spark, trips, tier):
    df = spark.createDataFrame([(trips,)], "n long")
    assert df.select(core.driver_tier(df.n).alias("t")).first().t == tier


@pytest.mark.parametrize("idle, churned", [(29, False), (30, True)])
def test_churn_limit_and_lifetime_totals(enrich, rows, settings, idle, churned):
    at = dt.datetime.combine(settings.as_of, dt.time(9)) - dt.timedelta(days=idle)
    df, _ = enrich(trips=[trip("1", requested_at=at), trip("2", "cancelled"), trip("3", requested_at=at, is_corporate=True)])
    events = staging.stg_driver_status_events(
        rows(
            "driver_status_events_raw",
            dict(event_id="1", driver_id="d", status="online", event_timestamp=ts("05 10:00:00")),
            dict(event_id="2", driver_id="d", status="offline", event_timestamp=ts("06 10:00:00")),
        )
    )
    got = intermediate.int_driver_lifetime_stats(df, events, settings).first()
    assert (got.lifetime_trips, got.corporate_trips, got.personal_trips) == (2, 1, 1)
    assert (got.is_churned, got.days_since_last_trip, got.last_online_at) == (churned, idle, ts("05 10:00:00"))


def test_dimension_rows_without_trips(enrich, raw, rows, settings):
    df, _ = enrich(trips=[trip("1", "cancelled")])
    r = raw(
        drivers=[dict(driver_id="d", city_id="c", onboarding_date=dt.date(2024, 1, 31))],
        riders=[dict(rider_id="r", referral_code="R1")],
        cities=[dict(city_id="c", city_name="x", launch_date=dt.date(2023, 12, 31))],
    )
    drivers, riders, cities = (
        plan(r[t])
        for plan, t in (
            (staging.stg_drivers, "drivers_raw"), (staging.stg_riders, "riders_raw"), (staging.stg_cities, "cities_raw"),
        )
    )
    events = staging.stg_driver_status_events(r["driver_status_events_raw"])
    stats = intermediate.int_driver_lifetime_stats(df, events, settings)
    driver = core.dim_drivers(drivers, cities, stats, settings).first()
    assert (driver.lifetime_trips, driver.driver_tier, driver.is_churned, driver.tenure_months) == (0, "bronze", None, 1)
    rider = core.dim_riders(riders, intermediate.int_rider_lifetime_value(df, settings)).first()
    assert (rider.total_trips, rider.rider_segment, rider.is_referred, rider.referral_code) == (0, None, None, "R1")
    city = core.dim_cities(cities, df, settings).first()
    assert (city.total_trips, city.total_gross_revenue, city.months_since_launch) == (0, Decimal(0), 2)


def test_payment_of_unknown_trip_keeps_a_null_city_and_a_key(enrich, rows):
    df, _ = enrich(trips=[trip("1")])
    payments = staging.stg_payments(rows("payments_raw", payment("p1", "failed", 10, 0, trip_id="unknown")))
    got = marts.fct_payment_reliability(payments, core.fct_trips(df)).first()
    assert got.city_id is None and len(got.fct_payment_reliability_sk) == 32
    assert (got.total_attempts, got.failed_payments, got.failed_on_completed_trip) == (1, 1, 0)
    assert (got.total_collected, got.payment_failure_rate_pct) == (Decimal(0), 100.0)


@pytest.mark.parametrize(
    "surge, payments, category",
    [
        (11, 2, "multiple_indicators"), (11, 0, "extreme_surge"), (11, 1, "extreme_surge"),
        (1, 2, "duplicate_payment"), (1, 0, "completed_no_payment"), (1, 1, None),
    ],
)
def test_fraud_categories(enrich, spark, surge, payments, category):
    df, _ = enrich(
        trips=[trip(surge_multiplier=surge)], payments=[payment(f"p{i}", "success", 10 + i, 1) for i in range(payments)]
    )
    drivers = spark.createDataFrame([], "driver_id string, city_name string, driver_tier string, driver_status string")
    riders = spark.createDataFrame([], "rider_id string, rider_segment string, total_trips long")
    got = marts.fct_fraud_monitoring(core.fct_trips(df), drivers, riders).collect()
    assert [r.fraud_category for r in got] == ([category] if category else [])
