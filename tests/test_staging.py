import datetime as dt

import pytest
from conftest import ts

from faremill.operators.dedup import newest_per_key
from faremill.plans import staging


def test_newest_copy_wins_and_null_ids_are_dropped(rows):
    trips = rows(
        "trips_raw",
        dict(trip_id="1", status=" Completed\n", updated_at=ts("01 10:00:00")),
        dict(trip_id="1", status="cancelled", updated_at=ts("01 11:00:00")),
        dict(trip_id="1", status="no_show", updated_at=None),
        dict(trip_id=None, status="completed", updated_at=ts("01 12:00:00")),
    )
    got = staging.stg_trips(trips).collect()
    assert [(r.trip_id, r.trip_status) for r in got] == [("1", "cancelled")]


def test_ties_are_broken_by_the_remaining_columns(rows):
    at = ts("01 10:00:00")
    first, second = (dict(payment_id="1", trip_id=t, created_at=at, amount=5) for t in ("7", "8"))
    for order in ((first, second), (second, first)):
        got = staging.stg_payments(rows("payments_raw", *order).coalesce(1)).collect()
        assert [r.trip_id for r in got] == ["8"]


def test_dedup_changes_nothing_the_second_time(rows):
    riders = rows(
        "riders_raw",
        *[dict(rider_id=str(i % 5), created_at=ts(f"{1 + i:02d} 00:00:00"), country=" gb") for i in range(20)],
    )
    once = newest_per_key(riders, "rider_id", "created_at")
    assert once.exceptAll(newest_per_key(once, "rider_id", "created_at")).count() == 0
    assert once.count() == 5


def test_city_copies_stay(rows):
    cities = rows(
        "cities_raw",
        dict(city_id="1", city_name="new york", country=" us"),
        dict(city_id="1", city_name="new york", country=" us"),
        dict(city_id=None, city_name="nowhere"),
    )
    assert [(r.city_name, r.country) for r in staging.stg_cities(cities).collect()] == [("New York", "US")] * 2


@pytest.mark.parametrize(
    "table, plan, key",
    [
        ("trips_raw", staging.stg_trips, "trip_id"),
        ("drivers_raw", staging.stg_drivers, "driver_id"),
        ("riders_raw", staging.stg_riders, "rider_id"),
        ("payments_raw", staging.stg_payments, "payment_id"),
        ("cities_raw", staging.stg_cities, "city_id"),
        ("driver_status_events_raw", staging.stg_driver_status_events, "event_id"),
    ],
)
def test_null_key_is_dropped_everywhere(rows, table, plan, key):
    assert [r[key] for r in plan(rows(table, {key: None}, {key: "1"})).collect()] == ["1"]


def test_event_day_is_the_utc_day(rows):
    events = rows("driver_status_events_raw", dict(event_id="1", event_timestamp=ts("05 23:59:59")))
    assert staging.stg_driver_status_events(events).first().event_date == dt.date(2024, 1, 5)


def test_text_is_normalised(rows):
    drivers = rows("drivers_raw", dict(driver_id="1", driver_status="\tSUSPENDED ", rating=4.5))
    assert staging.stg_drivers(drivers).first().driver_status == "suspended"
    payments = rows("payments_raw", dict(payment_id="1", currency=" ngn", payment_provider="Stripe ", fee=1))
    got = staging.stg_payments(payments).first()
    assert (got.currency, got.payment_provider, int(got.processing_fee)) == ("NGN", "stripe", 1)
