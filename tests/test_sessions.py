import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import ts

from faremill.operators.sessions import daily_online_hours
from faremill.plans.staging import stg_driver_status_events


@pytest.fixture
def hours(rows):
    def run(*events):
        records = [
            dict(event_id=f"{i:05d}", driver_id=d, status=s, event_timestamp=t) for i, (d, s, t) in enumerate(events)
        ]
        staged = stg_driver_status_events(rows("driver_status_events_raw", *records))
        return {(r.driver_id, r.activity_date.day): r.online_hours for r in daily_online_hours(staged).collect()}

    return run


def test_session_ends_at_the_next_event_of_any_kind(hours):
    got = hours(
        ("a", "online", ts("05 10:00:00")), ("a", "online", ts("05 11:00:00")), ("a", "offline", ts("05 11:30:00"))
    )
    assert got == {("a", 5): 1.5}


def test_open_session_counts_eight_hours(hours):
    assert hours(("a", "online", ts("05 20:00:00"))) == {("a", 5): 8.0}


def test_session_over_midnight_belongs_to_its_start_day(hours):
    assert hours(("a", "online", ts("05 23:50:00")), ("a", "offline", ts("06 00:20:00"))) == {("a", 5): 0.5}


def test_session_can_end_days_later(hours):
    assert hours(("a", "online", ts("05 00:00:00")), ("a", "offline", ts("08 00:00:00"))) == {("a", 5): 72.0}


def test_only_whole_minutes_count(hours):
    got = hours(("a", "online", ts("05 10:00:30")), ("a", "offline", ts("05 10:02:29")))
    assert got == {("a", 5): 0.02}


def test_events_inside_one_minute(hours):
    got = hours(
        ("a", "online", ts("05 10:00:01")),
        ("a", "offline", ts("05 10:00:20")),
        ("a", "online", ts("05 10:00:59")),
        ("a", "offline", ts("05 11:00:58")),
        ("b", "online", ts("05 10:00:01")),
        ("b", "offline", ts("05 10:00:02")),
        ("c", "offline", ts("05 10:00:02")),
    )
    assert got == {("a", 5): 0.98, ("b", 5): 0.0}


def test_rows_without_time_or_driver_play_no_part(hours):
    got = hours(("a", "online", ts("05 10:00:00")), ("a", "offline", None), (None, "offline", ts("05 10:30:00")))
    assert got == {("a", 5): 8.0}


def brute_force(events):
    per_driver = defaultdict(list)
    for i, (driver, status, at) in enumerate(events):
        per_driver[driver].append((at, f"{i:05d}", status))
    minutes = defaultdict(int)
    for driver, log in per_driver.items():
        log.sort()
        for i, (at, _, status) in enumerate(log):
            until = log[i + 1][0] if i + 1 < len(log) else at + dt.timedelta(hours=8)
            if status == "online":
                minutes[driver, at.day] += int((until - at).total_seconds() // 60)
    return {key: round(m / 60, 2) for key, m in minutes.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force_with_one_dominant_driver(hours, seed):
    rng = random.Random(seed)
    events = [
        (
            rng.choice(["hot", "hot", "b", "c", "d"]),
            rng.choice(["online", "offline", "on break"]),
            ts("03 00:00:00") + dt.timedelta(microseconds=rng.choice([1_000_000, 17]) * rng.randrange(4 * 86_400)),
        )
        for _ in range(600)
    ]
    assert hours(*events) == brute_force(events)
