import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import ts

from faremill import Lake
from faremill.plans.lake import MODELS, waves
from faremill.sources import versions
from faremill.sources.tables import newest_day, overwrite_days, read_table, replace_table
from faremill.sources.versions import Store
from faremill.operators.incremental import reload_from


@pytest.fixture
def lake(spark, raw, settings, tmp_path):
    """Lakes over different raw data that share one folder."""

    def build(**tables):
        return Lake(spark, raw(**tables), str(tmp_path), settings)

    return build


def event(event_id, day, hour=10, status="online"):
    return dict(event_id=event_id, driver_id="d", status=status, event_timestamp=ts(f"{day:02d} {hour:02d}:00:00"))


def loaded(lake):
    return sorted((r.event_id, r.event_date.day) for r in lake.table("stg_driver_status_events").collect())


EVENTS = "stg_driver_status_events"


def test_late_rows_inside_the_look_back_are_loaded_and_older_ones_missed(lake):
    first = [event("a", 5), event("b", 9), event("c", 10)]
    lake(driver_status_events=first).refresh(EVENTS)
    second = lake(driver_status_events=[*first, event("late", 9), event("too late", 7), event("new", 11)])
    second.refresh(EVENTS)
    assert loaded(second) == [("a", 5), ("b", 9), ("c", 10), ("late", 9), ("new", 11)]


def test_rows_gone_from_a_reloaded_day_disappear_and_other_days_stay(lake):
    lake(driver_status_events=[event("a", 5), event("b", 9), event("c", 10)]).refresh(EVENTS)
    second = lake(driver_status_events=[event("b2", 9)])
    second.refresh(EVENTS)
    # Day 10 is inside the window but absent from the batch: it is not touched.
    assert loaded(second) == [("a", 5), ("b2", 9), ("c", 10)]


def test_full_refresh_repairs_everything(lake):
    lake(driver_status_events=[event("a", 5), event("c", 10)]).refresh(EVENTS)
    second = lake(driver_status_events=[event("late", 3), event("c", 10)])
    second.refresh(EVENTS, full_refresh=True)
    assert loaded(second) == [("c", 10), ("late", 3)]


def test_same_batch_twice_changes_nothing(lake):
    data = [event("a", 5), event("b", 9), event("c", 10)]
    one = lake(driver_status_events=data)
    one.refresh(EVENTS)
    before = loaded(one)
    one.refresh(EVENTS)
    assert loaded(one) == before


def test_event_id_with_copies_in_an_older_and_a_reloaded_day_stays_twice(lake):
    lake(driver_status_events=[event("a", 5), event("c", 10)]).refresh(EVENTS)
    second = lake(driver_status_events=[event("a", 5), event("a", 10), event("c", 10)])
    second.refresh(EVENTS)
    assert loaded(second) == [("a", 5), ("a", 10), ("c", 10)]


def test_empty_target_is_built_in_full(lake):
    lake().refresh(EVENTS)
    second = lake(driver_status_events=[event("a", 5), event("c", 10)])
    second.refresh(EVENTS)
    assert loaded(second) == [("a", 5), ("c", 10)]


def test_reload_from():
    assert reload_from(None) is None
    assert reload_from(dt.date(2024, 1, 9)) == dt.date(2024, 1, 8)


def test_newest_day_comes_from_the_pointer_without_a_job(spark, tmp_path):
    days = spark.sql("select day, 1 as n from values (date '2024-01-05'), (date '2024-01-09'), (null) as t(day)")
    overwrite_days(days, str(tmp_path / "t"), "day", ["n"], all_days=True)
    (tmp_path / "t/data/run=rdead/day=2024-01-20").mkdir(parents=True)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert newest_day(spark, str(tmp_path / "t")) == dt.date(2024, 1, 9)
    assert newest_day(spark, str(tmp_path / "none")) is None
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    assert sorted(str(r.day) for r in read_table(spark, str(tmp_path / "t")).collect()) == ["2024-01-05", "2024-01-09", "None"]


def test_a_load_that_dies_before_its_commit_changes_nothing(spark, lake, tmp_path):
    lake(driver_status_events=[event("a", 5), event("c", 10)]).refresh(EVENTS)
    full = lake(driver_status_events=[event("a", 5), event("c", 10), *[event(f"n{d}", d) for d in (9, 11, 12)]])

    def die(rows):
        assert rows.count() == 5
        raise RuntimeError("the driver dies")

    with pytest.raises(RuntimeError):
        full.refresh(EVENTS, audit=die)
    assert loaded(full) == [("a", 5), ("c", 10)]
    full.refresh(EVENTS)
    assert loaded(full) == [("a", 5), ("c", 10), ("n11", 11), ("n12", 12), ("n9", 9)]
    assert len(list((tmp_path / EVENTS / "data").iterdir())) == 2


def test_replaced_table_keeps_the_last_complete_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    assert read_table(spark, path) is None

    def write(n):
        replace_table(spark.range(n), path, ["id"])
        return read_table(spark, path).count()

    assert [write(1), write(2)] == [1, 2]
    before = read_table(spark, path)
    # A run that died before its commit is neither read nor in the way, and goes when it is old.
    (tmp_path / "table/data/run=rdead/_temporary").mkdir(parents=True)
    assert read_table(spark, path).count() == 2
    assert write(4) == 4
    assert before.count() == 2
    write(5)
    assert len(list((tmp_path / "table/data").iterdir())) == 3
    monkeypatch.setattr(versions, "ORPHAN_SECONDS", -1)
    write(6)
    assert len(list((tmp_path / "table/data").iterdir())) == 2


def test_one_of_two_writers_commits_and_the_other_looks_again(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "t"))
    schema = spark.range(1).schema
    assert store.commit(None, schema, {"all": "run=ra"}).number == 1
    assert store.commit(None, schema, {"all": "run=rb"}) is None
    first = store.last()
    # A pointer that its writer has yet to fill is in the way until it is old.
    (tmp_path / "t/_versions/00000002.json").touch()
    assert store.last() == first and store.commit(first, schema, {"all": "run=rb"}) is None
    monkeypatch.setattr(versions, "PENDING_SECONDS", -1)
    assert store.commit(first, schema, {"all": "run=rb"}).number == 3


def test_days_of_two_writers_at_once_are_all_there(spark, tmp_path):
    path = str(tmp_path / "days")

    def load(day):
        rows = spark.sql(f"select date '2024-01-{day:02d}' as day, {day} as n")
        overwrite_days(rows, path, "day", all_days=False)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, range(1, 9)))
    assert sorted((r.day.day, r.n) for r in read_table(spark, path).collect()) == [(d, d) for d in range(1, 9)]


def test_two_lakes_build_at_once(spark, lake):
    tables = dict(trips=[trip("1", 5), trip("2", 10)], driver_status_events=[event("a", 5)],
                  drivers=[dict(driver_id="d", city_id="c", driver_status="active", updated_at=ts("01 00:00:00"))])
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda one: one.build(), [lake(**tables), lake(**tables)]))
    assert all(set(d.values()) == {"built"} for d in done)
    one = lake(**tables)
    assert one.table("fct_trips").count() == 2 and one.table("drivers_snapshot").count() == 1
    assert one.table("fct_daily_revenue").count() == 2


def test_reads_write_nothing(lake, tmp_path):
    one = lake(trips=[trip("1", 5)])
    assert one.table("fct_trips").count() == 1
    assert one.table("drivers_snapshot").columns[-1] == "dbt_valid_to"
    assert not list(tmp_path.iterdir())
    one.ensure(["fct_trips"])
    assert {p.name for p in tmp_path.iterdir()} >= {"fct_trips", "int_trips_enriched", "stg_payments"}


def test_columns_come_back_in_declared_order(lake):
    one = lake(trips=[trip("1", 5)])
    names = ["fct_trips", "fct_daily_revenue", "fct_driver_activity", EVENTS, "int_trips_enriched"]
    planned = {n: one.plan(n).columns for n in names}
    one.ensure(names)
    assert {n: one.table(n).columns for n in names} == planned


def test_a_day_too_large_for_one_task_is_split_into_sorted_files(spark, tmp_path):
    skewed = spark.range(40_000).selectExpr(
        "date_add(date '2024-01-01', if(id % 3 = 0, 7, cast(id % 20 as int))) as day", "id", "md5(string(id)) as pad")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "300KB")
    try:
        overwrite_days(skewed.repartition(12), str(tmp_path / "days"), "day", ["id"], all_days=True)
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "days").glob("data/*/day=2024-01-08/*.parquet"))) > 1
    assert read_table(spark, str(tmp_path / "days")).count() == 40_000


def trip(trip_id, day, **more):
    at = ts(f"{day:02d} 10:00:00")
    return {**dict(trip_id=trip_id, status="completed", rider_id="r", driver_id="d", city_id="c", actual_fare=10,
                   surge_multiplier=1, is_corporate=False, requested_at=at, updated_at=at), **more}


def test_facts_follow_their_sources(lake):
    chain = ["int_trips_enriched", "fct_trips", "dim_cities", "fct_daily_revenue", EVENTS, "fct_driver_activity"]
    first = lake(trips=[trip("1", 5), trip("2", 10)], driver_status_events=[event("a", 5), event("c", 10)])
    for name in chain:
        first.refresh(name)
    second = lake(
        trips=[trip("1", 5), trip("late", 9), trip("missed", 6), trip("2", 10, actual_fare=30), trip("3", 11)],
        driver_status_events=[event("a", 5), event("c", 10), event("d", 10, 12, "offline")],
    )
    for name in chain:
        second.refresh(name)
    trips = {(r.trip_id, r.trip_date.day, int(r.gross_revenue)) for r in second.table("fct_trips").collect()}
    assert trips == {("1", 5, 10), ("late", 9, 10), ("2", 10, 30), ("3", 11, 10)}
    revenue = {(r.trip_date.day, int(r.gross_revenue)) for r in second.table("fct_daily_revenue").collect()}
    assert revenue == {(5, 10), (9, 10), (10, 30), (11, 10)}
    hours = {(r.activity_date.day, r.online_hours) for r in second.table("fct_driver_activity").collect()}
    # The session of day 5 was open when it was loaded, and its day is not loaded again.
    assert hours == {(5, 120.0), (9, 0.0), (10, 2.0), (11, 0.0)}


def test_incremental_equals_full_build_when_nothing_is_too_late(spark, lake, raw, settings, tmp_path):
    late = [trip(str(i), 1 + i % 9) for i in range(40)]
    early = [t for t in late if t["requested_at"].day <= 8]
    chain = ["int_trips_enriched", "fct_trips", "dim_cities", "fct_daily_revenue"]
    for tables in (early, late):
        two = lake(trips=tables)
        for name in chain:
            two.refresh(name)
    full = Lake(spark, raw(trips=late), str(tmp_path / "full"), settings)
    for name in ("fct_trips", "fct_daily_revenue"):
        columns = full.table(name).columns
        assert two.table(name).select(columns).exceptAll(full.table(name)).count() == 0
        assert two.table(name).count() == full.table(name).count()


def test_a_build_writes_inputs_first():
    order = {name: i for i, wave in enumerate(waves()) for name in wave}
    assert set(order) == {n for n, m in MODELS.items() if m.written}

    def sources(name):
        for source in MODELS[name].inputs:
            if source in MODELS:
                yield from [source] if MODELS[source].written else sources(source)

    assert all(order[s] < order[name] for name in order for s in sources(name))
    # Eleven stored tables and three kept staging views.
    assert [sum(m.stored for m in MODELS.values()), sum(m.kept for m in MODELS.values())] == [11, 3]
    checked = {name: i for i, wave in enumerate(waves(["trips_raw"])) for name in wave}
    assert checked["trips_raw"] < checked["stg_trips"] < checked["int_trips_enriched"] < checked["fct_trips"]


def test_build_runs_the_whole_project_twice(lake):
    tables = dict(
        trips=[trip("1", 5), trip("2", 10)],
        payments=[dict(payment_id="p", trip_id="1", payment_status="success", amount=10, created_at=ts("05 12:00:00"))],
        drivers=[dict(driver_id="d", city_id="c", driver_status="active", updated_at=ts("01 00:00:00"))],
        riders=[dict(rider_id="r", signup_date=dt.date(2023, 1, 1))],
        cities=[dict(city_id="c", city_name="x", country="gb")],
        driver_status_events=[event("a", 5)],
    )
    one = lake(**tables)
    one.build()
    one.build()
    assert one.table("fct_trips").count() == 2
    assert one.table("drivers_snapshot").count() == 1
    assert [r.trip_id for r in one.table("fct_fraud_monitoring").collect()] == ["2"]
    assert one.plan("q03_top_drivers").first().trips_completed == 2
    checks = {(r.check, r.model, r.column_name): r.failures for r in one.check_all().collect()}
    assert len(checks) == 114
    assert checks["dq_completed_has_payment", "fct_trips", "success_payment_count"] == 1


def test_failing_checks_keep_the_old_rows_and_stop_what_follows(lake):
    good = dict(
        trips=[trip("1", 5), trip("2", 10)],
        payments=[dict(payment_id=f"p{i}", trip_id=i, payment_status="success", payment_provider="stripe", amount=10,
                       created_at=ts("05 12:00:00")) for i in "12"],
        drivers=[dict(driver_id="d", city_id="c", driver_status="active", updated_at=ts("01 00:00:00"))],
        riders=[dict(rider_id="r", signup_date=dt.date(2023, 1, 1), created_at=ts("01 00:00:00"))],
        cities=[dict(city_id="c", city_name="x", country="gb")],
        driver_status_events=[event("a", 5)],
    )
    for row in good["trips"]:
        row.update(payment_method="card", pickup_at=row["requested_at"], dropoff_at=row["requested_at"] + dt.timedelta(minutes=9))
    done = lake(**good).build(check=True)
    assert set(done.values()) == {"built", "checked"}
    # A driver nobody knows: the relationship of the raw trips breaks, and all that reads them stays as it was.
    broken = {**good, "trips": [{**good["trips"][0], "driver_id": "nobody"}, *good["trips"][1:], trip("3", 11)]}
    second = lake(**broken)
    done = second.build(check=True)
    assert done["trips_raw"] == "trips_raw: dq_relationships on driver_id (1)"
    assert done["stg_trips"] == done["fct_trips"] == done["dim_cities"] == "skipped"
    assert sorted(r.trip_id for r in second.table("fct_trips").collect()) == ["1", "2"]
    assert [r.trip_id for r in second.failing("dq_relationships", "trips_raw", "driver_id").collect()] == ["1"]
    # A stored table that fails itself: its new rows are never seen.
    third = lake(**{**good, "trips": [*good["trips"], {**good["trips"][0], "trip_id": "4", "actual_fare": -5}]})
    allowed = {("dq_expression_is_true", "stg_trips", "actual_fare"), ("dq_completed_has_payment", "fct_trips", "success_payment_count")}
    done = third.build(full_refresh=True, check=True, warn=allowed)
    assert done["int_trips_enriched"] == "built"
    assert done["fct_trips"] == "fct_trips: dq_no_negative_revenue on gross_revenue (1), dq_no_negative_revenue on net_revenue (1)"
    assert done["fct_daily_revenue"] == done["fct_driver_activity"] == done["fct_fraud_monitoring"] == "skipped"
    assert sorted(r.trip_id for r in third.table("fct_trips").collect()) == ["1", "2"]
    done = third.build(full_refresh=True)
    assert set(done.values()) == {"built"}
    assert sorted(r.trip_id for r in third.table("fct_trips").collect()) == ["1", "2", "4"]


def test_a_report_over_a_range_of_days(lake):
    one = lake(trips=[trip(str(i), i) for i in range(1, 9)])
    one.ensure(["fct_daily_revenue", "fct_driver_activity", "fct_payment_reliability", "dim_drivers"])
    days = (dt.date(2024, 1, 3), dt.date(2024, 1, 6))
    assert sorted(r.trip_date.day for r in one.plan("q01_daily_revenue_by_city", days=days).collect()) == [3, 4, 5, 6]
    assert sorted(r.trip_date.day for r in one.plan("q01_daily_revenue_by_city", days=(days[0], None)).collect()) == [3, 4, 5, 6, 7, 8]
    assert one.plan("q01_daily_revenue_by_city", days=(None, None)).count() == 8
    assert one.plan("q03_top_drivers", days=days).count() == one.plan("q05_payment_failure_rate", days=days).count() == 0
    with pytest.raises(ValueError, match="range"):
        one.plan("q02_gross_vs_net", days=days)


def test_one_day_of_the_fact_table_opens_one_day_of_files(spark, lake):
    one = lake(trips=[trip(f"{day}-{i}", day) for day in range(1, 21) for i in range(5)])
    one.ensure(["int_trips_enriched"])
    whole = one.plan("fct_trips").inputFiles()
    last = one.plan("fct_trips", dt.date(2024, 1, 20))
    assert last.count() == 5
    scan = last._jdf.queryExecution().executedPlan().toString()
    assert "trip_date#" in scan and ">= 2024-01-20" in scan
    leaf = last._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert len(whole) >= 20 and leaf.selectedPartitions().totalNumberOfFiles() == sum("trip_date=2024-01-20" in f for f in whole)
