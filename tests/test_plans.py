"""What the physical plans must and must not contain."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from faremill import Lake
from faremill.operators.incremental import since
from faremill.operators.sessions import daily_online_hours
from faremill.plans.lake import MODELS
from faremill.sources.orders_as_rides import ride_tables
from faremill.sources.raw import SCHEMAS, read_raw_files

FOLDER = "/root/testdata/sf0.001"


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    before = {}

    def put(options):
        for key, value in options.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def empty_lake(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    for table, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/raw/{table}")
    lake = Lake(spark, read_raw_files(spark, f"{folder}/raw"), f"{folder}/lake")
    lake.ensure(["stg_payments", "stg_drivers", "stg_riders"])
    return lake


@pytest.mark.parametrize("name", [m for m in MODELS if m != "q10_driver_history"])
def test_no_python_no_pairs(spark, name):
    lake = entry.full_load(spark, FOLDER)
    lake.ensure(MODELS[name].inputs)
    plan = text(lake.plan(name))
    for unwanted in ("Cartesian", "NestedLoop", "Python", "SinglePartition"):
        assert unwanted not in plan or (unwanted == "SinglePartition" and "count(1)" in plan), unwanted


def test_copies_are_dropped_before_the_shuffle(empty_lake):
    plan = text(empty_lake.plan("stg_trips"))
    assert plan.count("Exchange") == 1
    after, before = plan.split("Exchange", 1)
    assert "Final" in after and "Partial" in before


def test_trips_are_shuffled_once_for_dedup_and_payments(empty_lake, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = text(empty_lake.plan("int_trips_enriched"))
    keys = re.findall(r"Exchange hashpartitioning\((\w+?)#", plan)
    # Two sides per join: the trips' own exchange serves their dedup and the join to payments.
    assert sorted(keys) == sorted(2 * ["trip_id", "city_id", "driver_id", "rider_id"])


def test_small_dimensions_are_broadcast_by_size(empty_lake):
    plan = text(empty_lake.plan("int_trips_enriched"))
    assert re.findall(r"Exchange hashpartitioning\((\w+?)#", plan).count("city_id") == 0
    assert "BroadcastHashJoin" in plan


def test_load_window_reaches_the_scan(spark, empty_lake):
    day = dt.date(2024, 1, 20)
    lake = entry.full_load(spark, FOLDER)
    lake.ensure(["fct_trips", "dim_cities"])
    trips = lake.plan("fct_daily_revenue", day)
    assert re.search(r"PartitionFilters: \[[^\]]*trip_date#\d+ >= 2024-01-20", text(trips))
    raw = since(empty_lake.table("driver_status_events_raw"), "event_timestamp", day)
    assert "GreaterThanOrEqual(event_timestamp,2024-01-20" in text(raw)


def test_scans_read_only_the_columns_in_use(spark, conf):
    conf({"spark.sql.maxMetadataStringLength": "2000"})
    lake = entry.full_load(spark, FOLDER)
    lake.ensure(["fct_trips"])
    plan = text(lake.plan("q02_gross_vs_net"))
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", scan)) == {
        "trip_month_key", "trip_status", "trip_type", "gross_revenue", "net_revenue"}
    assert "EqualTo(trip_status,completed)" in plan


def test_a_hot_driver_and_missing_riders_are_split_at_run_time(spark, settings, conf, tmp_path):
    """A third of the trips have one driver and another third no rider."""
    raw = dict(ride_tables(spark, "/root/testdata/sf0.01"))
    third = F.crc32("trip_id") % 3
    raw["trips_raw"] = (
        raw["trips_raw"]
        .repartition(16, "trip_id")
        .withColumn("driver_id", F.when(third == 0, "7").otherwise(F.col("driver_id")))
        .withColumn("rider_id", F.when(third == 1, None).otherwise(F.col("rider_id")))
    )
    plain = Lake(spark, raw, str(tmp_path), settings)
    plain.ensure(["stg_payments", "stg_drivers", "stg_riders"])
    expected = plain.plan("int_trips_enriched").toArrow().sort_by("trip_id")
    conf({
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "15KB",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
    })
    df = plain.plan("int_trips_enriched")
    got = df.toArrow().sort_by("trip_id")
    final = text(df).split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin\(skew=true\) \[driver_id", final)
    assert re.search(r"SortMergeJoin\(skew=true\) \[rider_id", final)
    assert got.equals(expected)


def scans(plan, table):
    return len(re.findall(rf"Scan parquet [^\n]*InMemoryFileIndex[^\n]*/{table}/", plan))


def test_checks_read_each_table_a_few_times(spark, conf):
    conf({"spark.sql.maxMetadataStringLength": "400"})
    lake = entry.full_load(spark, FOLDER)
    lake.ensure([m for m in MODELS if MODELS[m].written])
    plan = text(lake.check_all())
    # Conditions on rows in one pass, repeated values in one, unwanted values in one.
    assert scans(plan, "fct_trips") == 3
    related = text(lake.check("dq_relationships"))
    # As a child once and as a parent once.
    assert scans(related, "stg_drivers") == 2 and scans(related, "stg_riders") == 1


def test_the_event_log_is_exchanged_once(empty_lake, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = text(daily_online_hours(empty_lake.table("stg_driver_status_events")))
    above, log = plan.split("WindowGroupLimit")[0], "Exchange hashpartitioning(driver_id"
    # By driver and hour, and one row an hour by driver; staging's own exchange by event lies below.
    assert above.count(log) == 2 and re.search(r"Exchange hashpartitioning\(driver_id#\d+, hour#\d+", above)
    assert "SortAggregate" not in above
