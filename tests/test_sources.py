import datetime as dt
from decimal import Decimal

from faremill.session import CHECKPOINT_DIR, input_bytes, prepare, shared_folder
from faremill.sources.orders_as_rides import ride_tables
from faremill.sources.raw import SCHEMAS, conform, read_raw_catalog

FOLDER = "/root/testdata/sf0.001"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_looser_raw_types_are_cast(spark):
    loose = spark.createDataFrame(
        [(7, "old town", "gb", dt.datetime(2020, 5, 1, 3))], "city_id long, city_name string, country string, launch_date timestamp"
    )
    got = conform(loose, "cities_raw")
    assert got.schema == SCHEMAS["cities_raw"]
    assert got.first().city_id == "7" and got.first().launch_date == dt.date(2020, 5, 1)


def test_catalog_tables(spark):
    for table, df in ride_tables(spark, FOLDER).items():
        df.createOrReplaceGlobalTempView(table)
    found = read_raw_catalog(spark, "global_temp")
    assert {t: df.schema.simpleString() for t, df in found.items()} == {t: s.simpleString() for t, s in SCHEMAS.items()}
    assert found["trips_raw"].count() == 1650


def test_derived_rides(spark):
    raw = ride_tables(spark, FOLDER)
    counts = {t: df.count() for t, df in raw.items()}
    assert counts == {
        "cities_raw": 25, "drivers_raw": 12, "riders_raw": 172, "trips_raw": 1650,
        "payments_raw": spark.read.parquet(f"{FOLDER}/lineitem.parquet").count(),
        "driver_status_events_raw": 1000,
    }
    top = raw["trips_raw"].agg({"surge_multiplier": "max"}).first()[0]
    assert top > Decimal(10)


def test_shuffles_are_sized_from_the_input(spark, monkeypatch):
    before = spark.conf.get(INITIAL, None)
    try:
        prepare(spark, FOLDER)
        assert spark.conf.get(INITIAL) == spark.conf.get("spark.sql.shuffle.partitions")
        assert input_bytes(spark, f"{FOLDER}/nation.parquet", f"{FOLDER}/region.parquet") > 1000
        monkeypatch.setattr("faremill.session.input_bytes", lambda *_: 100 * 1024**4)
        prepare(spark, FOLDER)
        assert spark.conf.get(INITIAL) == "819200"
        prepare(spark, FOLDER, bytes_per_partition=1024**3)
        assert spark.conf.get(INITIAL) == "102400"
    finally:
        spark.conf.unset(INITIAL) if before is None else spark.conf.set(INITIAL, before)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get(CHECKPOINT_DIR)
