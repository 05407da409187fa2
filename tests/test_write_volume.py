"""What the stored trips cost: rows cross the network by day once, narrow, and reads fit a task's memory."""

import datetime as dt

from faremill import Lake
from faremill.plans import core, intermediate, staging
from faremill.session import BYTES_PER_READ, prepare
from test_incremental import trip


def _moves(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions")


def test_fact_trips_are_written_where_they_are_read(spark, raw, settings, tmp_path, monkeypatch):
    from faremill.sources import tables

    days = [trip(str(i), 1 + i % 9) for i in range(60)]
    lake = Lake(spark, raw(trips=days), str(tmp_path / "lake"), settings)
    written = []
    write = tables.Store.write
    monkeypatch.setattr(tables.Store, "write", lambda self, df, *by: (written.append(_moves(df)), write(self, df, *by))[1])
    lake.ensure(["int_trips_enriched"])
    lake.refresh("fct_trips")
    # The staging views have no days; the enriched trips are dealt once and the facts not again.
    assert written[-2:] == [1, 0]
    rows = lake.table("fct_trips")
    assert rows.count() == 60
    assert {r.trip_date for r in rows.select("trip_date").collect()} == {dt.date(2024, 1, d) for d in range(1, 10)}
    fresh = Lake(spark, raw(trips=days), str(tmp_path / "fresh"), settings)
    assert rows.exceptAll(core.fct_trips(fresh.plan("int_trips_enriched"))).count() == 0
    # Without stored enriched trips the rows come in any order and are dealt.
    fresh.refresh("fct_trips")
    assert written[-1] == 1


def test_enriched_trips_are_dealt_before_derived_columns(raw, settings):
    r, dealt = raw(trips=[trip("1", 5)]), []
    tables = [getattr(staging, f"stg_{t}")(r[f"{t}_raw"]) for t in ("trips", "payments", "cities", "drivers", "riders")]
    rows = intermediate.int_trips_enriched(*tables, settings, deal=lambda df: (dealt.append(df.columns), df)[1])
    assert "trip_date" in dealt[0]
    assert not {"net_revenue", "fare_variance", "trip_month_key", "is_fraud_suspect"} & set(dealt[0])
    assert [x.trip_date for x in rows.select("trip_date").collect()] == [dt.date(2024, 1, 5)]


def test_reads_are_small_enough_to_sort(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "128MB")
        prepare(spark)
        assert int(spark.conf.get(name)) == BYTES_PER_READ
        spark.conf.set(name, "1m")
        prepare(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)
