import random
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from conftest import ts
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faremill.sources import history_table
from faremill.sources.history_table import append_run, read_history
from faremill.sources.versions import Store


@pytest.fixture
def snapshot(spark, tmp_path):
    path = str(tmp_path / "history")

    def run(*rows):
        source = spark.createDataFrame(list(rows), "driver_id string, driver_status string, updated_at timestamp")
        append_run(source, path, "driver_id", "updated_at")
        return history()

    def history():
        return sorted(
            (r.driver_id, r.driver_status, r.dbt_valid_from.day, r.dbt_valid_to and r.dbt_valid_to.day)
            for r in read_history(spark, path).collect()
        )

    run.path, run.history = path, history
    return run


def test_versions_open_and_close(snapshot):
    assert snapshot(("a", "active", ts("01 00:00:00")), ("b", "active", ts("01 00:00:00"))) == [
        ("a", "active", 1, None), ("b", "active", 1, None)]
    assert snapshot(("a", "suspended", ts("05 00:00:00")), ("b", "active", ts("01 00:00:00"))) == [
        ("a", "active", 1, 5), ("a", "suspended", 5, None), ("b", "active", 1, None)]
    assert snapshot(("a", "active", ts("07 00:00:00")), ("c", "active", ts("07 00:00:00"))) == [
        ("a", "active", 1, 5), ("a", "active", 7, None), ("a", "suspended", 5, 7), ("b", "active", 1, None),
        ("c", "active", 7, None)]


def test_same_or_older_input_adds_no_version(snapshot):
    first = snapshot(("a", "active", ts("05 00:00:00")))
    assert snapshot(("a", "active", ts("05 00:00:00"))) == first
    assert snapshot(("a", "changed", ts("05 00:00:00"))) == first
    assert snapshot(("a", "older", ts("04 00:00:00"))) == first
    assert snapshot(("a", "unknown", None)) == first


def test_unfinished_run_is_ignored_and_not_in_the_way(snapshot, spark, tmp_path):
    first = snapshot(("a", "active", ts("01 00:00:00")))
    # What a run leaves behind when it dies before its commit: files that no pointer names.
    spark.range(3).write.parquet(str(tmp_path / "history/data/run=rdead/state=open"))
    assert snapshot.history() == first
    assert snapshot(("a", "suspended", ts("05 00:00:00"))) == [("a", "active", 1, 5), ("a", "suspended", 5, None)]
    assert Store(spark, snapshot.path).last().number == 2


def test_random_runs_keep_one_open_version_and_no_overlaps(snapshot, spark):
    rng = random.Random(7)
    for _ in range(5):
        snapshot(*[(str(k), rng.choice("xyz"), ts("01 00:00:00") + timedelta(hours=rng.randrange(500))) for k in range(6)])
    h = read_history(spark, snapshot.path)
    per_driver = W.partitionBy("driver_id").orderBy("dbt_valid_from")
    chained = h.withColumn("next", F.lead("dbt_valid_from").over(per_driver))
    assert chained.where("not (dbt_valid_to <=> next)").count() == 0
    assert h.where("dbt_valid_to is null").count() == 6
    assert h.select("dbt_scd_id").distinct().count() == h.count()


def test_fifty_runs_leave_few_folders_and_the_whole_history(snapshot, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history_table, "MERGED_SETS", 4)
    for n in range(50):
        at = ts("01 00:00:00") + timedelta(hours=n)
        source = spark.createDataFrame([("a", f"s{n}", at), ("b", "same", ts("01 00:00:00")), (f"c{n}", "x", at)],
                                       "driver_id string, driver_status string, updated_at timestamp")
        append_run(source, snapshot.path, "driver_id", "updated_at")
    rows = read_history(spark, snapshot.path).where("driver_id = 'a'").orderBy("dbt_valid_from").collect()
    assert [r.driver_status for r in rows] == [f"s{n}" for n in range(50)]
    assert [r.dbt_valid_to for r in rows] == [r.dbt_valid_from for r in rows[1:]] + [None]
    assert read_history(spark, snapshot.path).count() == 101
    # Open rows and at most three closed sets a level, of this version and of the one before.
    assert len(Store(spark, snapshot.path).last().parts) <= 1 + 3 * 3
    assert len(list((tmp_path / "history/data").iterdir())) <= 14
    assert len(list((tmp_path / "history/_versions").glob("*.json"))) == 2


def test_two_writers_lose_nothing(spark, snapshot):
    first = [("a", "active", ts("01 00:00:00"))]
    snapshot(*first)

    def run(i):
        new = spark.createDataFrame([(f"d{i}", "x", ts("02 00:00:00"))], "driver_id string, driver_status string, updated_at timestamp")
        append_run(new, snapshot.path, "driver_id", "updated_at")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(run, range(4)))
    assert {d for d, *_ in snapshot.history()} == {"a", "d0", "d1", "d2", "d3"}
    assert Store(spark, snapshot.path).last().number == 5
