import datetime as dt

import pytest
from conftest import ts

from faremill.operators import checks as c
from faremill.operators.freshness import LIMITS, source_freshness
from faremill.plans import declared_checks as d


def result(df):
    return {(r.model, r.column_name): r.failures for r in df.collect()}


def test_row_checks(spark):
    tables = {
        "t": spark.createDataFrame(
            [("completed", 1.0, 0), ("completed", -1.0, 1), ("completed", None, 0), ("cancelled", 0.0, 0)],
            "trip_status string, x double, n long",
        ),
        "u": spark.createDataFrame([(None,), (None,)], "x long"),
    }.__getitem__
    assert result(c.not_null(tables, {"t": ["x", "n"], "u": ["x"]})) == {("t", "x"): 1, ("t", "n"): 0, ("u", "x"): 2}
    assert result(c.at_least_zero(tables, {"t": ["x"], "u": ["x"]})) == {("t", "x"): 1, ("u", "x"): 0}
    assert result(c.positive_when_completed(tables, {"t": ["x"]})) == {("t", "x"): 2}
    assert result(c.not_zero_when_completed(tables, {"t": ["n"]})) == {("t", "n"): 2}


def test_unique_counts_repeated_values_and_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5), (None, 5)], "x string, y long")
    tables = {"t": df, "u": df.where("x = 'b'")}.__getitem__
    assert result(c.unique(tables, {"t": ["x", "y"], "u": ["x"]})) == {("t", "x"): 1, ("t", "y"): 1, ("u", "x"): 0}


def test_accepted_values_counts_distinct_unwanted_values(spark):
    df = spark.createDataFrame([("a", "q"), ("z", "q"), ("z", None), ("y", "r"), (None, "q")], "x string, y string")
    got = c.accepted_values({"t": df}.__getitem__, {"t": {"x": ["a"], "y": ["q", "r"]}})
    assert result(got) == {("t", "x"): 2, ("t", "y"): 0}


def test_relationships_count_child_rows(spark):
    tables = {
        "child": spark.createDataFrame([("a", "z"), ("z", "z"), ("z", None), (None, "a")], "k string, l string"),
        "keys": spark.createDataFrame([("a",), ("a",), (None,)], "k string"),
        "letters": spark.createDataFrame([("z",)], "l string"),
    }
    parents = {"child": {"k": "keys", "l": "letters"}}
    assert result(c.relationships(tables.__getitem__, parents)) == {("child", "k"): 2, ("child", "l"): 1}
    tables["child"] = tables["child"].where("k = 'a'")
    assert result(c.relationships(tables.__getitem__, parents)) == {("child", "k"): 0, ("child", "l"): 0}


def test_number_of_declared_checks():
    declared = [d.NOT_NULL, d.UNIQUE, d.ACCEPTED_VALUES, d.RELATIONSHIPS, d.EXPRESSION_IS_TRUE, d.NO_NEGATIVE_REVENUE,
                d.POSITIVE_TRIP_DURATION, d.COMPLETED_HAS_PAYMENT]
    assert [sum(len(v) for v in x.values()) for x in declared] == [54, 21, 16, 12, 2, 7, 1, 1]


def test_several_checks_share_one_pass(spark):
    df = spark.createDataFrame([("completed", None), ("completed", -1.0), ("completed", 0.0)], "trip_status string, x double")
    checks = {"a": ({"t": ["x"]}, c.is_missing), "b": ({"t": ["x", "x"], "u": ["x"]}, c.is_negative), "d": ({"t": ["x"]}, c.is_zero_when_completed)}
    got = c.count_failing_rows({"t": df, "u": df.where("false")}.__getitem__, checks)
    assert sorted(map(tuple, got.collect())) == [("a", "t", "x", 1), ("b", "t", "x", 1), ("b", "t", "x", 1), ("b", "u", "x", 0), ("d", "t", "x", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2


def test_what_fails(spark):
    trips = spark.createDataFrame(
        [("1", "1", "completed", 5.0), ("2", "2", "cancelled", None), ("2", None, "lost", -1.0), ("3", "9", "completed", None)],
        "trip_id string, driver_id string, trip_status string, actual_fare double",
    )
    tables = {"stg_trips": trips, "stg_drivers": spark.createDataFrame([("1",), ("2",)], "driver_id string")}.__getitem__
    rows = lambda *a: sorted(map(tuple, d.failing(a[0], tables, "stg_trips", a[1]).collect()), key=str)
    assert rows("dq_not_null", "actual_fare") == [("2", "2", "cancelled", None), ("3", "9", "completed", None)]
    assert rows("dq_expression_is_true", "actual_fare") == [("2", None, "lost", -1.0)]
    assert rows("dq_unique", "trip_id") == [("2", 2)]
    assert rows("dq_accepted_values", "trip_status") == [("lost", 1)]
    assert [r[1] for r in rows("dq_relationships", "driver_id")] == ["3"]
    with pytest.raises(ValueError, match="not declared"):
        rows("dq_unique", "driver_id")


@pytest.mark.parametrize("source", LIMITS)
def test_freshness_limits(spark, source):
    limit = LIMITS[source]
    now = ts("20 00:00:00")

    def status(age: dt.timedelta | None):
        df = spark.createDataFrame([(None if age is None else now - age,)], f"{limit.loaded_at} timestamp")
        return source_freshness({source: df}, now, {source: limit}).first().status

    warn, error, tick = dt.timedelta(hours=limit.warn_hours), dt.timedelta(hours=limit.error_hours), dt.timedelta(seconds=1)
    assert [status(a) for a in (warn, warn + tick, error, error + tick, None)] == ["pass", "warn", "warn", "error", "error"]
