"""Tables by name, in SQL."""

import pytest

from faremill import Lake
from faremill.sources.orders_as_rides import ride_tables

FOLDER = "/root/testdata/sf0.001"

REPORTS = {
    "q02_gross_vs_net": """
        select trip_month_key, trip_type, sum(gross_revenue) as gross_revenue, sum(net_revenue) as net_revenue,
               sum(gross_revenue - net_revenue) as total_deductions
        from {p}marts_core.fct_trips where trip_status = 'completed' group by trip_month_key, trip_type""",
    "q07_driver_churn": """
        select city_name, driver_tier, driver_status, count(*) as total_drivers, count_if(is_churned) as churned_drivers
        from {p}marts_core.dim_drivers group by city_name, driver_tier, driver_status""",
    "q08_fraud_summary": """
        select trip_date, fraud_category, count(*) as suspect_trips, sum(gross_revenue) as at_risk_revenue
        from {p}marts_fraud.fct_fraud_monitoring group by trip_date, fraud_category""",
    "q10_driver_history": """
        select driver_id, driver_status, dbt_valid_from, dbt_valid_to,
               if(dbt_valid_to is null, 'current', 'historical') as record_type
        from {p}snapshots.drivers_snapshot""",
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("named"))
    one = Lake(spark, ride_tables(spark, FOLDER), folder)
    one.build()
    one.register("t_")
    return one


@pytest.mark.parametrize("name", REPORTS)
def test_reports_as_sql_over_names(lake, name):
    found = lake.sql(REPORTS[name].format(p="t_"))
    wanted = lake.plan(name).select(*found.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_views_and_raw_tables_have_names(lake):
    assert lake.sql("select count(*) as n from stg_trips").first().n == lake.table("stg_trips").count()
    assert lake.sql("select * from q01_daily_revenue_by_city").columns == lake.plan("q01_daily_revenue_by_city").columns
    assert lake.sql("select count(*) as n from trips_raw").first().n > 0


def test_a_name_has_the_declared_columns_and_prunes_days(lake):
    named = lake.sql("select * from t_marts_core.fct_trips")
    assert named.columns == lake.plan("fct_trips").columns
    plan = lake.sql("select trip_id from t_marts_core.fct_trips where trip_date = date '2024-01-05'")
    assert "PartitionFilters: [isnotnull(trip_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_names_follow_new_versions_and_old_tables_go(lake, spark):
    for _ in range(3):
        lake.refresh("dim_cities")
        lake.refresh("fct_trips")
        lake.register("t_")
    for name in ("dim_cities", "fct_trips"):
        assert spark.table(f"t_marts_core.{name}").count() == lake.table(name).count()
        assert len([t for t in spark.catalog.listTables("t_marts_core") if t.name.startswith(f"{name}__v")]) == 2
