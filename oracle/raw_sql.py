"""The raw ride tables as SQL over the order-processing data set (text of FIXTURES.md)."""

from __future__ import annotations

CITIES = """
select n_nationkey as city_id, 'new-port of ' || lower(n_name) as city_name,
 case when n_regionkey % 2 = 0 then ' gb ' else 'ng' end as country,
 cast(timestamp '2019-01-15 00:00:00' + interval '1' day * (n_nationkey * 37) as date) as launch_date from nation
"""

DRIVERS = """
select s_suppkey as driver_id, s_suppkey * 3 + v.k as vehicle_id, s_nationkey as city_id,
 case when v.k = 0 then 'Inactive' when s_suppkey % 10 = 0 then 'suspended ' when s_suppkey % 10 = 1 then 'Inactive' else ' ACTIVE' end as driver_status,
 cast(10 + s_suppkey % 41 as decimal(10,1)) / 10 as rating,
 cast(timestamp '2020-01-01 00:00:00' + interval '1' day * (s_suppkey * 7 % 1400) as date) as onboarding_date,
 timestamp '2020-01-01 00:00:00' as created_at,
 timestamp '2024-01-01 00:00:00' + interval '1' day * (v.k * 10) as updated_at
 from supplier cross join (select 0 as k union all select 1 as k) v where v.k = 1 or s_suppkey % 5 = 0
"""

RIDERS = """
select c_custkey as rider_id, cast(timestamp '2022-01-01 00:00:00' + interval '1' day * (c_custkey % 700) as date) as signup_date,
 case when c_nationkey % 2 = 0 then ' gb' else 'Ng ' end as country,
 case when c_custkey % 3 = 0 then 'REF' || cast(c_nationkey as varchar(10)) end as referral_code,
 timestamp '2022-01-01 00:00:00' + interval '1' day * v.k as created_at
 from customer cross join (select 0 as k union all select 1 as k) v where v.k = 1 or c_custkey % 7 = 0
"""

TRIPS = """
select trip_id, rider_id, driver_id, driver_id * 3 + 1 as vehicle_id, city_id, status, payment_method, is_corporate,
 estimated_fare, actual_fare, surge_multiplier, requested_at,
 case when status like '%omplet%' then requested_at + interval '1' second * (trip_id % 900) end as pickup_at,
 case when status like '%omplet%' then requested_at + interval '1' second * (trip_id % 900 + trip_id % 5400 - 20) end as dropoff_at,
 requested_at as created_at, requested_at + interval '1' hour * (1 + k) as updated_at
from (select b.*, v.k,
  case when v.k = 0 and b.trip_id % 10 = 0 then 'no_show' when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then ' Completed ' when trip_id % 2 = 0 then 'cancelled' else 'NO_SHOW' end as status,
  timestamp '2024-01-01 00:00:00' + interval '1' day * (trip_id % 30 - case when rider_id % 10 = 9 then 120 else 0 end) + interval '1' second * (trip_id * 7919 % 86400) as requested_at
 from (select o_orderkey as trip_id, o_orderstatus,
   case when o_orderkey % 4 = 0 then o_custkey % 20 else o_custkey end as rider_id,
   case when o_orderkey % 3 = 0 then o_custkey % 5 when o_orderkey % 3 = 1 then 5 + o_custkey % 10 when o_custkey % 2 = 0 then o_custkey else 15 + o_custkey % 30 end % (select count(*) from supplier) as driver_id,
   c_nationkey as city_id,
   case o_orderpriority when '1-URGENT' then 'Card' when '2-HIGH' then 'wallet' when '3-MEDIUM' then ' cash' else 'card ' end as payment_method,
   c_mktsegment = 'MACHINERY' as is_corporate,
   cast(o_totalprice as decimal(18,2)) as actual_fare,
   cast(o_totalprice as decimal(18,2)) - o_orderkey % 7 as estimated_fare,
   1 + cast(case when o_orderkey % 5 < 3 then 0 else o_orderkey % 105 end as decimal(10,1)) / 10 as surge_multiplier
   from orders join customer on o_custkey = c_custkey) b
 cross join (select 0 as k union all select 1 as k) v where v.k = 1 or b.trip_id % 10 = 0) z
"""

PAYMENTS = """
select l_orderkey * 10 + l_linenumber as payment_id, l_orderkey as trip_id,
 case when l_returnflag = 'R' then ' FAILED' else 'success' end as payment_status,
 case when l_linestatus = 'F' then 'Stripe' else 'paypal ' end as payment_provider,
 cast(l_extendedprice as decimal(18,2)) as amount,
 cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as fee,
 case when l_suppkey % 2 = 0 then 'gbp' else ' NGN' end as currency,
 timestamp '2024-01-01 00:00:00' + interval '1' day * (l_orderkey % 30) + interval '1' second * (l_partkey * 37 % 86400) as created_at
 from lineitem
"""

EVENTS = """
select event_id, user_id % (select count(*) from supplier) as driver_id,
 case when event_type in ('click','view','purchase') then ' Online' else 'offline' end as status, ts as event_timestamp from events
"""

_T, _N, _B, _D, _S = "varchar", "decimal(29,9)", "boolean", "date", "timestamp"

#: raw table -> (query, its columns in order with their types)
RAW = {
    "trips_raw": (TRIPS, dict(
        trip_id=_T, rider_id=_T, driver_id=_T, vehicle_id=_T, city_id=_T, status=_T, payment_method=_T,
        is_corporate=_B, estimated_fare=_N, actual_fare=_N, surge_multiplier=_N,
        requested_at=_S, pickup_at=_S, dropoff_at=_S, created_at=_S, updated_at=_S)),
    "drivers_raw": (DRIVERS, dict(
        driver_id=_T, vehicle_id=_T, city_id=_T, driver_status=_T, rating=_N, onboarding_date=_D,
        created_at=_S, updated_at=_S)),
    "riders_raw": (RIDERS, dict(rider_id=_T, signup_date=_D, country=_T, referral_code=_T, created_at=_S)),
    "payments_raw": (PAYMENTS, dict(
        payment_id=_T, trip_id=_T, payment_status=_T, payment_provider=_T, amount=_N, fee=_N, currency=_T,
        created_at=_S)),
    "cities_raw": (CITIES, dict(city_id=_T, city_name=_T, country=_T, launch_date=_D)),
    "driver_status_events_raw": (EVENTS, dict(event_id=_T, driver_id=_T, status=_T, event_timestamp=_S)),
}


def raw_table(name: str, where: str = "true") -> str:
    query, columns = RAW[name]
    casts = ", ".join(f"cast({c} as {t}) as {c}" for c, t in columns.items())
    return f"select * from (select {casts} from ({query}) q) r where {where}"


def newest(name: str, source: str, key: str, stamp: str) -> str:
    """Rank-1 rows per key: the latest stamp, then the greatest remaining columns in order."""
    ties = [c for c in RAW[name][1] if c not in (key, stamp)]
    order = ", ".join(f"{c} desc nulls last" for c in (stamp, *ties))
    return (
        f"select * from {source} where {key} is not null "
        f"qualify row_number() over (partition by {key} order by {order}) = 1"
    )
