"""One SQL statement per registered query.

Written apart from the Spark plans: windows where Spark uses aggregates, integer arithmetic where
Spark divides decimals. Amounts leave as doubles rounded to 4 places on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from oracle.raw_sql import RAW, newest, raw_table

TODAY = "date '2024-02-15'"
NOW = "timestamp '2024-01-31 00:00:00'"

#: What the first of two loads has received by 20 January: cash trips arrive five days late,
#: offline notices four days late.
ARRIVED = {
    "trips_raw": "updated_at + case when trim(payment_method) = 'cash' then interval 5 day else interval 0 day end"
    " <= timestamp '2024-01-20 00:00:00'",
    "payments_raw": "created_at <= timestamp '2024-01-20 00:00:00'",
    "driver_status_events_raw": "event_timestamp + case when status = 'offline' then interval 4 day"
    " else interval 0 day end <= timestamp '2024-01-20 00:00:00'",
}
EARLY_DRIVERS = "updated_at <= timestamp '2024-01-05 00:00:00'"

WORD_BREAKS = r"""\s\[\](){}/|<>!?@"^#$&~_,.:;*%+\-\\"""


# --- exact decimal arithmetic --------------------------------------------------------------

def dec(x: str) -> str:
    return f"cast({x} as decimal(29,9))"


def _units(x: str) -> str:
    """A decimal as a whole number of billionths."""
    return f"cast({dec(x)} * 1000000000 as hugeint)"


def _from_units(x: str) -> str:
    return f"cast(cast({x} as decimal(29,0)) * cast(0.000000001 as decimal(9,9)) as decimal(29,9))"


def quotient(a: str, b: str) -> str:
    """a / b to 9 places, half away from zero; null when b is 0."""
    top, bottom = _units(a), f"nullif({_units(b)}, 0)"
    size = f"(2 * abs({top}) * 1000000000 + abs({bottom})) // (2 * abs({bottom}))"
    return _from_units(f"sign({top}) * sign({bottom}) * ({size})")


def average(x: str) -> str:
    """avg of a decimal to 9 places, half away from zero."""
    total, n = f"sum({_units(x)})", f"nullif(count({x}), 0)"
    return _from_units(f"sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n}))")


def cents_average(x: str) -> str:
    """avg of a double with two decimals."""
    return f"avg(cast(round({x} * 100) as bigint)) / 100"


def total(x: str) -> str:
    return f"cast(sum({dec(x)}) as decimal(29,9))"


def count_where(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def pct_of_money(a: str, b: str, places: int) -> str:
    return dec(f"round({quotient(a, b)} * 100, {places})")


def sk(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


# --- scalar rules ---------------------------------------------------------------------------

def low(x: str) -> str:
    return f"lower(trim({x}, E' \\t\\n\\r'))"


def up(x: str) -> str:
    return f"upper(trim({x}, E' \\t\\n\\r'))"


def title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '[{WORD_BREAKS}]+|[^{WORD_BREAKS}]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '')"


def net(fare: str, fee: str) -> str:
    return dec(f"round(coalesce({fare}, 0) * cast(0.80 as decimal(3,2)) - coalesce({fee}, 0), 2)")


def minutes(start: str, end: str) -> str:
    return f"nullif(round(date_sub('second', {start}, {end}) / 60.0::double, 2), 0)"


# --- tables as common table expressions ------------------------------------------------------

class Chain:
    """Grows a WITH clause; ``suffix`` keeps the tables of two loads apart."""

    def __init__(self) -> None:
        self.parts: dict[str, str] = {}

    def add(self, name: str, sql: str) -> str:
        self.parts.setdefault(name, sql)
        return name

    def end(self, select: str) -> str:
        if not self.parts:
            return select
        ctes = ",\n".join(f"{name} as ({sql})" for name, sql in self.parts.items())
        return f"with {ctes}\n{select}"

    # raw and staging
    def raw(self, name: str, s: str = "", where: str | None = None) -> str:
        if where is None:
            where = ARRIVED.get(name, "true") if s == "_early" else "true"
        return self.add(name + s, raw_table(name, where))

    def stg_trips(self, s: str = "") -> str:
        src = self.add("new_trips" + s, newest("trips_raw", self.raw("trips_raw", s), "trip_id", "updated_at"))
        return self.add("stg_trips" + s, f"""select trip_id, rider_id, driver_id, vehicle_id, city_id, requested_at,
            pickup_at, dropoff_at, created_at, updated_at, {low('status')} as trip_status,
            {low('payment_method')} as payment_method, is_corporate, estimated_fare, actual_fare, surge_multiplier
            from {src}""")

    def stg_drivers(self, s: str = "", where: str | None = None) -> str:
        src = self.add("new_drivers" + s, newest("drivers_raw", self.raw("drivers_raw", s, where), "driver_id", "updated_at"))
        return self.add("stg_drivers" + s, f"""select driver_id, vehicle_id, city_id, {low('driver_status')} as driver_status,
            rating, onboarding_date, created_at, updated_at from {src}""")

    def stg_riders(self) -> str:
        src = self.add("new_riders", newest("riders_raw", self.raw("riders_raw"), "rider_id", "created_at"))
        return self.add("stg_riders", f"""select rider_id, signup_date, {up('country')} as country, referral_code,
            created_at from {src}""")

    def stg_payments(self, s: str = "") -> str:
        src = self.add("new_payments" + s, newest("payments_raw", self.raw("payments_raw", s), "payment_id", "created_at"))
        return self.add("stg_payments" + s, f"""select payment_id, trip_id, {low('payment_status')} as payment_status,
            {low('payment_provider')} as payment_provider, amount, fee as processing_fee, {up('currency')} as currency,
            created_at from {src}""")

    def stg_cities(self) -> str:
        src = self.raw("cities_raw")
        return self.add("stg_cities", f"""select city_id, {title('city_name')} as city_name, {up('country')} as country,
            launch_date from {src} where city_id is not null""")

    def status_events(self, s: str = "", since: str = "true") -> str:
        """Staged events of one load; ``since`` limits the raw rows it reads."""
        raw = self.raw("driver_status_events_raw", s)
        read = self.add("read_events" + s, f"select * from {raw} where {since}")
        src = self.add("new_events" + s, newest("driver_status_events_raw", read, "event_id", "event_timestamp"))
        return self.add("stg_driver_status_events" + s, f"""select event_id, driver_id, {low('status')} as driver_online_status,
            event_timestamp, cast(event_timestamp as date) as event_date from {src}""")

    # intermediate
    def enriched(self, s: str = "") -> str:
        trips, pay = self.stg_trips(s), self.stg_payments(s)
        cities, drivers, riders = self.stg_cities(), self.stg_drivers(), self.stg_riders()
        best = self.add("best_payment" + s, f"""select * from {pay} qualify row_number() over (partition by trip_id order by
            (payment_status is not distinct from 'success') desc, created_at desc nulls last, payment_id desc) = 1""")
        tally = self.add("payment_tally" + s, f"""select trip_id, {count_where("payment_status = 'failed'")} as bad,
            {count_where("payment_status = 'success'")} as good from {pay} group by trip_id""")
        base = self.add("trip_base" + s, f"""select t.*, b.payment_id, b.payment_status, b.payment_provider,
            b.amount as payment_amount, b.processing_fee, b.currency, b.created_at as payment_created_at,
            coalesce(y.bad, 0) as failed_payment_count, coalesce(y.good, 0) as success_payment_count,
            c.city_name, c.country as city_country, d.driver_status, d.rating as driver_rating,
            r.signup_date as rider_signup_date, r.country as rider_country, r.referral_code,
            coalesce(t.surge_multiplier > 10, false) as is_extreme_surge,
            coalesce(y.good, 0) >= 2 as has_duplicate_payment,
            coalesce(t.trip_status = 'completed', false) and coalesce(y.good, 0) = 0 as is_completed_without_payment
            from {trips} t left join {best} b on b.trip_id = t.trip_id left join {tally} y on y.trip_id = t.trip_id
            left join {cities} c on c.city_id = t.city_id left join {drivers} d on d.driver_id = t.driver_id
            left join {riders} r on r.rider_id = t.rider_id""")
        extra = dec(f"actual_fare - {quotient('actual_fare', 'surge_multiplier')}")
        return self.add("int_trips_enriched" + s, f"""select *, cast(requested_at as date) as trip_date,
            year(requested_at) as trip_year, month(requested_at) as trip_month,
            strftime(requested_at, '%Y-%m') as trip_month_key,
            {minutes('pickup_at', 'dropoff_at')} as trip_duration_minutes,
            {net('actual_fare', 'processing_fee')} as net_revenue, {dec('actual_fare - estimated_fare')} as fare_variance,
            case when surge_multiplier > 1 then {extra} else {dec('0')} end as surge_revenue_contribution,
            if(is_corporate, 'corporate', 'personal') as trip_type,
            is_extreme_surge or has_duplicate_payment or is_completed_without_payment as is_fraud_suspect
            from {base}""")

    def driver_stats(self) -> str:
        trips, events = self.enriched(), self.status_events()
        seen = self.add("seen_online", f"""select driver_id, max(event_timestamp) as last_online_at from {events}
            where driver_online_status = 'online' group by driver_id""")
        sums = self.add("driver_sums", f"""select driver_id, count(*) as lifetime_trips,
            {total('actual_fare')} as lifetime_gross_revenue, {total('net_revenue')} as lifetime_net_revenue,
            {average('actual_fare')} as avg_fare_per_trip,
            {cents_average('trip_duration_minutes')} as avg_trip_duration_minutes,
            {average('driver_rating')} as avg_driver_rating, min(trip_date) as first_trip_date,
            max(trip_date) as last_trip_date, {count_where('is_corporate')} as corporate_trips,
            {count_where('not is_corporate')} as personal_trips, {count_where('surge_multiplier > 1')} as surge_trips
            from {trips} where trip_status = 'completed' group by driver_id""")
        return self.add("int_driver_lifetime_stats", f"""select q.*, o.last_online_at,
            {TODAY} - q.last_trip_date as days_since_last_trip,
            coalesce({TODAY} - q.last_trip_date >= 30, false) as is_churned
            from {sums} q left join {seen} o on o.driver_id = q.driver_id""")

    def rider_value(self) -> str:
        trips = self.enriched()
        sums = self.add("rider_sums", f"""select rider_id, rider_signup_date, rider_country, referral_code,
            count(*) as total_trips, {total('actual_fare')} as total_gross_spend, {total('net_revenue')} as rider_ltv,
            {average('actual_fare')} as avg_fare, min(trip_date) as first_trip_date, max(trip_date) as last_trip_date,
            {count_where('is_corporate')} as corporate_trips, {count_where("payment_method = 'card'")} as card_trips,
            {count_where("payment_method = 'cash'")} as cash_trips, {TODAY} - max(trip_date) as days_since_last_trip,
            strftime(rider_signup_date, '%Y-%m') as signup_cohort
            from {trips} where trip_status = 'completed' group by all""")
        return self.add("int_rider_lifetime_value", f"""select *, referral_code is not null as is_referred,
            case when total_trips >= 20 and days_since_last_trip <= 30 then 'champion'
                 when total_trips >= 10 and days_since_last_trip <= 60 then 'loyal'
                 when days_since_last_trip <= 30 then 'recent'
                 when days_since_last_trip <= 90 then 'at_risk' else 'churned' end as rider_segment from {sums}""")

    # core
    def fct_trips(self, s: str = "") -> str:
        return self.add("fct_trips" + s, f"""select {sk('trip_id')} as fct_trip_sk, trip_id, rider_id, driver_id, vehicle_id,
            city_id, payment_id, trip_date, trip_year, trip_month, trip_month_key, trip_status, payment_method,
            payment_status, payment_provider, trip_type, is_corporate, trip_duration_minutes, estimated_fare,
            actual_fare as gross_revenue, net_revenue, fare_variance, processing_fee, payment_amount, surge_multiplier,
            surge_revenue_contribution, is_extreme_surge, has_duplicate_payment, is_completed_without_payment,
            is_fraud_suspect, failed_payment_count, success_payment_count, requested_at, pickup_at, dropoff_at,
            payment_created_at, created_at, updated_at from {self.enriched(s)}""")

    def dim_drivers(self) -> str:
        d, c, l = self.stg_drivers(), self.stg_cities(), self.driver_stats()
        return self.add("dim_drivers", f"""select d.driver_id, d.vehicle_id, d.city_id, c.city_name, c.country, d.driver_status,
            d.rating, d.onboarding_date, date_diff('month', d.onboarding_date, {TODAY}) as tenure_months,
            coalesce(l.lifetime_trips, 0) as lifetime_trips,
            coalesce(l.lifetime_gross_revenue, {dec('0')}) as lifetime_gross_revenue,
            coalesce(l.lifetime_net_revenue, {dec('0')}) as lifetime_net_revenue,
            l.avg_fare_per_trip, l.avg_trip_duration_minutes, l.first_trip_date, l.last_trip_date, l.corporate_trips,
            l.personal_trips, l.days_since_last_trip, l.is_churned, l.last_online_at,
            case when l.lifetime_trips >= 500 then 'platinum' when l.lifetime_trips >= 200 then 'gold'
                 when l.lifetime_trips >= 50 then 'silver' else 'bronze' end as driver_tier, d.created_at, d.updated_at
            from {d} d left join {c} c on c.city_id = d.city_id left join {l} l on l.driver_id = d.driver_id""")

    def dim_riders(self) -> str:
        r, v = self.stg_riders(), self.rider_value()
        return self.add("dim_riders", f"""select r.rider_id, r.signup_date, r.country, r.referral_code,
            coalesce(v.total_trips, 0) as total_trips, coalesce(v.total_gross_spend, {dec('0')}) as total_gross_spend,
            coalesce(v.rider_ltv, {dec('0')}) as rider_ltv, v.avg_fare, v.first_trip_date, v.last_trip_date,
            v.days_since_last_trip, v.corporate_trips, v.signup_cohort, v.rider_segment, v.is_referred, r.created_at
            from {r} r left join {v} v on v.rider_id = r.rider_id""")

    def dim_cities(self) -> str:
        c, t = self.stg_cities(), self.enriched()
        return self.add("dim_cities", f"""select c.city_id, c.city_name, c.country, c.launch_date,
            date_diff('month', c.launch_date, {TODAY}) as months_since_launch, count(t.trip_id) as total_trips,
            coalesce({total('t.actual_fare')}, {dec('0')}) as total_gross_revenue,
            min(t.trip_date) as first_trip_date, max(t.trip_date) as last_trip_date
            from {c} c left join {t} t on t.city_id = c.city_id and t.trip_status = 'completed'
            group by c.city_id, c.city_name, c.country, c.launch_date""")

    # marts
    def daily_revenue(self, s: str = "", trips: str | None = None, since: str = "true") -> str:
        trips, c = trips or self.fct_trips(s), self.stg_cities()
        sums = self.add("day_sums" + s, f"""select trip_date, city_id, trip_type, count(*) as total_trips,
            {total('gross_revenue')} as gross_revenue, {total('net_revenue')} as net_revenue,
            {total('processing_fee')} as total_processing_fees, {total('surge_revenue_contribution')} as surge_revenue,
            {average('surge_multiplier')} as avg_surge_multiplier,
            {cents_average('trip_duration_minutes')} as avg_trip_duration_minutes, {average('gross_revenue')} as avg_fare,
            {count_where('is_extreme_surge')} as extreme_surge_trips,
            {count_where('has_duplicate_payment')} as duplicate_payment_trips,
            {count_where('is_fraud_suspect')} as fraud_suspect_trips
            from {trips} where trip_status = 'completed' and {since} group by all""")
        return self.add("fct_daily_revenue" + s, f"""select {sk('q.trip_date', 'q.city_id', 'q.trip_type')} as fct_daily_revenue_sk,
            q.*, c.city_name, c.country, {pct_of_money('q.surge_revenue', 'q.gross_revenue', 2)} as surge_revenue_pct
            from {sums} q left join {c} c on c.city_id = q.city_id""")

    def payment_reliability(self) -> str:
        p, t = self.stg_payments(), self.fct_trips()
        sums = self.add("attempt_sums", f"""select cast(p.created_at as date) as payment_date, t.city_id, p.payment_provider,
            p.currency, count(*) as total_attempts, {count_where("p.payment_status = 'success'")} as successful_payments,
            {count_where("p.payment_status = 'failed'")} as failed_payments,
            {count_where("p.payment_status = 'failed' and t.trip_status = 'completed'")} as failed_on_completed_trip,
            {total("if(p.payment_status = 'success', p.amount, 0)")} as total_collected,
            {total("if(p.payment_status = 'failed', p.amount, 0)")} as total_failed_amount,
            {total("if(p.payment_status = 'success', p.processing_fee, 0)")} as total_fees
            from {p} p left join {t} t on t.trip_id = p.trip_id group by all""")
        return self.add("fct_payment_reliability", f"""select
            {sk('payment_date', 'city_id', 'payment_provider', 'currency')} as fct_payment_reliability_sk, *,
            round(failed_payments / total_attempts, 4) * 100 as payment_failure_rate_pct,
            {dec('total_collected - total_fees')} as net_collected from {sums}""")

    def driver_activity(self, s: str = "", trips: str | None = None, events: str | None = None, since: str = "true",
                        events_since: str = "true") -> str:
        trips, events = trips or self.fct_trips(s), events or self.status_events(s)
        spans = self.add("spans" + s, f"""select driver_id, event_date, driver_online_status, event_timestamp as went_on,
            lead(event_timestamp) over (partition by driver_id order by event_timestamp, event_id) as next_event
            from {events} where {events_since}""")
        hours = self.add("hours" + s, f"""select driver_id, event_date, round(cast(sum(date_sub('minute', went_on,
            coalesce(next_event, went_on + interval 8 hour))) as bigint) / 60.0::double, 2) as online_hours
            from {spans} where driver_online_status = 'online' group by all""")
        work = self.add("work" + s, f"""select driver_id, city_id, trip_date as activity_date, count(*) as trips_completed,
            {total('gross_revenue')} as gross_revenue, {total('net_revenue')} as net_revenue,
            {cents_average('trip_duration_minutes')} as avg_trip_duration_minutes,
            {count_where('is_corporate')} as corporate_trips, {count_where('surge_multiplier > 1')} as surge_trips
            from {trips} where trip_status = 'completed' and {since} group by all""")
        return self.add("fct_driver_activity" + s, f"""select {sk('w.driver_id', 'w.activity_date')} as fct_driver_activity_sk,
            w.*, coalesce(h.online_hours, 0) as online_hours,
            round({quotient('w.gross_revenue', 'h.online_hours')}, 4) as revenue_per_online_hour
            from {work} w left join {hours} h on h.driver_id = w.driver_id and h.event_date = w.activity_date""")

    def fraud(self) -> str:
        t, d, r = self.fct_trips(), self.dim_drivers(), self.dim_riders()
        return self.add("fct_fraud_monitoring", f"""select t.trip_id, t.trip_date, t.city_id, t.driver_id, t.rider_id,
            t.trip_status, t.gross_revenue, t.net_revenue, t.surge_multiplier, t.payment_method, t.payment_status,
            t.is_extreme_surge, t.has_duplicate_payment, t.is_completed_without_payment,
            case when t.is_extreme_surge then if(t.has_duplicate_payment, 'multiple_indicators', 'extreme_surge')
                 when t.has_duplicate_payment then 'duplicate_payment'
                 when t.is_completed_without_payment then 'completed_no_payment' else 'other' end as fraud_category,
            d.city_name, d.driver_tier, d.driver_status, r.rider_segment, r.total_trips as rider_total_trips,
            t.requested_at, t.payment_created_at
            from {t} t left join {d} d on d.driver_id = t.driver_id left join {r} r on r.rider_id = t.rider_id
            where t.is_fraud_suspect""")

    # two loads
    def merged(self, name: str, first: str, second: str, day: str) -> str:
        """Days of the second batch replace those of the first; all others stay."""
        return self.add(name, f"""select * from {first} where {day} not in (select {day} from {second})
            union all by name select * from {second}""")

    def loaded_events(self) -> str:
        first = self.status_events("_early")
        bound = f"cast(event_timestamp as date) >= (select max(event_date) - 1 from {first})"
        return self.merged("events_loaded", first, self.status_events("_late", bound), "event_date")

    def loaded_trips(self) -> str:
        first = self.fct_trips("_early")
        batch = self.add("trips_batch", f"""select * from {self.fct_trips()}
            where trip_date >= (select max(trip_date) - 1 from {first})""")
        return self.merged("trips_loaded", first, batch, "trip_date")

    def loaded_revenue(self) -> str:
        first, trips = self.daily_revenue("_early"), self.loaded_trips()
        bound = f"trip_date >= (select max(trip_date) - 1 from {first})"
        return self.merged("revenue_loaded", first, self.daily_revenue("_late", trips, bound), "trip_date")

    def loaded_activity(self) -> str:
        first = self.driver_activity("_early")
        newest_day = f"(select max(activity_date) - 1 from {first})"
        batch = self.driver_activity("_late", self.loaded_trips(), self.loaded_events(),
                                     f"trip_date >= {newest_day}", f"event_date >= {newest_day}")
        return self.merged("activity_loaded", first, batch, "activity_date")

    def history(self) -> str:
        old, new = self.stg_drivers("_old", EARLY_DRIVERS), self.stg_drivers()
        return self.add("drivers_snapshot", f"""
            select *, md5(driver_id || '|' || cast(updated_at as varchar) || '+00') as dbt_scd_id,
              updated_at as dbt_updated_at, updated_at as dbt_valid_from,
              lead(updated_at) over (partition by driver_id order by updated_at) as dbt_valid_to
            from (select * from {old} union select * from {new})""")


# --- final selects ---------------------------------------------------------------------------

#: Decimal columns, which leave as doubles rounded to 4 places, wherever they occur.
_AMOUNTS = {
    "estimated_fare", "actual_fare", "surge_multiplier", "rating", "amount", "processing_fee", "net_revenue",
    "fare_variance", "surge_revenue_contribution", "payment_amount", "driver_rating", "lifetime_gross_revenue",
    "lifetime_net_revenue", "avg_fare_per_trip", "avg_driver_rating", "total_gross_spend", "rider_ltv", "avg_fare",
    "gross_revenue", "total_gross_revenue", "total_processing_fees", "surge_revenue", "surge_revenue_pct",
    "avg_surge_multiplier", "total_collected", "total_failed_amount", "total_fees", "net_collected",
    "net_margin_pct", "total_deductions", "margin_pct", "avg_rating", "avg_ltv", "segment_total_ltv",
    "at_risk_revenue", "total_surge_revenue", "total_net_revenue", "ratio",
}
#: Columns that are doubles in the models and leave as they are.
_DOUBLES = {
    "trip_duration_minutes", "avg_trip_duration_minutes", "payment_failure_rate_pct", "online_hours",
    "revenue_per_online_hour", "total_online_hours", "avg_trips", "avg_days_since_last_trip", "failure_rate_pct",
    "surge_trip_pct", "churn_rate_pct", "avg_days_inactive", "age_seconds", "pounds",
}


def rounded(columns: Sequence[str | tuple[str, str]], source: str, tail: str = "") -> str:
    """Select columns (names, or a name and its expression), amounts as doubles to 4 places."""
    out = []
    for item in columns:
        name, expression = (item, item) if isinstance(item, str) else item
        if name in _AMOUNTS:
            expression = f"cast(round({expression}, 4) as double)"
        elif name in _DOUBLES:
            expression = f"cast({expression} as double)"
        out.append(f"{expression} as {name}")
    return f"select {', '.join(out)} from {source} {tail}"


STG_TRIPS = (
    "trip_id", "rider_id", "driver_id", "vehicle_id", "city_id", "requested_at", "pickup_at", "dropoff_at",
    "created_at", "updated_at", "trip_status", "payment_method", "is_corporate", "estimated_fare",
    "actual_fare", "surge_multiplier",
)
ENRICHED = (
    "trip_id", "rider_id", "driver_id", "vehicle_id", "city_id", "requested_at", "pickup_at", "dropoff_at",
    "created_at", "updated_at", "trip_date", "trip_year", "trip_month", "trip_month_key", "trip_status",
    "payment_method", "trip_duration_minutes", "estimated_fare", "actual_fare", "net_revenue", "fare_variance",
    "surge_multiplier", "surge_revenue_contribution", "is_corporate", "trip_type", "payment_id",
    "payment_status", "payment_provider", "payment_amount", "processing_fee", "currency", "payment_created_at",
    "failed_payment_count", "success_payment_count", "city_name", "city_country", "driver_status",
    "driver_rating", "rider_signup_date", "rider_country", "referral_code", "is_extreme_surge",
    "has_duplicate_payment", "is_completed_without_payment", "is_fraud_suspect",
)
FCT_TRIPS = (
    "fct_trip_sk", "trip_id", "rider_id", "driver_id", "vehicle_id", "city_id", "payment_id", "trip_date",
    "trip_year", "trip_month", "trip_month_key", "trip_status", "payment_method", "payment_status",
    "payment_provider", "trip_type", "is_corporate", "trip_duration_minutes", "estimated_fare", "gross_revenue",
    "net_revenue", "fare_variance", "processing_fee", "payment_amount", "surge_multiplier",
    "surge_revenue_contribution", "is_extreme_surge", "has_duplicate_payment", "is_completed_without_payment",
    "is_fraud_suspect", "failed_payment_count", "success_payment_count", "requested_at", "pickup_at",
    "dropoff_at", "payment_created_at", "created_at", "updated_at",
)
DAILY = (
    "fct_daily_revenue_sk", "trip_date", "city_id", "city_name", "country", "trip_type", "total_trips",
    "gross_revenue", "net_revenue", "total_processing_fees", "surge_revenue", "surge_revenue_pct",
    "avg_surge_multiplier", "avg_trip_duration_minutes", "avg_fare", "extreme_surge_trips",
    "duplicate_payment_trips", "fraud_suspect_trips",
)
ACTIVITY = (
    "fct_driver_activity_sk", "driver_id", "city_id", "activity_date", "trips_completed", "gross_revenue",
    "net_revenue", "avg_trip_duration_minutes", "corporate_trips", "surge_trips", "online_hours",
    "revenue_per_online_hour",
)
EVENTS = (
    "event_id", "driver_id", "driver_online_status", "event_timestamp", "event_date",
)


def _tables() -> dict[str, str]:
    def of(columns: str, table) -> str:
        chain = Chain()
        name = table(chain)
        return chain.end(rounded(columns, name))

    return {
        "stg_trips": of(STG_TRIPS, Chain.stg_trips),
        "stg_drivers": of((
    "driver_id", "vehicle_id", "city_id", "driver_status", "rating", "onboarding_date", "created_at",
    "updated_at",
),
                          Chain.stg_drivers),
        "stg_riders": of((
    "rider_id", "signup_date", "country", "referral_code", "created_at",
), Chain.stg_riders),
        "stg_payments": of((
    "payment_id", "trip_id", "payment_status", "payment_provider", "amount", "processing_fee", "currency",
    "created_at",
), Chain.stg_payments),
        "stg_cities": of((
    "city_id", "city_name", "country", "launch_date",
), Chain.stg_cities),
        "stg_driver_status_events": of(EVENTS, Chain.status_events),
        "int_trips_enriched": of(ENRICHED, Chain.enriched),
        "int_driver_lifetime_stats": of(
            (
    "driver_id", "lifetime_trips", "lifetime_gross_revenue", "lifetime_net_revenue", "avg_fare_per_trip",
    "avg_trip_duration_minutes", "avg_driver_rating", "first_trip_date", "last_trip_date", "corporate_trips",
    "personal_trips", "surge_trips", "last_online_at", "days_since_last_trip", "is_churned",
), Chain.driver_stats),
        "int_rider_lifetime_value": of(
            (
    "rider_id", "rider_signup_date", "rider_country", "referral_code", "total_trips", "total_gross_spend",
    "rider_ltv", "avg_fare", "first_trip_date", "last_trip_date", "corporate_trips", "card_trips", "cash_trips",
    "days_since_last_trip", "signup_cohort", "rider_segment", "is_referred",
), Chain.rider_value),
        "fct_trips": of(FCT_TRIPS, Chain.fct_trips),
        "dim_drivers": of(
            (
    "driver_id", "vehicle_id", "city_id", "city_name", "country", "driver_status", "rating", "onboarding_date",
    "tenure_months", "lifetime_trips", "lifetime_gross_revenue", "lifetime_net_revenue", "avg_fare_per_trip",
    "avg_trip_duration_minutes", "first_trip_date", "last_trip_date", "corporate_trips", "personal_trips",
    "days_since_last_trip", "is_churned", "last_online_at", "driver_tier", "created_at", "updated_at",
), Chain.dim_drivers),
        "dim_riders": of(
            (
    "rider_id", "signup_date", "country", "referral_code", "total_trips", "total_gross_spend", "rider_ltv",
    "avg_fare", "first_trip_date", "last_trip_date", "days_since_last_trip", "corporate_trips", "signup_cohort",
    "rider_segment", "is_referred", "created_at",
), Chain.dim_riders),
        "dim_cities": of(
            (
    "city_id", "city_name", "country", "launch_date", "months_since_launch", "total_trips",
    "total_gross_revenue", "first_trip_date", "last_trip_date",
), Chain.dim_cities),
        "fct_daily_revenue": of(DAILY, Chain.daily_revenue),
        "fct_payment_reliability": of(
            (
    "fct_payment_reliability_sk", "payment_date", "city_id", "payment_provider", "currency", "total_attempts",
    "successful_payments", "failed_payments", "failed_on_completed_trip", "total_collected",
    "total_failed_amount", "total_fees", "payment_failure_rate_pct", "net_collected",
), Chain.payment_reliability),
        "fct_driver_activity": of(ACTIVITY, Chain.driver_activity),
        "fct_fraud_monitoring": of(
            (
    "trip_id", "trip_date", "city_id", "driver_id", "rider_id", "trip_status", "gross_revenue", "net_revenue",
    "surge_multiplier", "payment_method", "payment_status", "is_extreme_surge", "has_duplicate_payment",
    "is_completed_without_payment", "fraud_category", "city_name", "driver_tier", "driver_status",
    "rider_segment", "rider_total_trips", "requested_at", "payment_created_at",
), Chain.fraud),
        "drivers_snapshot": of(
            (
    "driver_id", "vehicle_id", "city_id", "driver_status", "rating", "onboarding_date", "created_at",
    "updated_at", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to",
), Chain.history),
        "inc_status_events": of(EVENTS, Chain.loaded_events),
        "inc_fct_trips": of(FCT_TRIPS, Chain.loaded_trips),
        "inc_daily_revenue": of(DAILY, Chain.loaded_revenue),
        "inc_driver_activity": of(ACTIVITY, Chain.loaded_activity),
    }


def _reports() -> dict[str, str]:
    def of(table, columns: Sequence[str | tuple[str, str]], group: str = "", tail: str = "") -> str:
        chain = Chain()
        source = table(chain)
        return chain.end(rounded(columns, source, (f"group by {group} " if group else "") + tail))

    def completed(chain: Chain) -> str:
        return f"(select * from {chain.fct_trips()} where trip_status = 'completed') t"

    def activity(chain: Chain) -> str:
        return (
            f"(select a.*, d.city_name, d.driver_tier, d.driver_status, d.rating from {chain.driver_activity()} a"
            f" join {chain.dim_drivers()} d on d.driver_id = a.driver_id) x"
        )

    def completed_with_city(chain: Chain) -> str:
        return (
            f"(select t.*, c.city_name from {chain.fct_trips()} t left join {chain.stg_cities()} c"
            " on c.city_id = t.city_id where t.trip_status = 'completed') x"
        )

    def revenue_with_city(chain: Chain) -> str:
        return (
            f"(select r.* exclude (city_name, country), c.city_name, c.country, c.months_since_launch"
            f" from {chain.daily_revenue()} r join {chain.dim_cities()} c on c.city_id = r.city_id) x"
        )

    gross = ("gross_revenue", total("gross_revenue"))
    net_ = ("net_revenue", total("net_revenue"))
    margin = pct_of_money("sum(net_revenue)", "sum(gross_revenue)", 1)
    surging = count_where("surge_multiplier > 1")
    churned = count_where("is_churned")
    trips = ("total_trips", "cast(sum(total_trips) as bigint)")
    return {
        "q01_daily_revenue_by_city": of(
            Chain.daily_revenue,
            ("trip_date", "city_name", gross, net_, trips, ("net_margin_pct", margin)),
            "trip_date, city_name",
        ),
        "q02_gross_vs_net": of(
            completed,
            (
                "trip_month_key",
                "trip_type",
                gross,
                net_,
                ("total_deductions", dec("sum(gross_revenue - net_revenue)")),
                ("margin_pct", margin),
            ),
            "trip_month_key, trip_type",
        ),
        "q03_top_drivers": of(
            activity,
            (
                "driver_id",
                "city_name",
                "driver_tier",
                "driver_status",
                gross,
                net_,
                ("trips_completed", "cast(sum(trips_completed) as bigint)"),
                ("avg_rating", f"round({average('rating')}, 2)"),
                ("total_online_hours", "cast(sum(cast(round(online_hours * 100) as bigint)) as bigint) / 100"),
            ),
            "driver_id, city_name, driver_tier, driver_status",
            "order by sum(x.gross_revenue) desc, driver_id limit 10",
        ),
        "q04_rider_ltv_by_segment": of(
            Chain.dim_riders,
            (
                "rider_segment",
                ("rider_count", "count(*)"),
                ("avg_ltv", f"round({average('rider_ltv')}, 2)"),
                ("avg_trips", "round(avg(total_trips), 1)"),
                ("avg_days_since_last_trip", "round(avg(days_since_last_trip))"),
                ("segment_total_ltv", total("rider_ltv")),
            ),
            "rider_segment",
        ),
        "q05_payment_failure_rate": of(
            Chain.payment_reliability,
            (
                "payment_date",
                "payment_provider",
                "total_attempts",
                "successful_payments",
                "failed_payments",
                ("failure_rate_pct", "round(payment_failure_rate_pct, 2)"),
                "failed_on_completed_trip",
                ("at_risk_revenue", "total_failed_amount"),
            ),
        ),
        "q06_surge_impact": of(
            completed_with_city,
            (
                "trip_date",
                "city_name",
                ("total_trips", "count(*)"),
                ("surge_trips", surging),
                ("surge_trip_pct", f"round({surging} / count(*) * 100, 1)"),
                (
                    "avg_surge_multiplier",
                    f"round({average('case when surge_multiplier > 1 then surge_multiplier end')}, 2)",
                ),
                ("total_surge_revenue", total("surge_revenue_contribution")),
                ("surge_revenue_pct", pct_of_money("sum(surge_revenue_contribution)", "sum(gross_revenue)", 1)),
            ),
            "trip_date, city_name",
        ),
        "q07_driver_churn": of(
            Chain.dim_drivers,
            (
                "city_name",
                "driver_tier",
                "driver_status",
                ("total_drivers", "count(*)"),
                ("churned_drivers", churned),
                ("churn_rate_pct", f"round({churned} / count(*) * 100, 1)"),
                ("avg_days_inactive", "round(avg(days_since_last_trip))"),
            ),
            "city_name, driver_tier, driver_status",
        ),
        "q08_fraud_summary": of(
            Chain.fraud,
            (
                "trip_date",
                "fraud_category",
                ("suspect_trips", "count(*)"),
                ("at_risk_revenue", total("gross_revenue")),
                ("affected_cities", "string_agg(distinct city_name, ',' order by city_name)"),
            ),
            "trip_date, fraud_category",
        ),
        "q09_city_profitability": of(
            revenue_with_city,
            (
                "city_name",
                "country",
                "months_since_launch",
                ("total_gross_revenue", total("gross_revenue")),
                ("total_net_revenue", total("net_revenue")),
                trips,
                ("avg_fare", f"round({average('avg_fare')}, 2)"),
                ("total_surge_revenue", total("surge_revenue")),
                ("fraud_suspect_trips", "cast(sum(fraud_suspect_trips) as bigint)"),
            ),
            "city_name, country, months_since_launch",
        ),
        "q10_driver_history": of(
            Chain.history,
            (
                "driver_id",
                "driver_status",
                "vehicle_id",
                "rating",
                "dbt_valid_from",
                "dbt_valid_to",
                ("record_type", "if(dbt_valid_to is null, 'current', 'historical')"),
            ),
        ),
    }


def _macros() -> dict[str, str]:
    def of(table, key: str, name: str, expression: str) -> str:
        chain = Chain()
        source = table(chain)
        return chain.end(rounded((key, (name, expression)), source))

    pounds = "round(cast(amount * 100 as bigint) / 100.0::double, 2)"
    ratio = f"round({quotient('amount', 'processing_fee')}, 4)"
    duration = minutes("pickup_at", "dropoff_at")
    return {
        "macro_net_revenue": of(Chain.stg_payments, "payment_id", "net_revenue", net("amount", "processing_fee")),
        "macro_duration": of(Chain.stg_trips, "trip_id", "trip_duration_minutes", duration),
        "macro_cents_to_pounds": of(Chain.stg_payments, "payment_id", "pounds", pounds),
        "macro_safe_divide": of(Chain.stg_payments, "payment_id", "ratio", ratio),
        "macro_surrogate_key": of(Chain.stg_riders, "rider_id", "rider_referral_sk", sk("rider_id", "referral_code")),
    }


# --- checks ----------------------------------------------------------------------------------

_TABLE = {
    "stg_trips": Chain.stg_trips, "stg_drivers": Chain.stg_drivers, "stg_riders": Chain.stg_riders,
    "stg_payments": Chain.stg_payments, "stg_cities": Chain.stg_cities,
    "stg_driver_status_events": Chain.status_events, "fct_trips": Chain.fct_trips, "dim_drivers": Chain.dim_drivers,
    "dim_riders": Chain.dim_riders, "dim_cities": Chain.dim_cities, "fct_daily_revenue": Chain.daily_revenue,
    "fct_payment_reliability": Chain.payment_reliability, "fct_driver_activity": Chain.driver_activity,
    "fct_fraud_monitoring": Chain.fraud,
}


def _source(chain: Chain, name: str) -> str:
    return chain.raw(name) if name in RAW else _TABLE[name](chain)


# Every check, as the declared quality rules have them: table and column (and values or parent table).
NOT_NULL = (
    ("trips_raw", "trip_id"),
    ("trips_raw", "rider_id"),
    ("trips_raw", "driver_id"),
    ("trips_raw", "city_id"),
    ("trips_raw", "status"),
    ("trips_raw", "requested_at"),
    ("drivers_raw", "driver_id"),
    ("drivers_raw", "driver_status"),
    ("drivers_raw", "city_id"),
    ("riders_raw", "rider_id"),
    ("riders_raw", "signup_date"),
    ("payments_raw", "payment_id"),
    ("payments_raw", "trip_id"),
    ("payments_raw", "payment_status"),
    ("payments_raw", "amount"),
    ("payments_raw", "created_at"),
    ("cities_raw", "city_id"),
    ("cities_raw", "city_name"),
    ("cities_raw", "country"),
    ("driver_status_events_raw", "event_id"),
    ("driver_status_events_raw", "driver_id"),
    ("driver_status_events_raw", "status"),
    ("driver_status_events_raw", "event_timestamp"),
    ("stg_trips", "trip_id"),
    ("stg_trips", "rider_id"),
    ("stg_trips", "driver_id"),
    ("stg_trips", "city_id"),
    ("stg_trips", "actual_fare"),
    ("stg_trips", "requested_at"),
    ("stg_drivers", "driver_id"),
    ("stg_drivers", "city_id"),
    ("stg_riders", "rider_id"),
    ("stg_riders", "signup_date"),
    ("stg_payments", "payment_id"),
    ("stg_payments", "trip_id"),
    ("stg_payments", "amount"),
    ("stg_cities", "city_id"),
    ("stg_cities", "city_name"),
    ("stg_cities", "country"),
    ("stg_driver_status_events", "event_id"),
    ("stg_driver_status_events", "driver_id"),
    ("stg_driver_status_events", "event_timestamp"),
    ("stg_driver_status_events", "event_date"),
    ("fct_trips", "fct_trip_sk"),
    ("fct_trips", "trip_id"),
    ("fct_trips", "trip_date"),
    ("dim_drivers", "driver_id"),
    ("dim_riders", "rider_id"),
    ("dim_cities", "city_id"),
    ("dim_cities", "city_name"),
    ("fct_daily_revenue", "fct_daily_revenue_sk"),
    ("fct_payment_reliability", "fct_payment_reliability_sk"),
    ("fct_driver_activity", "fct_driver_activity_sk"),
    ("fct_fraud_monitoring", "trip_id"),
)
UNIQUE = (
    ("trips_raw", "trip_id"),
    ("drivers_raw", "driver_id"),
    ("riders_raw", "rider_id"),
    ("payments_raw", "payment_id"),
    ("cities_raw", "city_id"),
    ("driver_status_events_raw", "event_id"),
    ("stg_trips", "trip_id"),
    ("stg_drivers", "driver_id"),
    ("stg_riders", "rider_id"),
    ("stg_payments", "payment_id"),
    ("stg_cities", "city_id"),
    ("stg_driver_status_events", "event_id"),
    ("fct_trips", "fct_trip_sk"),
    ("fct_trips", "trip_id"),
    ("dim_drivers", "driver_id"),
    ("dim_riders", "rider_id"),
    ("dim_cities", "city_id"),
    ("fct_daily_revenue", "fct_daily_revenue_sk"),
    ("fct_payment_reliability", "fct_payment_reliability_sk"),
    ("fct_driver_activity", "fct_driver_activity_sk"),
    ("fct_fraud_monitoring", "trip_id"),
)
ACCEPTED = (
    ("trips_raw", "status", "'completed', 'cancelled', 'no_show'"),
    ("trips_raw", "payment_method", "'card', 'wallet', 'cash'"),
    ("drivers_raw", "driver_status", "'active', 'suspended', 'inactive'"),
    ("payments_raw", "payment_status", "'success', 'failed'"),
    ("payments_raw", "payment_provider", "'stripe', 'paypal'"),
    ("driver_status_events_raw", "status", "'online', 'offline'"),
    ("stg_trips", "trip_status", "'completed', 'cancelled', 'no_show'"),
    ("stg_trips", "payment_method", "'card', 'wallet', 'cash'"),
    ("stg_drivers", "driver_status", "'active', 'suspended', 'inactive'"),
    ("stg_payments", "payment_status", "'success', 'failed'"),
    ("stg_driver_status_events", "driver_online_status", "'online', 'offline'"),
    ("fct_trips", "trip_status", "'completed', 'cancelled', 'no_show'"),
    ("dim_drivers", "driver_status", "'active', 'suspended', 'inactive'"),
    ("dim_drivers", "driver_tier", "'bronze', 'silver', 'gold', 'platinum'"),
    ("dim_riders", "rider_segment", "'champion', 'loyal', 'recent', 'at_risk', 'churned'"),
    ("fct_fraud_monitoring", "fraud_category", "'extreme_surge', 'duplicate_payment', 'completed_no_payment', 'multiple_indicators', 'other'"),
)
PARENTS = (
    ("trips_raw", "rider_id", "riders_raw"),
    ("trips_raw", "driver_id", "drivers_raw"),
    ("trips_raw", "city_id", "cities_raw"),
    ("drivers_raw", "city_id", "cities_raw"),
    ("payments_raw", "trip_id", "trips_raw"),
    ("driver_status_events_raw", "driver_id", "drivers_raw"),
    ("stg_trips", "rider_id", "stg_riders"),
    ("stg_trips", "driver_id", "stg_drivers"),
    ("stg_trips", "city_id", "stg_cities"),
    ("stg_drivers", "city_id", "stg_cities"),
    ("stg_payments", "trip_id", "stg_trips"),
    ("stg_driver_status_events", "driver_id", "stg_drivers"),
)
AT_LEAST_ZERO = (
    ("stg_trips", "actual_fare"),
    ("stg_payments", "amount"),
)
NO_NEGATIVE_REVENUE = (
    ("fct_trips", "gross_revenue"),
    ("fct_trips", "net_revenue"),
    ("dim_drivers", "lifetime_gross_revenue"),
    ("dim_riders", "rider_ltv"),
    ("fct_daily_revenue", "gross_revenue"),
    ("fct_daily_revenue", "net_revenue"),
    ("fct_driver_activity", "gross_revenue"),
)


def _checks() -> dict[str, str]:
    def of(declared, query) -> str:
        chain = Chain()
        parts = []
        for model, column, *more in declared:
            sql = query(chain, _source(chain, model), column, *more)
            parts.append(f"select '{model}' as model, '{column}' as column_name, cast(({sql}) as bigint) as failures")
        return chain.end("\nunion all\n".join(parts))

    def rows(condition):
        return lambda chain, src, col: f"select count(*) from {src} where {condition.format(c=col)}"

    def repeated(chain, src, col):
        return f"select count(*) from (select {col} from {src} where {col} is not null group by {col} having count(*) > 1)"

    def unwanted(chain, src, col, values):
        return f"select count(distinct {col}) from {src} where {col} not in ({values})"

    def orphan(chain, src, key, parent):
        keys = _source(chain, parent)
        return (
            f"select count(*) from {src} c where c.{key} is not null and not exists "
            f"(select 1 from {keys} p where p.{key} = c.{key})"
        )

    duration, payments = [("fct_trips", "trip_duration_minutes")], [("fct_trips", "success_payment_count")]
    return {
        "dq_not_null": of(NOT_NULL, rows("{c} is null")),
        "dq_unique": of(UNIQUE, repeated),
        "dq_accepted_values": of(ACCEPTED, unwanted),
        "dq_relationships": of(PARENTS, orphan),
        "dq_expression_is_true": of(AT_LEAST_ZERO, rows("not ({c} >= 0)")),
        "dq_no_negative_revenue": of(NO_NEGATIVE_REVENUE, rows("{c} < 0")),
        "dq_positive_trip_duration": of(duration, rows("trip_status = 'completed' and coalesce({c}, 0) <= 0")),
        "dq_completed_has_payment": of(payments, rows("trip_status = 'completed' and {c} = 0")),
    }


def _freshness() -> dict[str, str]:
    # source -> (load column, hours to a warning, hours to an error)
    limits = {
        "trips_raw": ("updated_at", 1, 2), "drivers_raw": ("updated_at", 6, 24), "riders_raw": ("created_at", 12, 48),
        "payments_raw": ("created_at", 2, 6), "cities_raw": ("launch_date", 1, 2),
        "driver_status_events_raw": ("event_timestamp", 1, 3),
    }
    chain, parts = Chain(), []
    for name, (column, warn, error) in limits.items():
        src = chain.raw(name)
        parts.append(f"""select '{name}' as source, max_loaded_at,
            cast(date_sub('microsecond', max_loaded_at, {NOW}) / 1e6 as double) as age_seconds,
            case when max_loaded_at + interval {error} hour < {NOW} then 'error'
                 when max_loaded_at + interval {warn} hour < {NOW} then 'warn' else 'pass' end as status
            from (select cast(max({column}) as timestamp) as max_loaded_at from {src})""")
    return {"source_freshness": chain.end("\nunion all\n".join(parts))}


def statements() -> dict[str, str]:
    return {**_tables(), **_reports(), **_macros(), **_checks(), **_freshness()}
