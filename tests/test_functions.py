import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from conftest import ts
from pyspark.sql import functions as F

from faremill.functions import keys, numbers, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def money(x):
    return F.lit(None if x is None else Decimal(x)).cast(numbers.NUMERIC)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("o'new-port of nation_3 (east)", "O'new-Port Of Nation_3 (East)"),
        ("ÉCOLE  of\tARTS", "École  Of\tArts"),
        ("a[b]c\\d|e", "A[B]C\\D|E"),
        (" two  words ", " Two  Words "),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, raw, expected):
    assert one(spark, text.title_case(F.lit(raw).cast("string"))) == expected


def test_trim_removes_all_white_space(spark):
    assert one(spark, text.lower_trim(F.lit("\tONLINE \n"))) == "online"
    assert one(spark, text.upper_trim(F.lit(" gb\r\n　"))) == "GB"
    assert one(spark, text.lower_trim(F.lit("a b"))) == "a b"


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("05 10:00:00", "05 10:01:30", 1.5),
        ("05 10:00:00", "05 10:00:00", None),
        ("05 10:00:20", "05 10:00:00", -0.33),
        ("05 10:00:00.900000", "05 10:00:02.100000", 0.02),
    ],
)
def test_duration_minutes(spark, start, end, expected):
    assert one(spark, times.duration_minutes(F.lit(ts(start)), F.lit(ts(end)))) == expected


def test_month_boundaries(spark):
    def months(later, earlier):
        return one(spark, times.month_boundaries(F.lit(later), F.lit(earlier)))

    assert months(dt.date(2024, 2, 1), dt.date(2024, 1, 31)) == 1
    assert months(dt.date(2024, 1, 31), dt.date(2024, 1, 1)) == 0
    assert months(dt.date(2024, 1, 1), dt.date(2022, 12, 31)) == 13


@pytest.mark.parametrize(
    "fare, fee, expected",
    [("100", "3.5", "76.5"), (None, "2", "-2"), ("10", None, "8"), (None, None, "0"), ("0.03", "0", "0.02")],
)
def test_net_revenue(spark, fare, fee, expected):
    got = one(spark, numbers.net_revenue(money(fare), money(fee), Decimal("0.20")))
    assert got == Decimal(expected)


def test_net_revenue_rounds_halves_away_from_zero(spark):
    got = one(spark, numbers.net_revenue(money("0"), money("0.005"), Decimal("0.20")))
    assert got == Decimal("-0.01")


@pytest.mark.parametrize("surge, expected", [("2", "50"), ("1", "0"), ("3", "66.666666667"), (None, "0")])
def test_surge_share(spark, surge, expected):
    assert one(spark, numbers.surge_share(money("100"), money(surge))) == Decimal(expected)


def test_safe_divide(spark):
    assert one(spark, numbers.safe_divide(F.lit(1), F.lit(3))) == 0.3333
    assert one(spark, numbers.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.safe_divide(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, numbers.safe_divide(money("1"), money("0"))) is None


def test_cents_to_pounds(spark):
    assert one(spark, numbers.cents_to_pounds(F.lit(1234))) == 12.34
    assert one(spark, numbers.cents_to_pounds(F.lit(None).cast("int"))) == 0.0


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", None, dt.date(2024, 1, 2))], "x string, y string, z date")
    got = df.select(keys.surrogate_key("x", "y", "z").alias("k")).first().k
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-2024-01-02").hexdigest()


def test_hundredths_average_is_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert df.select(numbers.hundredths_avg(F.col("x")).alias("a")).first().a == 0.15


def test_quotients_keep_nine_places(spark):
    assert one(spark, numbers.numeric_ratio(money("2"), money("3"))) == Decimal("0.666666667")
    assert one(spark, numbers.numeric_ratio(money("2"), money("0"))) is None
    assert one(spark, numbers.money_percent(money("1"), money("3"), 1)) == Decimal("33.3")
