"""Column expressions against plain Python."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tillworks.functions import (
    average_ticket,
    blank_to_null,
    city_key,
    count_if_null,
    count_when,
    discounted,
    full_price,
    in_month,
    in_year,
    money_sum,
    percent_of,
    text_key,
    week_of_year,
)
from tillworks.plans.targets import performance


def test_text_key_ignores_case_and_trailing_blanks_only(spark):
    df = spark.createDataFrame([("Cash ",), ("CASH",), (" cash",), (None,)], "v string")
    assert [r[0] for r in df.select(text_key("v")).collect()] == ["CASH", "CASH", " CASH", None]


def test_no_city_has_one_key(spark):
    df = spark.createDataFrame([("",), (None,), ("  ",), ("Abuja",)], "v string")
    assert [tuple(r) for r in df.select(city_key("v"), blank_to_null("v")).collect()] == [
        ("", None), ("", None), ("", None), ("ABUJA", "Abuja"),
    ]


def test_discount_spellings(spark):
    values = ["TRUE", "True", "true", "1", "1 ", "FALSE", "False", "0", "yes", "", None]
    df = spark.createDataFrame([(v,) for v in values], "discount_applied string")
    got = df.agg(count_when(discounted()), count_when(full_price())).first()
    assert tuple(got) == (5, 3)


def test_counting_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    assert tuple(df.agg(count_if_null("v"), count_when(F.col("v") == "z")).first()) == (None, 0)


def sunday_week(day: dt.date) -> int:
    first = day.replace(month=1, day=1)
    start = first - dt.timedelta(days=(first.weekday() + 1) % 7)
    return (day - start).days // 7 + 1


def test_week_of_year_against_a_calendar(spark):
    # Every day of 28 years holds all start weekdays in common and leap years.
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(28 * 366)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", week_of_year("d").alias("w"))
    assert [r for r in df.collect() if r["w"] != sunday_week(r["d"])] == []


def test_average_rounds_half_up_to_six_places(spark):
    df = spark.createDataFrame([(Decimal("100.00"), 3), (Decimal("0.01"), 8000), (None, 0)], "t decimal(38,2), n bigint")
    got = [r[0] for r in df.select(average_ticket(F.col("t"), F.col("n"))).collect()]
    assert got == [Decimal("33.333333"), Decimal("0.000001"), None]


def test_percent(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00"))], "a decimal(38,2), b decimal(38,2)")
    assert df.select(percent_of(F.col("a"), F.col("b"))).first()[0] == Decimal("33.33")


@pytest.mark.parametrize("month", ["2024-02", "2024-12"])
def test_month_filter_has_exact_edges(facts, month):
    year, m = map(int, month.split("-"))
    start = dt.datetime(year, m, 1)
    end = (start + dt.timedelta(days=32)).replace(day=1)
    inside = [start, end - dt.timedelta(microseconds=1)]
    outside = [start - dt.timedelta(microseconds=1), end]
    df = facts(*[{"transaction_id": f"{i}", "transaction_date": str(t)} for i, t in enumerate(inside + outside)])
    assert rows_of(in_month(df, month), "transaction_id") == [("0",), ("1",)]


def test_year_filter_has_exact_edges(facts):
    times = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-12-31 23:59:59.999999", "2025-01-01 00:00:00"]
    df = facts(*[{"transaction_id": f"{i}", "transaction_date": t} for i, t in enumerate(times)])
    assert rows_of(in_year(df, 2024), "transaction_id") == [("1",), ("2",)]


def test_target_bands_have_exact_edges(spark):
    target, band = Decimal("9000000"), Decimal("999999.99")
    sales = ["8999999.99", "9000000.00", "9000000.01", "9999999.98", "9999999.99", "10000000.00"]
    df = spark.createDataFrame([(Decimal(s),) for s in sales], "s decimal(38,2)")
    got = [r[0].split()[0] for r in df.select(performance(F.col("s"), target, band)).collect()]
    assert got == ["Below", "Meets", "Meets", "Meets", "Meets", "Beyond"]


@pytest.mark.parametrize(
    "amounts",
    [
        ["9999999999.99"] * 50,
        ["-0.01", "-1.50", "-1048576.99", "-9999999999.99", "0.00", None],
        ["1048575.99", "1048576.00", "1048576.01", "0.99", "-3.10"],
        [None, None],
        [],
    ],
)
def test_money_sum_is_the_exact_sum(spark, amounts):
    values = [None if a is None else Decimal(a) for a in amounts]
    df = spark.createDataFrame([(v,) for v in values], "a decimal(12,2)").agg(money_sum("a").alias("s"), F.sum("a").alias("p"))
    assert df.dtypes[0] == ("s", "decimal(38,2)")
    present = [v for v in values if v is not None]
    assert tuple(df.first()) == ((sum(present), sum(present)) if present else (None, None))


def test_money_sum_on_random_amounts(spark):
    df = spark.range(20000).select(((F.rand(5) - 0.3) * 2e6).cast("decimal(12,2)").alias("a"), (F.col("id") % 7).alias("g"))
    rows = df.groupBy("g").agg(money_sum("a").alias("s"), F.sum("a").alias("p")).collect()
    assert len(rows) == 7 and all(r["s"] == r["p"] for r in rows)
