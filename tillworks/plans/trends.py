"""Revenue over time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import in_year, money_sum, week_of_year
from tillworks.plans.kpi import AMOUNT

TS = "transaction_date"


def revenue_by_timestamp(facts: DataFrame) -> DataFrame:
    return facts.groupBy(TS).agg(money_sum(AMOUNT).alias("DailyTotal")).orderBy(TS)


def revenue_daily(facts: DataFrame) -> DataFrame:
    day = F.to_date(TS).alias("transaction_date_only")
    return facts.groupBy(day).agg(money_sum(AMOUNT).alias("DailyTotal")).orderBy("transaction_date_only")


def revenue_weekly(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(F.year(TS).alias("Year"), week_of_year(TS).alias("WeekNumber"))
        .agg(money_sum(AMOUNT).alias("WeeklyTotal"))
        .select("WeekNumber", "Year", "WeeklyTotal")
        .orderBy("Year", "WeekNumber")
    )


def revenue_monthly(facts: DataFrame) -> DataFrame:
    # The month's name follows from its number, so it is worked out per group, not per row.
    totals = facts.groupBy(F.year(TS).alias("Year"), F.month(TS).alias("MonthNumber")).agg(
        money_sum(AMOUNT).alias("MonthlyTotal")
    )
    name = F.date_format(F.make_date("Year", "MonthNumber", F.lit(1)), "MMMM")
    return totals.select(name.alias("Month"), "MonthNumber", "Year", "MonthlyTotal").orderBy(
        "Year", "MonthNumber"
    )


def revenue_quarterly(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(F.year(TS).alias("Year"), F.quarter(TS).alias("Quarter"))
        .agg(money_sum(AMOUNT).alias("QuarterlyTotal"))
        .orderBy("Year", "Quarter")
    )


def revenue_yearly(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(F.year(TS).alias("Year"))
        .agg(money_sum(AMOUNT).alias("YearlyTotal"))
        .orderBy(F.desc("Year"))
    )


def monthly_revenue(facts: DataFrame, year: int) -> DataFrame:
    """The months of one year; the year becomes a range that prunes files."""
    return (
        in_year(facts, year)
        .groupBy(F.month(TS).alias("MonthNumber"))
        .agg(money_sum(AMOUNT).alias("TotalRevenue"))
        .orderBy("MonthNumber")
    )


def daily_revenue(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.to_date(TS).alias("report_date")).agg(money_sum(AMOUNT).alias("daily_revenue"))
