"""Monthly sales targets of cashiers and stores."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import in_month, money_sum, text_key, trimmed_upper
from tillworks.operators.grouping import merge_spellings
from tillworks.plans.kpi import AMOUNT, money, totals_per_id

# The reports' usual target, the width of the 'meets' band and the three labels.
TARGET = Decimal("9000000")
BAND = Decimal("999999.99")
BELOW = "Below Expectation"
MEETS = "Meets Expectation"
BEYOND = "Beyond Expectation"


def monthly_cashiers(facts: DataFrame, month: str) -> DataFrame:
    return (
        in_month(facts, month)
        .groupBy(trimmed_upper("cashier_id").alias("cashier_id"))
        .agg(F.sum("items_count").alias("TotalItems"), money_sum(AMOUNT).alias("TotalSales"))
        .select("cashier_id", F.lit(month).alias("SalesMonth"), "TotalItems", "TotalSales")
    )


def cashiers_below_target(facts: DataFrame, month: str, target: Decimal = TARGET) -> DataFrame:
    """Cashiers under the target. One exactly on it is in neither report."""
    rows = monthly_cashiers(facts, month).filter(F.col("TotalSales") < F.lit(target))
    return rows.orderBy(F.desc("TotalSales"), "cashier_id")


def cashiers_above_target(facts: DataFrame, month: str, target: Decimal = TARGET) -> DataFrame:
    rows = monthly_cashiers(facts, month).filter(F.col("TotalSales") > F.lit(target))
    return rows.orderBy(F.desc("TotalSales"), "cashier_id")


def performance(sales: Column, target: Decimal, band: Decimal) -> Column:
    return (
        F.when(sales < F.lit(target), BELOW)
        .when(sales.between(F.lit(target), F.lit(target + band)), MEETS)
        .otherwise(BEYOND)
    )


def store_target_all(
    facts: DataFrame, stores: DataFrame, month: str, target: Decimal = TARGET, band: Decimal = BAND
) -> DataFrame:
    """Every store's month against the target."""
    measures = {"TotalItems": F.sum("items_count"), "TotalSales": money_sum(AMOUNT)}
    totals = totals_per_id(in_month(facts, month), ["store_id"], measures).join(
        stores.select("store_id", "store_name"), "store_id"
    )
    named = money(merge_spellings(totals, ["store_name"], {n: F.sum(n) for n in measures}), "TotalSales")
    return named.select(
        "store_name",
        F.lit(month).alias("SalesMonth"),
        "TotalItems",
        "TotalSales",
        performance(F.col("TotalSales"), target, band).alias("PerformanceStatus"),
    ).orderBy(F.desc("TotalSales"), "store_name")


def store_target_one(
    facts: DataFrame,
    stores: DataFrame,
    store: str,
    month: str,
    target: Decimal = TARGET,
    band: Decimal = BAND,
) -> DataFrame:
    """One store's month, shown only when it is over the target."""
    chosen = stores.filter(text_key("store_name") == text_key(F.lit(store)))
    rows = store_target_all(facts, chosen, month, target, band)
    return rows.filter(F.col("TotalSales") > F.lit(target))
