"""Revenue, store, cashier, payment and loyalty reports.

Reports by store or payment method first total the facts per id, with map-side partial sums, and
join the dimension to those totals: the facts themselves are never joined, whatever the size of
the dimension, and a store that holds a third of the rows is one row after the first step.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillworks.functions import (
    average_ticket,
    count_when,
    discounted,
    full_price,
    money_sum,
    percent_of,
    text_key,
    total_of_sums,
)
from tillworks.operators.grouping import merge_spellings, total_by_text
from tillworks.operators.ordering import rank_descending

AMOUNT = "total_amount_ngn"


def totals_per_id(facts: DataFrame, ids: list[str], measures: dict[str, Column]) -> DataFrame:
    """Sums and counts per foreign key; facts without the key are left out, as in an inner join."""
    present = facts
    for key in ids:
        present = present.filter(F.col(key).isNotNull())
    return present.groupBy(*ids).agg(*[m.alias(n) for n, m in measures.items()])


def by_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, text: str, measures: dict[str, Column]
) -> DataFrame:
    """Totals of the facts by a text column of a dimension."""
    totals = totals_per_id(facts, [key], measures).join(dimension.select(key, text), key)
    return merge_spellings(totals, [text], {n: F.sum(n) for n in measures})


def money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(38,2)") for c in columns})


# -- counts --------------------------------------------------------------------------------------


def store_count(stores: DataFrame) -> DataFrame:
    return stores.agg(F.countDistinct(text_key("store_name")).alias("Store_Count"))


def city_count(stores: DataFrame) -> DataFrame:
    return stores.agg(F.countDistinct(text_key("city")).alias("City_count"))


def cashier_count(facts: DataFrame) -> DataFrame:
    return facts.agg(F.countDistinct(text_key("cashier_id")).alias("Cashier_Count"))


def receipt_count(facts: DataFrame) -> DataFrame:
    return facts.agg(F.countDistinct(text_key("receipt_number")).alias("ReceiptCount"))


def total_items(facts: DataFrame) -> DataFrame:
    return facts.agg(F.sum("items_count").alias("Total_Items_Count"))


# -- revenue -------------------------------------------------------------------------------------


def revenue_overview(facts: DataFrame) -> DataFrame:
    rows, revenue = F.count("*"), money_sum(AMOUNT)
    return facts.agg(
        rows.alias("total_transactions"),
        revenue.alias("total_revenue"),
        average_ticket(revenue, rows).alias("avg_transaction_value"),
        count_when(discounted()).alias("transactions_with_discount"),
        count_when(full_price()).alias("transactions_without_discount"),
        F.sum("loyalty_points_earned").alias("total_loyalty_points"),
    )


def revenue_by_city(facts: DataFrame, stores: DataFrame) -> DataFrame:
    totals = by_dimension(facts, stores, "store_id", "city", {"total_revenue": money_sum(AMOUNT)})
    return money(totals, "total_revenue").orderBy(F.desc("total_revenue"), "city")


def revenue_per_store(facts: DataFrame, stores: DataFrame) -> DataFrame:
    totals = by_dimension(facts, stores, "store_id", "store_name", {"total_revenue": money_sum(AMOUNT)})
    return money(totals, "total_revenue")


def city_revenue_rank(facts: DataFrame, stores: DataFrame, top: int = 5) -> DataFrame:
    """Cities ranked within themselves, as the report is defined, so every rank is 1."""
    totals = by_dimension(facts, stores, "store_id", "city", {"total_revenue": money_sum(AMOUNT)})
    return _ranked_in_city(money(totals, "total_revenue"), top).orderBy("city", "revenue_rank")


def top_stores_per_city(facts: DataFrame, stores: DataFrame, top: int = 5) -> DataFrame:
    """The stores with the most revenue in every city; ties share a rank."""
    totals = totals_per_id(facts, ["store_id"], {"total_revenue": money_sum(AMOUNT)}).join(stores, "store_id")
    named = merge_spellings(totals, ["city", "store_name"], {"total_revenue": F.sum("total_revenue")})
    return _ranked_in_city(money(named, "total_revenue"), top).orderBy(
        "city", "revenue_rank", "store_name"
    )


def _ranked_in_city(totals: DataFrame, top: int) -> DataFrame:
    # The rank limit is applied by each task before the shuffle too (WindowGroupLimit).
    best = W.partitionBy(text_key("city")).orderBy(F.desc("total_revenue"))
    return totals.withColumn("revenue_rank", F.rank().over(best)).filter(F.col("revenue_rank") <= top)


def store_revenue_share(facts: DataFrame, stores: DataFrame) -> DataFrame:
    totals = revenue_per_store(facts, stores)
    everything = totals.agg(total_of_sums("total_revenue").alias("everything")).scalar()
    return totals.withColumn(
        "revenue_percentage", percent_of(F.col("total_revenue"), everything)
    ).orderBy(F.desc("total_revenue"), "store_name")


def top_revenue_days(facts: DataFrame, top: int = 10) -> DataFrame:
    days = facts.groupBy(F.to_date("transaction_date").alias("report_date")).agg(
        money_sum(AMOUNT).alias("daily_revenue")
    )
    return days.orderBy(F.desc("daily_revenue"), "report_date").limit(top)


# -- cashiers ------------------------------------------------------------------------------------


def best_cashiers(facts: DataFrame) -> DataFrame:
    totals = total_by_text(
        facts, ["cashier_id"], {"TotalItems": F.sum("items_count"), "TotalSales": money_sum(AMOUNT)}
    )
    return money(totals, "TotalSales").orderBy(F.desc("TotalSales"), "cashier_id")


def cashier_rank(facts: DataFrame) -> DataFrame:
    totals = total_by_text(
        facts,
        ["cashier_id"],
        {"transactions_count": F.count("*"), "total_revenue": money_sum(AMOUNT)},
    )
    ranked = rank_descending(money(totals, "total_revenue"), "total_revenue", "sales_rank")
    return ranked.select(
        "cashier_id",
        "transactions_count",
        "total_revenue",
        average_ticket(F.col("total_revenue"), F.col("transactions_count")).alias("avg_ticket_value"),
        "sales_rank",
    ).orderBy("sales_rank", "cashier_id")


# -- payment methods -----------------------------------------------------------------------------


def payment_revenue(facts: DataFrame, payment_methods: DataFrame) -> DataFrame:
    totals = by_dimension(
        facts,
        payment_methods,
        "payment_id",
        "payment_method",
        {"transaction_count": F.count("*"), "total_revenue": money_sum(AMOUNT)},
    )
    return money(totals, "total_revenue").orderBy(F.desc("total_revenue"), "payment_method")


def payment_discounts(facts: DataFrame, payment_methods: DataFrame) -> DataFrame:
    totals = by_dimension(
        facts,
        payment_methods,
        "payment_id",
        "payment_method",
        {
            "transaction_count": F.count("*"),
            "total_revenue": money_sum(AMOUNT),
            "discounted_transactions": count_when(discounted()),
            "full_price_transactions": count_when(full_price()),
        },
    )
    return money(totals, "total_revenue").orderBy(F.desc("total_revenue"), "payment_method")


def payment_by_store(
    facts: DataFrame, stores: DataFrame, payment_methods: DataFrame
) -> DataFrame:
    measures = {"total_transactions": F.count("transaction_id"), "total_sales_amount": money_sum(AMOUNT)}
    totals = (
        totals_per_id(facts, ["store_id", "payment_id"], measures)
        .join(stores.select("store_id", "store_name"), "store_id")
        .join(payment_methods, "payment_id")
    )
    named = merge_spellings(totals, ["store_name", "payment_method"], {n: F.sum(n) for n in measures})
    return money(named, "total_sales_amount").orderBy(
        "store_name", F.desc("total_transactions"), "payment_method"
    )


# -- loyalty -------------------------------------------------------------------------------------


def loyalty_overview(facts: DataFrame) -> DataFrame:
    points = "loyalty_points_earned"
    return facts.agg(
        F.sum(points).alias("total_loyalty_points"),
        # An average of whole numbers is a whole number here: the fraction is cut off.
        F.call_function("div", F.sum(points), F.count(points)).alias("avg_points_per_transaction"),
    )
