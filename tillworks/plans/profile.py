"""Profiling of the raw rows: repeats, NULLs, outliers and implausible times."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import as_of_time, count_if_null
from tillworks.operators.grouping import merge_spellings, total_by_text
from tillworks.schema import RAW_COLUMNS

# What counts as unusual unless the caller says otherwise.
MAX_AMOUNT = 200000
MAX_ITEMS = 200
OPENING_HOUR = 8
CLOSING_HOUR = 22


def raw_scan(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_COLUMNS)


def dup_receipts(raw: DataFrame) -> DataFrame:
    # Receipts are nearly unique: grouping the spellings first would shuffle them twice.
    counts = merge_spellings(raw, ["receipt_number"], {"duplicate_count": F.count("*")})
    return counts.filter(F.col("duplicate_count") > 1)


def dup_stores(raw: DataFrame) -> DataFrame:
    counts = total_by_text(raw, ["store_name"], {"duplicate_stores": F.count("*")})
    return counts.filter(F.col("duplicate_stores") > 1)


def dup_cities(raw: DataFrame) -> DataFrame:
    counts = total_by_text(raw, ["city"], {"duplicate_city": F.count("*")})
    return counts.filter(F.col("duplicate_city") > 1)


def dup_timestamps(raw: DataFrame) -> DataFrame:
    counts = raw.groupBy("transaction_date").agg(F.count("*").alias("duplicate_count"))
    return counts.filter(F.col("duplicate_count") > 1)


def null_profile(raw: DataFrame) -> DataFrame:
    return raw.agg(
        count_if_null("transaction_id").alias("null_transaction_id"),
        count_if_null("store_name").alias("null_store_name"),
        count_if_null("city").alias("null_city"),
        count_if_null("transaction_date").alias("null_txn_date"),
        count_if_null("cashier_id").alias("null_cashier"),
        count_if_null("items_count").alias("null_items"),
        count_if_null("total_amount_ngn").alias("null_amount"),
    )


def outliers(raw: DataFrame, max_amount: int = MAX_AMOUNT, max_items: int = MAX_ITEMS) -> DataFrame:
    return raw.select(*RAW_COLUMNS).filter(
        (F.col("total_amount_ngn") > max_amount) | (F.col("items_count") > max_items)
    )


def future_dates(raw: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    return raw.select(*RAW_COLUMNS).filter(F.col("transaction_date") > as_of_time(as_of))


def off_hours(raw: DataFrame, opening: int = OPENING_HOUR, closing: int = CLOSING_HOUR) -> DataFrame:
    hour = F.hour("transaction_date")
    return raw.filter(~hour.between(opening, closing)).select(
        "transaction_id", "store_name", "cashier_id", "transaction_date", hour.alias("transaction_hour")
    )
