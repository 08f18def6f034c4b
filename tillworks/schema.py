"""Declared schemas of every table. Nothing is inferred."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MONEY_SUM = T.DecimalType(38, 2)
MONEY_RATIO = T.DecimalType(38, 6)

RAW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("cashier_id", T.StringType()),
        T.StructField("items_count", T.IntegerType()),
        T.StructField("total_amount_ngn", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("discount_applied", T.StringType()),
        T.StructField("loyalty_points_earned", T.IntegerType()),
        T.StructField("receipt_number", T.StringType()),
    ]
)

STORES = T.StructType(
    [
        T.StructField("store_id", T.IntegerType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("city", T.StringType()),
    ]
)

PAYMENT_METHODS = T.StructType(
    [
        T.StructField("payment_id", T.IntegerType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("cashier_id", T.StringType()),
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("items_count", T.IntegerType()),
        T.StructField("total_amount_ngn", MONEY),
        T.StructField("payment_id", T.IntegerType()),
        T.StructField("discount_applied", T.StringType()),
        T.StructField("loyalty_points_earned", T.IntegerType()),
        T.StructField("receipt_number", T.StringType()),
    ]
)

DAILY_SUMMARY = T.StructType(
    [
        T.StructField("summary_id", T.IntegerType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_revenue", MONEY_SUM),
        T.StructField("transactions_with_discount", T.LongType()),
        T.StructField("transactions_without_discount", T.LongType()),
        T.StructField("total_loyalty_points", T.LongType()),
        T.StructField("top_city", T.StringType()),
        T.StructField("top_store", T.StringType()),
    ]
)

ERROR_LOG = T.StructType(
    [
        T.StructField("error_id", T.IntegerType()),
        T.StructField("error_time", T.TimestampNTZType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("error_number", T.IntegerType()),
        T.StructField("error_severity", T.IntegerType()),
        T.StructField("error_state", T.IntegerType()),
        T.StructField("error_line", T.IntegerType()),
        T.StructField("procedure_name", T.StringType()),
    ]
)

ETL_AUDIT = T.StructType(
    [
        T.StructField("audit_id", T.IntegerType()),
        T.StructField("run_time", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

# One row per version: which run directories hold the dimensions, and which manifest the facts.
PUBLISHED = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("stores_run", T.IntegerType()),
        T.StructField("payment_methods_run", T.IntegerType()),
        T.StructField("daily_summary_run", T.IntegerType()),
        T.StructField("manifest", T.StringType()),
    ]
)

# One row per run and month of a version's facts, and of the ids that its runs replace.
MANIFEST = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("sales_month", T.StringType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("dead", T.LongType()),
        T.StructField("first_date", T.TimestampNTZType()),
        T.StructField("last_date", T.TimestampNTZType()),
    ]
)

# Widths of the source's text columns. A longer value is a load error.
TEXT_WIDTHS = {
    "transaction_id": 100,
    "store_name": 100,
    "city": 100,
    "cashier_id": 50,
    "payment_method": 100,
    "discount_applied": 100,
    "receipt_number": 100,
}

RAW_COLUMNS = RAW.fieldNames()
TRANSACTION_COLUMNS = TRANSACTIONS.fieldNames()
