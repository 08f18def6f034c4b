"""The first load: dimensions from the complete rows, facts by inner join."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import text_key
from tillworks.operators.merge import payment_keys, store_keys
from tillworks.operators.ordering import number_rows
from tillworks.schema import TRANSACTION_COLUMNS


def stores_initial(raw: DataFrame) -> DataFrame:
    keys = store_keys(raw.filter(F.col("city").isNotNull())).filter(F.col("city").isNotNull())
    return number_rows(keys, [F.asc("store_name"), F.asc("city")], "store_id").select(
        "store_id", "store_name", "city"
    )


def payment_methods_initial(raw: DataFrame) -> DataFrame:
    return number_rows(payment_keys(raw), [F.asc("payment_method")], "payment_id").select(
        "payment_id", "payment_method"
    )


def transactions_initial(
    raw: DataFrame, stores: DataFrame, payment_methods: DataFrame
) -> DataFrame:
    """Every raw row with a known store, city and method; repeated ids are not removed here."""
    s = stores.select("store_id", text_key("store_name").alias("_name"), text_key("city").alias("_city"))
    p = payment_methods.select("payment_id", text_key("payment_method").alias("_method"))
    return (
        raw.join(s, (text_key(raw["store_name"]) == s["_name"]) & (text_key(raw["city"]) == s["_city"]))
        .join(p, text_key(raw["payment_method"]) == p["_method"])
        .select(*TRANSACTION_COLUMNS)
    )
