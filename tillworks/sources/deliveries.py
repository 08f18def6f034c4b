"""Raw point-of-sale rows derived from the order tables, with the irregularities of real feeds."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.schema import MONEY


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, and a second one an hour later for every re-delivered order.

    The 11 raw columns plus `redelivery` (0 or 1). The second copy is an explode of the first, so
    the joins run once.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    quantities = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    base = (
        orders.join(quantities, orders["o_orderkey"] == quantities["l_orderkey"], "left")
        .join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    )

    k = F.col("o_orderkey")
    copies = F.when(k % 50 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    hours = ((k * 7) % 24 + F.col("redelivery")).cast("int")
    cashier = F.concat(F.lit("CASH"), (F.col("o_custkey") % 90).cast("string"))
    flag = k % 6

    return base.withColumn("redelivery", F.explode(copies)).select(
        F.when(k % 997 != 0, F.concat(F.lit("TXN"), k.cast("string"))).alias("transaction_id"),
        F.when(k % 89 != 0, F.col("c_mktsegment")).alias("store_name"),
        F.when(k % 83 != 0, F.col("n_name")).alias("city"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)).alias("transaction_date"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.lower(cashier), F.lit(" ")))
        .otherwise(cashier)
        .alias("cashier_id"),
        F.col("quantity").cast("int").alias("items_count"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount_ngn"),
        F.when(k % 101 != 0, F.col("o_orderpriority")).alias("payment_method"),
        F.when(flag == 0, "TRUE")
        .when(flag == 1, "True")
        .when(flag == 2, "1")
        .when(flag == 3, "FALSE")
        .when(flag == 4, "0")
        .otherwise("true")
        .alias("discount_applied"),
        ((k * 37) % 1000).cast("int").alias("loyalty_points_earned"),
        F.concat(F.lit("RCP"), (k % 14000).cast("string")).alias("receipt_number"),
        "redelivery",
    )
