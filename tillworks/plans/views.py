"""Names under which a session's SQL finds the published tables and the two saved views."""

from pyspark.sql import SparkSession

from tillworks.plans.kpi import revenue_per_store
from tillworks.plans.trends import daily_revenue
from tillworks.sources.warehouse import Warehouse


def register_views(spark: SparkSession, warehouse: Warehouse) -> None:
    state = warehouse.state()
    facts, stores = warehouse.transactions(state), warehouse.stores(state)
    facts.createOrReplaceTempView("transactions")
    stores.createOrReplaceTempView("stores")
    warehouse.payment_methods(state).createOrReplaceTempView("payment_methods")
    warehouse.daily_summary(state).createOrReplaceTempView("daily_summary")
    warehouse.table("error_log").createOrReplaceTempView("error_log")
    warehouse.table("etl_audit").createOrReplaceTempView("etl_audit")
    revenue_per_store(facts, stores).createOrReplaceTempView("vw_revenue_per_store")
    daily_revenue(facts).createOrReplaceTempView("vw_daily_revenue")
