"""Every registered query by name, as a function of (session, input folder)."""

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tillworks.operators import checks, merge
from tillworks.operators.dedup import dedup_transactions
from tillworks.plans import initial_load, kpi, profile, summary, targets, trends
from tillworks.plans.mart import Mart, mart
from tillworks.plans.views import register_views
from tillworks.schema import RAW_COLUMNS
from tillworks.sources.csv_load import read_csv

# Parameters under which every branch of a report has rows on the test tables.
AS_OF = "2001-06-01 00:00:00"
MONTH = "1998-03"
YEAR = 1998
CASHIER_TARGET = Decimal("500000")
STORE_TARGET = Decimal("9000000")
STORE = "AUTOMOBILE"
SAMPLES = 5


def _transactions_initial(m: Mart) -> DataFrame:
    return initial_load.transactions_initial(m.raw, *m.initial_dimensions)


def _upsert_stores(m: Mart) -> DataFrame:
    stores, _, _ = m.first_load
    return merge.upsert_stores(stores, m.batches[1])


def _upsert_payment_methods(m: Mart) -> DataFrame:
    _, methods, _ = m.first_load
    return merge.upsert_payment_methods(methods, m.batches[1])


def _upsert_transactions(m: Mart) -> DataFrame:
    _, _, target = m.first_load
    return merge.upsert_transactions(target, m.batches[1], *m.merged_dimensions)


def _run_metrics(m: Mart) -> DataFrame:
    _, _, target = m.first_load
    return checks.run_metrics(m.batches[1], target)


def _after_two_runs(table: str, after: str = "merged") -> Callable[[Mart], DataFrame]:
    def read(m: Mart) -> DataFrame:
        warehouse, state = m.two_runs(after)
        return getattr(warehouse, table)(state).drop("sales_month")

    return read


def _audit_counts(m: Mart) -> DataFrame:
    warehouse, _ = m.two_runs("repeated")
    return warehouse.table("etl_audit").select("audit_id", "status", "rows_processed")


def _through_view(view: str) -> Callable[[Mart], DataFrame]:
    def read(m: Mart) -> DataFrame:
        register_views(m.spark, m.warehouse)
        return m.spark.sql(f"SELECT * FROM {view}")

    return read


def _csv_load(m: Mart) -> DataFrame:
    path = f"{m.folder}/csv"
    m.raw.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    rows = read_csv(m.spark, path)
    return rows.filter(rows["reject_reason"].isNull()).select(*RAW_COLUMNS)


_QUERIES: dict[str, Callable[[Mart], DataFrame]] = {
    # loading and profiling of the raw rows
    "csv_load": _csv_load,
    "csv_rejects": lambda m: m.replayed[0],
    "csv_replayed": lambda m: m.replayed[1].transactions().drop("sales_month"),
    "raw_scan": lambda m: profile.raw_scan(m.raw),
    "dup_receipts": lambda m: profile.dup_receipts(m.raw),
    "dup_stores": lambda m: profile.dup_stores(m.raw),
    "dup_cities": lambda m: profile.dup_cities(m.raw),
    "null_profile": lambda m: profile.null_profile(m.raw),
    "outliers": lambda m: profile.outliers(m.raw),
    "future_dates": lambda m: profile.future_dates(m.raw, AS_OF),
    "dup_timestamps": lambda m: profile.dup_timestamps(m.raw),
    "off_hours": lambda m: profile.off_hours(m.raw),
    # initial load and merge
    "stores_initial": lambda m: initial_load.stores_initial(m.raw),
    "payment_methods_initial": lambda m: initial_load.payment_methods_initial(m.raw),
    "transactions_initial": _transactions_initial,
    "dedup_transactions": lambda m: dedup_transactions(m.raw),
    "upsert_stores": _upsert_stores,
    "upsert_payment_methods": _upsert_payment_methods,
    "upsert_transactions": _upsert_transactions,
    "run_etl": lambda m: m.facts.drop("sales_month"),
    "run_etl_two_batches": _after_two_runs("transactions"),
    "run_etl_repeated": _after_two_runs("transactions", "repeated"),
    "run_etl_compacted": _after_two_runs("transactions", "compacted"),
    "run_etl_stores": _after_two_runs("stores"),
    "run_etl_payment_methods": _after_two_runs("payment_methods"),
    "daily_summary_table": _after_two_runs("daily_summary", "summarized"),
    "etl_audit_counts": _audit_counts,
    # key figures
    "store_count": lambda m: kpi.store_count(m.stores),
    "city_count": lambda m: kpi.city_count(m.stores),
    "cashier_count": lambda m: kpi.cashier_count(m.facts),
    "receipt_count": lambda m: kpi.receipt_count(m.facts),
    "total_items": lambda m: kpi.total_items(m.facts),
    "best_cashiers": lambda m: kpi.best_cashiers(m.facts),
    "revenue_overview": lambda m: kpi.revenue_overview(m.facts),
    "revenue_by_city": lambda m: kpi.revenue_by_city(m.facts, m.stores),
    "city_revenue_rank": lambda m: kpi.city_revenue_rank(m.facts, m.stores),
    "top_stores_per_city": lambda m: kpi.top_stores_per_city(m.facts, m.stores),
    "store_revenue_share": lambda m: kpi.store_revenue_share(m.facts, m.stores),
    "cashier_rank": lambda m: kpi.cashier_rank(m.facts),
    "top_revenue_days": lambda m: kpi.top_revenue_days(m.facts),
    "payment_revenue": lambda m: kpi.payment_revenue(m.facts, m.payment_methods),
    "payment_discounts": lambda m: kpi.payment_discounts(m.facts, m.payment_methods),
    "payment_by_store": lambda m: kpi.payment_by_store(m.facts, m.stores, m.payment_methods),
    "loyalty_overview": lambda m: kpi.loyalty_overview(m.facts),
    "revenue_per_store": lambda m: kpi.revenue_per_store(m.facts, m.stores),
    # targets
    "cashiers_below_target": lambda m: targets.cashiers_below_target(m.facts, MONTH, CASHIER_TARGET),
    "cashiers_above_target": lambda m: targets.cashiers_above_target(m.facts, MONTH, CASHIER_TARGET),
    "store_target_one": lambda m: targets.store_target_one(m.facts, m.stores, STORE, MONTH, STORE_TARGET),
    "store_target_all": lambda m: targets.store_target_all(m.facts, m.stores, MONTH, STORE_TARGET),
    # trends and summaries
    "revenue_by_timestamp": lambda m: trends.revenue_by_timestamp(m.facts),
    "revenue_daily": lambda m: trends.revenue_daily(m.facts),
    "revenue_weekly": lambda m: trends.revenue_weekly(m.facts),
    "revenue_monthly": lambda m: trends.revenue_monthly(m.facts),
    "revenue_quarterly": lambda m: trends.revenue_quarterly(m.facts),
    "revenue_yearly": lambda m: trends.revenue_yearly(m.facts),
    "monthly_revenue_for_year": lambda m: trends.monthly_revenue(m.facts, YEAR),
    "daily_revenue": lambda m: trends.daily_revenue(m.facts),
    "daily_summary": lambda m: summary.daily_summary(m.facts, m.stores),
    "daily_summary_basic": lambda m: summary.daily_summary_basic(m.facts),
    # the saved views, as a session's SQL reads them
    "view_revenue_per_store": _through_view("vw_revenue_per_store"),
    "view_daily_revenue": _through_view("vw_daily_revenue"),
    # rows that break a rule
    "quarantine": lambda m: checks.quarantine(m.raw, AS_OF),
    "error_samples": lambda m: checks.error_samples(m.raw, AS_OF, SAMPLES),
    "run_metrics": _run_metrics,
    "pk_violations": lambda m: checks.pk_violations(_transactions_initial(m)),
    "fk_orphans": lambda m: checks.fk_orphans(m.facts, *m.initial_dimensions),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Callable[[Mart], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(mart(spark, sf_dir))

    return {name: bound(query) for name, query in _QUERIES.items()}
