"""The daily summary: as a query, and as a table refreshed for the days a run touched."""

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import count_when, discounted, full_price, money_sum, month_of, text_key
from tillworks.operators.ordering import number_rows
from tillworks.plans.kpi import AMOUNT, money
from tillworks.schema import DAILY_SUMMARY
from tillworks.session import ensure_checkpoint_dir
from tillworks.sources.warehouse import NO_MONTH, Warehouse

def daily_summary_basic(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.to_date("transaction_date").alias("report_date")).agg(
        F.count("*").alias("total_transactions"), money_sum(AMOUNT).alias("total_revenue")
    )


def daily_summary(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Totals of every day with the city and the store that had the most transactions.

    The facts are scanned and shuffled once, as sums per day and store. Those sums are joined with
    the stores and summed again at three levels - the day, the day's cities, the day's store names -
    in one grouping-sets pass, from which each day picks its totals and its two leaders.
    """
    measures = {
        "total_transactions": F.count("*"),
        "total_revenue": money_sum(AMOUNT),
        "transactions_with_discount": count_when(discounted()),
        "transactions_without_discount": count_when(full_price()),
        "total_loyalty_points": F.sum("loyalty_points_earned"),
    }
    per_store = facts.groupBy(F.to_date("transaction_date").alias("report_date"), "store_id").agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    labelled = _one_spelling(_one_spelling(stores, "city"), "store_name").withColumn("_known", F.lit(True))
    located = per_store.join(labelled, "store_id", "left").select(
        "report_date",
        "city",
        "store_name",
        # Only transactions of a known store count towards the leaders.
        F.when(F.col("_known"), F.col("total_transactions")).alias("_located"),
        *measures,
    )
    day, city, store = F.col("report_date"), F.col("city"), F.col("store_name")
    levels = located.groupingSets([[day], [day, city], [day, store]], day, city, store).agg(
        F.grouping_id(day, city, store).alias("_level"),
        F.sum("_located").alias("_located"),
        *[F.sum(n).alias(n) for n in measures],
    )
    # grouping_id sets one bit per column left out: city and store, store only, city only.
    whole_day, by_city, by_store = 0b011, 0b001, 0b010

    def leader(name: str, level: int) -> Column:
        """Most transactions first, then the smallest name."""
        at_level = (F.col("_level") == level) & F.col("_located").isNotNull()
        return F.min_by(name, F.when(at_level, F.struct(-F.col("_located"), F.col(name))))

    days = levels.groupBy("report_date").agg(
        *[F.sum(F.when(F.col("_level") == whole_day, F.col(n))).alias(n) for n in measures],
        leader("city", by_city).alias("top_city"),
        leader("store_name", by_store).alias("top_store"),
    )
    return money(days, "total_revenue")


def _one_spelling(dimension: DataFrame, column: str) -> DataFrame:
    """Replace each spelling of a dimension's text by the smallest one with the same text_key.

    Done on the dimension, so that the facts can be grouped by hash on the text as it is.
    """
    smallest = dimension.groupBy(text_key(column).alias("_key")).agg(F.min(column).alias("_smallest"))
    return (
        dimension.join(smallest, text_key(dimension[column]) == smallest["_key"], "left")
        .withColumn(column, F.col("_smallest"))
        .drop("_key", "_smallest")
    )


def load_daily_summary(
    warehouse: Warehouse, months: set[str] | None = None, basic: bool = False
) -> None:
    """Refresh the summary table for the given months, or for all, and publish it.

    A day is replaced, not appended again, and keeps its summary_id. Pass the months of a
    RunResult so that only the facts they cover are read. `basic` fills only the date, the count
    and the revenue.
    """
    state, run = warehouse.state(), warehouse.new_run()
    facts = warehouse.transactions(state, months)
    if basic:
        fresh = daily_summary_basic(facts)
    else:
        fresh = daily_summary(facts, warehouse.stores(state))
    old = warehouse.daily_summary(state)
    if months is None:
        kept = old.limit(0)
    else:
        kept = old.filter(~F.coalesce(month_of("report_date"), F.lit(NO_MONTH)).isin(sorted(months)))

    ids = old.select("summary_id", F.col("report_date").alias("_date"))
    # One row per day, read by both branches below: checkpointed so the facts are scanned once.
    ensure_checkpoint_dir(warehouse.spark)
    known = (
        fresh.join(ids, fresh["report_date"].eqNullSafe(ids["_date"]), "left").drop("_date").checkpoint()
    )
    next_id = old.agg(F.coalesce(F.max("summary_id"), F.lit(0))).first()[0]
    added = number_rows(
        known.filter(F.col("summary_id").isNull()).drop("summary_id"),
        [F.asc_nulls_first("report_date")],
        "summary_id",
        start=next_id,
    )
    table = kept
    for part in (known.filter(F.col("summary_id").isNotNull()), added):
        table = table.unionByName(part, allowMissingColumns=True)
    warehouse.write_dimension("daily_summary", table.select(*DAILY_SUMMARY.fieldNames()), run)
    warehouse.publish(replace(state, run=run, daily_summary_run=run))
