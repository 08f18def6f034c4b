"""The tables the registered queries read, built once per session and input folder.

The raw rows are staged and run through the daily job into a warehouse under the shared folder,
as they would be in production; the reports then read those files. Nothing is held in the driver.
Each table is built when the first query reads it, so a query waits for no table that it has no use for.
"""

import hashlib
import threading
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.operators.dedup import dedup_transactions
from tillworks.operators.merge import upsert_payment_methods, upsert_stores
from tillworks.plans.etl import RunResult, compact, run_etl
from tillworks.plans.initial_load import (
    payment_methods_initial,
    stores_initial,
    transactions_initial,
)
from tillworks.plans.summary import load_daily_summary
from tillworks.schema import RAW_COLUMNS
from tillworks.session import shared_dir
from tillworks.sources.deliveries import deliveries
from tillworks.sources.warehouse import State, Warehouse
from tillworks.streaming.new_files import merge_new_files, rejects, replay

# Orders before this day are the first batch of the merge queries. All later orders and all
# re-deliveries are the second, so the two together are the whole table.
SECOND_BATCH_FROM = "1998-01-01 00:00:00"

# The tills of one payment method each write a number with its unit, which no column can hold.
PIECES_METHOD, CURRENCY_METHOD = "1-URGENT", "5-LOW"


@dataclass
class Mart:
    spark: SparkSession
    folder: str

    @cached_property
    def _first_run(self) -> tuple[Warehouse, RunResult]:
        warehouse = Warehouse(self.spark, f"{self.folder}/warehouse", recreate=True)
        return warehouse, run_etl(warehouse, self.raw)

    @property
    def warehouse(self) -> Warehouse:
        """All raw rows through the daily job."""
        with _building:
            return self._first_run[0]

    @property
    def result(self) -> RunResult:
        with _building:
            return self._first_run[1]

    @cached_property
    def _delivered(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/staging")

    @cached_property
    def raw(self) -> DataFrame:
        return self._delivered.select(*RAW_COLUMNS)

    @cached_property
    def stores(self) -> DataFrame:
        return self.warehouse.stores()

    @cached_property
    def payment_methods(self) -> DataFrame:
        return self.warehouse.payment_methods()

    @cached_property
    def facts(self) -> DataFrame:
        return self.warehouse.transactions()

    def _saved(self, name: str, table: DataFrame) -> DataFrame:
        """Write a table once and read it back, so that the planner knows its true size."""
        path = f"{self.folder}/{name}"
        table.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    @cached_property
    def batches(self) -> tuple[DataFrame, DataFrame]:
        first = F.coalesce(
            (F.col("redelivery") == 0)
            & (F.col("transaction_date") < F.lit(SECOND_BATCH_FROM).cast("timestamp_ntz")),
            F.lit(False),
        )
        rows = self._delivered
        return rows.filter(first).select(*RAW_COLUMNS), rows.filter(~first).select(*RAW_COLUMNS)

    @cached_property
    def initial_dimensions(self) -> tuple[DataFrame, DataFrame]:
        return (
            self._saved("initial_stores", stores_initial(self.raw)),
            self._saved("initial_payment_methods", payment_methods_initial(self.raw)),
        )

    @cached_property
    def first_load(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Stores, payment methods and transactions after an initial load of the first batch."""
        first, _ = self.batches
        stores = self._saved("first_stores", stores_initial(first))
        methods = self._saved("first_payment_methods", payment_methods_initial(first))
        loaded = transactions_initial(dedup_transactions(first), stores, methods)
        return stores, methods, self._saved("first_transactions", loaded)

    def two_runs(self, step: str) -> tuple[Warehouse, State]:
        """A warehouse that the daily job fills from the two batches, the second one twice, and its state after a step.

        The summary table is refreshed after each of the first two runs, and all months are compacted at
        the end: the steps are "merged", "summarized", "repeated" and "compacted". They are taken once a session, in
        this order and as far as a query asks, so none waits for steps after its own.
        """
        with _building:
            warehouse, states, steps = self._two_runs
            try:
                while step not in states:
                    states.update([next(steps)])
            except BaseException:
                del self._two_runs  # the next call starts anew
                raise
            return warehouse, states[step]

    @cached_property
    def _two_runs(self) -> tuple[Warehouse, dict[str, State], Iterator[tuple[str, State]]]:
        warehouse = Warehouse(self.spark, f"{self.folder}/two_runs", recreate=True)
        return warehouse, {}, self._steps(warehouse)

    def _steps(self, warehouse: Warehouse) -> Iterator[tuple[str, State]]:
        first, second = (self._saved(f"batch{i}", b) for i, b in enumerate(self.batches, 1))
        run_etl(warehouse, first)
        load_daily_summary(warehouse)
        result = run_etl(warehouse, second)
        yield "merged", warehouse.state()
        load_daily_summary(warehouse, set(result.months))
        yield "summarized", warehouse.state()
        run_etl(warehouse, second)
        yield "repeated", warehouse.state()
        compact(warehouse, set(warehouse.state().month_runs))
        yield "compacted", warehouse.state()

    @cached_property
    def replayed(self) -> tuple[DataFrame, Warehouse]:
        """All raw rows through a landing folder, some with faults: what was rejected, and the warehouse
        after the rejected lines were repaired and replayed, twice over."""
        method, items, amount = F.col("payment_method"), F.col("items_count"), F.col("total_amount_ngn")
        faulty = {
            "transaction_date": F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss"),
            "items_count": F.when(method == PIECES_METHOD, F.concat(items.cast("string"), F.lit(" pcs"))).otherwise(items.cast("string")),
            "total_amount_ngn": F.when(method == CURRENCY_METHOD, F.concat(F.lit("NGN "), amount.cast("string"))).otherwise(amount.cast("string")),
        }
        landing = f"{self.folder}/landing"
        self.raw.withColumns(faulty).write.mode("overwrite").csv(
            landing, header=True, escape='"', encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
        warehouse = Warehouse(self.spark, f"{self.folder}/replayed", recreate=True)
        merge_new_files(self.spark, warehouse, landing)
        found = self._saved("rejected_lines", rejects(self.spark, warehouse))
        repaired = found.select("reject_id", F.regexp_replace("line", " pcs|NGN ", "").alias("line"))
        for _ in range(2):
            replay(self.spark, warehouse, repaired)
        return found, warehouse

    @cached_property
    def merged_dimensions(self) -> tuple[DataFrame, DataFrame]:
        """The dimensions once the second batch is merged into the first load."""
        stores, methods, _ = self.first_load
        _, second = self.batches
        return (
            self._saved("merged_stores", upsert_stores(stores, second)),
            self._saved("merged_payment_methods", upsert_payment_methods(methods, second)),
        )


_marts: dict[tuple[str, str], Mart] = {}
_building = threading.Lock()


def stage_mart(spark: SparkSession, sf_dir: str, folder: str) -> Mart:
    """The raw rows staged; all else is built from them when it is read."""
    deliveries(spark, sf_dir).write.mode("overwrite").parquet(f"{folder}/staging")
    return Mart(spark, folder)


def build_mart(spark: SparkSession, sf_dir: str, folder: str) -> Mart:
    """The raw rows staged and run through the daily job."""
    built = stage_mart(spark, sf_dir, folder)
    assert built.result.run
    return built


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of this input folder, staged at the first call in the session."""
    application = spark.sparkContext.applicationId
    with _building:
        if (application, sf_dir) not in _marts:
            name = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
            folder = f"{shared_dir(spark)}/tillworks/{application}/{name}"
            _marts[application, sf_dir] = stage_mart(spark, sf_dir, folder)
        return _marts[application, sf_dir]
