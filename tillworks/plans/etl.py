"""The daily job: three upserts that become visible together or not at all."""

import datetime as dt
import traceback
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import text_key
from tillworks.functions.calendar import MONTH_COLUMN
from tillworks.operators.bloom import bloom_of, maybe_in
from tillworks.operators.checks import error_samples, fk_orphans, pk_violations, quarantine
from tillworks.operators.merge import merge_source, upsert_payment_methods, upsert_stores
from tillworks.schema import TRANSACTION_COLUMNS
from tillworks.sources.warehouse import Warehouse

JOB = "run_etl"


@dataclass(frozen=True)
class RunResult:
    run: int
    rows_processed: int
    months: frozenset[str]


class CheckFailed(RuntimeError):
    """A key check found rows that must not be published."""


def run_etl(warehouse: Warehouse, raw: DataFrame) -> RunResult:
    """Merge a staged batch into stores, payment methods and transactions.

    `raw` is read five times, three of them with only a few columns, so pass a table on files rather
    than a long plan. Running the same batch again changes nothing.
    """
    try:
        result = _merge(warehouse, raw)
    except Exception as failure:
        log_error(warehouse, failure, JOB)
        log_run(warehouse, "FAILED", None, str(failure))
        raise
    log_run(warehouse, "SUCCESS", result.rows_processed, f"run {result.run}")
    return result


def _merge(warehouse: Warehouse, raw: DataFrame) -> RunResult:
    state, run = warehouse.state(), warehouse.new_run()

    # The facts look up ids created here, so the dimensions are written first. Reading them back
    # also gives the planner their true size.
    warehouse.write_dimension("stores", upsert_stores(warehouse.stores(state), raw), run)
    warehouse.write_dimension(
        "payment_methods", upsert_payment_methods(warehouse.payment_methods(state), raw), run
    )
    new_state = replace(state, run=run, stores_run=run, payment_methods_run=run)
    stores, payment_methods = warehouse.stores(new_state), warehouse.payment_methods(new_state)

    warehouse.write_months(merge_source(raw, stores, payment_methods), run)
    source = warehouse.written(run)
    check_keys(source, stores, payment_methods)
    written = warehouse.parts_written(run)
    rows, months = sum(p.rows for p in written), {p.sales_month for p in written}

    if state.parts and rows:
        new_state = warehouse.replace_rows(new_state, replaced(warehouse.located(state), source, rows), run)
        months |= {p.sales_month for p in state.parts} - {p.sales_month for p in new_state.parts}
        months |= {p.sales_month for p in new_state.parts if p.kind == "replaced" and p.run == run}
    warehouse.publish(replace(new_state, parts=(*new_state.parts, *written)))
    return RunResult(run, rows, frozenset(months))


def replaced(stored: DataFrame, source: DataFrame, count: int) -> DataFrame:
    """Which stored rows the `count` rows of a batch replace: id (as text_key), of_run and sales_month.

    A known transaction may have moved to another month, so ids are looked up in all months. The
    stored ids are only read: those that the Bloom filter of the batch's ids rules out, nearly all of them,
    are dropped where they lie. The rest are joined to the batch by the ids themselves.
    """
    new = source.select(text_key("transaction_id").alias("id"))
    known = stored.select(text_key("transaction_id").alias("id"), F.col("run").alias("of_run"), MONTH_COLUMN)
    return maybe_in(known, F.col("id"), bloom_of(new, F.col("id"), count)).join(new, "id", "left_semi")


def compact(warehouse: Warehouse, months: set[str]) -> int | None:
    """Write the given months anew, each into one run's directory, and publish; rows stay the same.

    Rows that were replaced are left behind. The daily job never does this by itself: a month that is
    added to gains a directory a run, and when to pay for joining them is the caller's choice. Months that
    hold no rows are left out; None if nothing is left.
    """
    state = warehouse.state()
    months = months & set(state.month_runs)
    if not months:
        return None
    run = warehouse.new_run()
    warehouse.write_months(warehouse.transactions(state, months).select(*TRANSACTION_COLUMNS), run)
    others = [p for p in state.parts if p.sales_month not in months]
    warehouse.publish(replace(state, run=run, parts=(*others, *warehouse.parts_written(run))))
    return run


def check_keys(transactions: DataFrame, stores: DataFrame, payment_methods: DataFrame) -> None:
    """Stop the run when a primary or foreign key of the batch does not hold."""
    broken = pk_violations(transactions).limit(1).collect() + fk_orphans(
        transactions, stores, payment_methods
    ).limit(1).collect()
    if broken:
        raise CheckFailed(f"key check failed: {broken[0].asDict()}")


def save_suspects(
    warehouse: Warehouse, raw: DataFrame, run: int, as_of: dt.datetime | str | None = None
) -> None:
    """Keep a run's quarantined rows, by reason, and a few samples of each reason."""
    warehouse.write_suspects("quarantine", quarantine(raw, as_of), run)
    warehouse.write_suspects("error_samples", error_samples(raw, as_of), run)


def log_error(warehouse: Warehouse, failure: BaseException, step: str) -> None:
    """One error_log row for one failure; the table keeps the first 4000 characters of its message."""
    frames = traceback.extract_tb(failure.__traceback__)
    warehouse.append_log(
        "error_log",
        "error_id",
        "error_time",
        {
            "error_message": (str(failure) or "NULL")[:4000],
            "error_line": frames[-1].lineno if frames else None,
            "procedure_name": step,
        },
    )


def log_run(warehouse: Warehouse, status: str, rows: int | None, message: str) -> None:
    warehouse.append_log(
        "etl_audit",
        "audit_id",
        "run_time",
        {"status": status, "rows_processed": rows, "message": message[:4000]},
    )
