"""Rows that break a rule: set aside, counted or sampled."""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillworks.functions import as_of_time, text_key
from tillworks.operators.dedup import dedup_transactions
from tillworks.schema import RAW_COLUMNS
from tillworks.session import saved


def pk_violations(transactions: DataFrame) -> DataFrame:
    """Transaction ids (as text_key) that are NULL or repeated, with their row count."""
    counts = transactions.groupBy(text_key("transaction_id").alias("transaction_id")).agg(
        F.count("*").alias("row_count")
    )
    return counts.filter(F.col("transaction_id").isNull() | (F.col("row_count") > 1))


def fk_orphans(
    transactions: DataFrame, stores: DataFrame, payment_methods: DataFrame
) -> DataFrame:
    """Store and payment ids of the facts that have no dimension row, with their row count.

    The facts are scanned once and reduced to their id pairs before anything is joined.
    """
    pairs = transactions.groupBy("store_id", "payment_id").agg(F.count("*").alias("n"))
    used = (
        pairs.select(
            F.explode(
                F.array(
                    F.struct(F.lit("store_id").alias("key_column"), F.col("store_id").alias("key_value")),
                    F.struct(F.lit("payment_id").alias("key_column"), F.col("payment_id").alias("key_value")),
                )
            ).alias("key"),
            "n",
        )
        .select("key.*", "n")
        .filter(F.col("key_value").isNotNull())
        .groupBy("key_column", "key_value")
        .agg(F.sum("n").alias("row_count"))
    )
    known = stores.select(F.lit("store_id").alias("key_column"), F.col("store_id").alias("key_value")).unionAll(
        payment_methods.select(F.lit("payment_id"), F.col("payment_id"))
    )
    return used.join(known, ["key_column", "key_value"], "left_anti")


REPEATED_RECEIPT = "repeated receipt_number"


def _faults(as_of: dt.datetime | str | None) -> dict[str, Column]:
    """The reasons that show in the row itself."""
    ts = F.col("transaction_date")
    return {
        "missing transaction_id": F.col("transaction_id").isNull(),
        "missing transaction_date": ts.isNull(),
        "future transaction_date": ts > as_of_time(as_of),
    }


def _repeated_receipts(raw: DataFrame) -> DataFrame:
    """Receipts on more than one row, counted with partial sums and never gathered per receipt."""
    counts = (
        raw.filter(F.col("receipt_number").isNotNull())
        .groupBy(text_key("receipt_number").alias("_receipt"))
        .agg(F.count("*").alias("_copies"))
    )
    return saved(counts.filter(F.col("_copies") > 1).select("_receipt"))


def quarantine(raw: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Suspect rows with one output row per reason.

    A missing id keeps a row out of the transactions; the other reasons only flag it.
    """
    repeated = _repeated_receipts(raw)
    flagged = raw.select(*RAW_COLUMNS).join(
        repeated, text_key(raw["receipt_number"]) == repeated["_receipt"], "left"
    )
    faults = _faults(as_of) | {REPEATED_RECEIPT: F.col("_receipt").isNotNull()}
    suspect = reduce(Column.__or__, [F.coalesce(f, F.lit(False)) for f in faults.values()])
    reasons = F.array(*[F.when(fault, F.lit(reason)) for reason, fault in faults.items()])
    return (
        flagged.filter(suspect)
        .select(*RAW_COLUMNS, F.explode(reasons).alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def error_samples(
    raw: DataFrame, as_of: dt.datetime | str | None = None, per_reason: int = 5
) -> DataFrame:
    """The first rows of every reason, to be shown next to the error log.

    One top-n per reason: each task keeps n rows, where a window over the reasons would sort every
    suspect row. The conditions on single columns reach the file scan.
    """
    rest = [c for c in RAW_COLUMNS if c not in ("transaction_date", "transaction_id")]
    order = [F.asc_nulls_first(c) for c in ("transaction_date", "transaction_id", *rest)]
    repeated = _repeated_receipts(raw)
    suspects = {reason: raw.filter(fault) for reason, fault in _faults(as_of).items()}
    suspects[REPEATED_RECEIPT] = raw.join(
        repeated, text_key(raw["receipt_number"]) == repeated["_receipt"], "left_semi"
    )
    samples = [
        rows.select(*RAW_COLUMNS, F.lit(reason).alias("reason")).orderBy(*order).limit(per_reason)
        for reason, rows in suspects.items()
    ]
    numbered = F.row_number().over(W.partitionBy("reason").orderBy(*order))
    return reduce(DataFrame.unionAll, samples).withColumn("sample", numbered)


def run_metrics(raw: DataFrame, target: DataFrame) -> DataFrame:
    """What merging the batch into the target means: one row of counts."""
    read = raw.agg(
        F.count("*").alias("rows_read"),
        F.coalesce(F.sum(F.when(F.col("transaction_id").isNull(), 1)), F.lit(0)).alias("rows_without_id"),
    )
    source = dedup_transactions(raw).select(text_key("transaction_id").alias("_id"))
    known = target.select(text_key("transaction_id").alias("_known"))
    merged = source.join(known, source["_id"] == known["_known"], "left").agg(
        F.count("*").alias("rows_processed"), F.count("_known").alias("rows_updated")
    )
    row = F.struct("rows_processed", "rows_updated")
    return (
        read.withColumn("_m", merged.select(row.alias("m")).scalar())
        .select("rows_read", "rows_without_id", "_m.*")
        .withColumn("rows_inserted", F.col("rows_processed") - F.col("rows_updated"))
    )
