"""Numbering in a global order without one task that sees every row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillworks.session import ensure_checkpoint_dir

_PART = "_range_part"


def sum_before(df: DataFrame, order: list[Column], weight: Column, name: str) -> DataFrame:
    """Add the sum of `weight` over all rows that sort before each row.

    Rows are range-partitioned on the order, so a row's sum is the total of the earlier partitions
    plus the running sum in its own. Only the per-partition totals, one row per partition, meet in
    a single task. The range partitioning is checkpointed because its bounds come from a sample:
    the two branches below have to see the same partitions. Order columns must be unique together.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = (
        df.withColumn("_weight", weight.cast("long"))
        .repartitionByRange(*order)
        .withColumn(_PART, F.spark_partition_id())
        .checkpoint()
    )
    earlier_parts = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(_PART)
        .agg(F.sum("_weight").alias("_part_total"))
        .select(_PART, F.coalesce(F.sum("_part_total").over(earlier_parts), F.lit(0)).alias("_offset"))
    )
    earlier_rows = W.partitionBy(_PART).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        parts.withColumn("_inside", F.coalesce(F.sum("_weight").over(earlier_rows), F.lit(0)))
        .join(offsets, _PART)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop(_PART, "_weight", "_inside", "_offset")
    )


def number_rows(df: DataFrame, order: list[Column], name: str, start: int | Column = 0) -> DataFrame:
    """1, 2, 3, ... in the given unique order, continuing after `start`."""
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = sum_before(df, order, F.lit(1), name)
    return numbered.withColumn(name, (F.col(name) + 1 + first).cast("int"))


def rank_descending(df: DataFrame, value: str, name: str) -> DataFrame:
    """SQL RANK() over the whole table, largest value first and NULL last.

    Ranks are worked out once per distinct value and joined back, so rows tied on one value are
    never gathered in one task: they are counted with partial aggregation, and the join back is an
    ordinary one that adaptive execution splits when a value is hot. The input, an aggregate, is
    checkpointed because it is read twice and the facts behind it should be scanned once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    tied = df.groupBy(value).agg(F.count("*").alias("_tied"))
    ranks = sum_before(tied, [F.desc_nulls_last(value)], F.col("_tied"), name).select(
        F.col(value).alias("_value"), (F.col(name) + 1).alias(name)
    )
    return df.join(ranks, df[value].eqNullSafe(ranks["_value"])).drop("_value")
