"""Running totals per key, and joins, that don't bring a hot key into one task."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillworks.session import saved

_PART = "_scan_part"
#: A key with this share of all rows or more is hot, so there are at most as many hot keys.
HOT_SHARE = 1000

Aggregate = Callable[[Column], Column]


def xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def plus(a: Column, b: Column) -> Column:
    return a + b


def scan_by_key(df: DataFrame, key: str, order: list[Column], **totals: tuple[Column, Aggregate, Callable]) -> DataFrame:
    """Add columns with running totals over the rows of a key, up to and with each row itself.

    A total is (value, aggregate, how two aggregates combine). Rows are range-partitioned by key and
    order, so a key of any size spreads over as many tasks as it fills. A row's total is that of its key's
    rows in earlier partitions, combined with the running one in its own. Only the first key of a
    partition can have earlier rows, so the table of those is no longer than there are partitions,
    and is broadcast. The partitions come from sampled bounds; they are written, and both
    branches read the same ones. Rows that tie in the whole order count as any one of them first.
    """
    parts = saved(df.repartitionByRange(F.col(key), *order).withColumn(_PART, F.spark_partition_id()))
    values = {name: value for name, (value, _, _) in totals.items()}
    total = {name: aggregate for name, (_, aggregate, _) in totals.items()}
    earlier = W.partitionBy(key).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        parts.groupBy(_PART, key)
        .agg(*[total[n](values[n]).alias(n) for n in totals])
        .select(_PART, key, *[total[n](F.col(n)).over(earlier).alias(f"_before_{n}") for n in totals], F.row_number().over(W.partitionBy(key).orderBy(_PART)).alias("_nth"))
        .filter("_nth > 1")
        .drop("_nth")
    )
    inside = W.partitionBy(_PART, key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = parts.select("*", *[total[n](values[n]).over(inside).alias(f"_inside_{n}") for n in totals])
    joined = running.join(F.broadcast(carried), [_PART, key], "left")
    results = []
    for n, (_, _, combine) in totals.items():
        before, now = F.col(f"_before_{n}"), F.col(f"_inside_{n}")
        results.append(F.when(before.isNull(), now).otherwise(combine(before, now)).alias(n))
    return joined.select(*df.columns, *results)


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join rows to a table that has one row for each key and, in `weight`, about how many rows the key has.

    Keys with a thousandth of the total weight or more are joined by broadcasting their rows of the
    table: there are a thousand of them at most. What is dealt by key has no hot one left. how is
    inner or left. Both tables are read twice: pass tables on files.
    """
    is_hot = F.coalesce(F.col(weight) * HOT_SHARE >= table.agg(F.sum(weight)).scalar(), F.lit(False))
    hot, cold = saved(table.filter(is_hot)), table.filter(~is_hot)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on, how))
