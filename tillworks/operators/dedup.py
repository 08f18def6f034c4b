"""One row per transaction."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillworks.functions import text_key
from tillworks.operators.bloom import bloom_of, split_by
from tillworks.schema import RAW_COLUMNS
from tillworks.session import saved

# Earliest first; the other columns only settle ties, so that a rerun keeps the same row.
_TIE_BREAK = ["receipt_number"] + [
    c for c in RAW_COLUMNS if c not in ("transaction_id", "transaction_date", "receipt_number")
]


def dedup_transactions(raw: DataFrame) -> DataFrame:
    """The earliest row of every transaction_id. Rows without an id are left to quarantine.

    Only rows whose id repeats are sorted and shuffled as a whole. Which ids do is counted on hashes of them,
    and a Bloom filter of the repeated hashes (broadcast) lets all other rows stay where they lie. A hash that
    two ids share, or a row that passes the filter by chance, only takes a row the longer way. `raw` is read three
    times, so pass a table on files.

    The rank filter is applied by each task before the shuffle as well (WindowGroupLimit), so an
    id that repeats over a large part of the table sends one row per task.
    """
    rows = raw.filter(F.col("transaction_id").isNotNull()).select(*RAW_COLUMNS)
    key = F.xxhash64(text_key("transaction_id"))
    counts = rows.groupBy(key.alias("key")).agg(F.count("*").alias("copies"))
    repeated = saved(counts.filter(F.col("copies") > 1).select("key"))
    doubtful, single = split_by(rows, key, bloom_of(repeated, F.col("key"), repeated.count()))
    earliest = W.partitionBy(text_key("transaction_id")).orderBy(
        F.asc_nulls_first("transaction_date"), *[F.asc_nulls_first(c) for c in _TIE_BREAK]
    )
    first = (
        doubtful.select(*RAW_COLUMNS, F.row_number().over(earliest).alias("_rn"))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )
    return single.unionByName(first)
