"""Loading the raw CSV layout into a typed staging table, with bad rows set aside."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.schema import RAW, RAW_COLUMNS, TEXT_WIDTHS

_BROKEN = "_broken_line"
TEXT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_COLUMNS] + [T.StructField(_BROKEN, T.StringType())]
)

STAGED = T.StructType(
    RAW.fields
    + [
        T.StructField("reject_reason", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)
# The format of the delivered files.
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BROKEN,
}


def _timestamp(text: Column, pattern: str | None) -> Column:
    if pattern is None:
        return text.try_cast("timestamp_ntz")
    # A one-field CSV parse is the built-in that reads a zone-free timestamp by pattern and gives
    # NULL on failure; try_to_timestamp would pass through the session's time zone.
    parsed = F.from_csv(text, "v timestamp_ntz", {"timestampNTZFormat": pattern, "sep": "\u0001"})
    return parsed["v"]


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    timestamp_pattern: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """The 11 typed columns plus `reject_reason` and `line`, both NULL for a good row.

    reject_reason holds all reasons, joined by "; ". line is the text of a rejected row: a malformed
    line as it came, else its fields as CSV, so that it can be repaired and loaded again.

    Files: comma-separated, RFC 4180 quotes, one header line, UTF-8; an empty field, quoted or
    not, is NULL. Columns are read as text and cast one by one, so a bad value names its column instead of
    failing the job. Set `multi_line` for files whose quoted fields hold line breaks: such a file
    cannot be split, so many files of moderate size read faster than one large one.
    """
    text = spark.read.schema(TEXT_SCHEMA).csv(path, multiLine=multi_line, **CSV_OPTIONS)
    return typed_rows(text, timestamp_pattern)


def typed_lines(lines: DataFrame, timestamp_pattern: str | None = None, *more: str) -> DataFrame:
    """typed_rows of single lines of the layout in the column `line`, with `more` of their columns."""
    options = {k: str(v) for k, v in CSV_OPTIONS.items() if k in ("sep", "quote", "escape", "mode", "columnNameOfCorruptRecord")}
    fields = F.from_csv("line", ", ".join(f"`{f.name}` STRING" for f in TEXT_SCHEMA.fields), options)
    return typed_rows(lines.select(*more, fields.alias("_fields")).select(*more, "_fields.*"), timestamp_pattern, *more)


def typed_rows(text: DataFrame, timestamp_pattern: str | None = None, *more: str) -> DataFrame:
    """Cast the text columns of the CSV layout and say why a row cannot be loaded; `more` columns stay as they are."""
    # With multi_line, a CRLF file leaves the carriage return on the last field of a line.
    last = RAW_COLUMNS[-1]
    text = text.withColumn(last, F.rtrim(F.col(last), F.lit("\r")))
    columns, reasons = [], []
    for field in RAW.fields:
        raw = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = raw
            fault = F.length(raw) > TEXT_WIDTHS[field.name]
            reason = f"too long: {field.name}"
        else:
            if isinstance(field.dataType, T.TimestampNTZType):
                value = _timestamp(raw, timestamp_pattern)
            else:
                value = raw.try_cast(field.dataType)
            fault = raw.isNotNull() & value.isNull()
            reason = f"not a {field.dataType.simpleString()}: {field.name}"
        columns.append(value.alias(field.name))
        reasons.append(F.when(fault, F.lit(reason)))
    broken = F.when(F.col(_BROKEN).isNotNull(), F.lit("malformed line"))
    every = F.concat_ws("; ", broken, *reasons)
    reason = F.when(every != "", every)
    as_csv = F.to_csv(F.struct(*RAW_COLUMNS), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.when(reason.isNotNull(), F.coalesce(F.col(_BROKEN), as_csv))
    return text.select(*columns, reason.alias("reject_reason"), line.alias("line"), *more)


def stage_csv(
    spark: SparkSession,
    path: str | list[str],
    staging: str,
    timestamp_pattern: str | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Recreate the staging table from CSV files and return (raw rows, rejected rows).

    One pass over the text: the rejected rows are a partition of the same table. Those of every
    delivery are also appended to `<staging>_rejects`, with the time, so the next one leaves them.
    """
    rows = read_csv(spark, path, timestamp_pattern, multi_line)
    rows.withColumn("rejected", F.col("reject_reason").isNotNull()).write.mode("overwrite").partitionBy(
        "rejected"
    ).parquet(staging)
    good, bad = read_staging(spark, staging)
    bad.withColumn("staged_at", F.localtimestamp()).write.mode("append").parquet(f"{staging}_rejects")
    return good, bad


def read_rejects(spark: SparkSession, staging: str) -> DataFrame:
    """The rejected rows of all deliveries: typed columns, reject_reason, line and staged_at."""
    declared = T.StructType([f for f in STAGED.fields if f.name != "rejected"] + [T.StructField("staged_at", T.TimestampNTZType())])
    return spark.read.schema(declared).parquet(f"{staging}_rejects")


def read_staging(spark: SparkSession, staging: str) -> tuple[DataFrame, DataFrame]:
    return split_staged(spark.read.schema(STAGED).parquet(staging))


def split_staged(table: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    good = table.filter(~F.col("rejected")).select(*RAW_COLUMNS, *more)
    bad = table.filter(F.col("rejected")).select(*RAW_COLUMNS, "reject_reason", "line", *more)
    return good, bad
