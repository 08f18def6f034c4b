"""Calendar expressions and filters that reach the file scan."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions.text import as_column

MONTH_COLUMN = "sales_month"


def month_of(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_of_year(ts: Column | str) -> Column:
    """Week number with week 1 holding 1 January and weeks starting on Sunday."""
    column = as_column(ts)
    # dayofweek counts Sunday as 1, so this many days precede 1 January in its week.
    days_before = F.dayofweek(F.trunc(column, "YEAR")) - 1
    return (F.floor((F.dayofyear(column) + days_before - 1) / 7) + 1).cast("int")


def as_of_time(as_of: dt.datetime | str | None) -> Column:
    """The moment that counts as 'now': fixed when given, else the time of the run."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _between(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    ts = F.col("transaction_date")
    return df.filter(
        (ts >= F.lit(f"{start} 00:00:00").cast("timestamp_ntz"))
        & (ts < F.lit(f"{end} 00:00:00").cast("timestamp_ntz"))
    )


def in_month(df: DataFrame, month: str) -> DataFrame:
    """Rows of one 'YYYY-MM'. The range goes to the scan; the partition column prunes files."""
    start = dt.date.fromisoformat(f"{month}-01")
    end = (start + dt.timedelta(days=31)).replace(day=1)
    rows = _between(df, start, end)
    if MONTH_COLUMN in df.columns:
        rows = rows.filter(F.col(MONTH_COLUMN) == month)
    return rows


def in_year(df: DataFrame, year: int) -> DataFrame:
    rows = _between(df, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))
    if MONTH_COLUMN in df.columns:
        rows = rows.filter(F.col(MONTH_COLUMN).between(f"{year:04d}-01", f"{year:04d}-12"))
    return rows
