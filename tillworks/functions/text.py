"""Text comparison: letter case and trailing blanks do not count, leading blanks do."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def text_key(text: Column | str) -> Column:
    """The form under which two spellings of one value are equal."""
    return F.upper(F.rtrim(as_column(text)))


def trimmed_upper(text: Column | str) -> Column:
    """Both ends trimmed, upper case: the cashier spelling of the target reports."""
    return F.upper(F.trim(as_column(text)))


def blank_to_null(text: Column | str) -> Column:
    """'' and blanks become NULL, so that one place has one form of 'no city'."""
    return F.when(F.rtrim(as_column(text)) != "", as_column(text))


def city_key(city: Column | str) -> Column:
    """text_key in which NULL and '' are the same value and equal to themselves."""
    return F.coalesce(text_key(city), F.lit(""))
