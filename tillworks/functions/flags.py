"""Conditional counts and the discount flag, which arrives as free text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillworks.functions.text import as_column, text_key

# The accepted spellings of the flag under text_key. Any other value is neither.
DISCOUNT_YES = ["TRUE", "1"]
DISCOUNT_NO = ["FALSE", "0"]


def discounted(flag: Column | str = "discount_applied") -> Column:
    return text_key(flag).isin(DISCOUNT_YES)


def full_price(flag: Column | str = "discount_applied") -> Column:
    return text_key(flag).isin(DISCOUNT_NO)


def count_when(condition: Column) -> Column:
    """Rows meeting the condition; 0 when none does."""
    return F.sum(F.when(condition, 1).otherwise(0))


def count_if_null(column: Column | str) -> Column:
    """NULL values in the column; NULL, not 0, when there is none."""
    return F.sum(F.when(as_column(column).isNull(), 1))
