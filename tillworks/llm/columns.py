"""Small helpers for the columns the operators work on."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that the table does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def once(function: Callable[..., Column]) -> Callable[..., Column]:
    """The Python function, run only where it is written.

    Spark copies a deterministic one into each filter that it moves or infers below it: a task then has
    two Python workers for the same values, which stay until their executor has been idle for a minute.
    """
    return function.asNondeterministic()


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def typed_like(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of `like`, in its order and with its types."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in like.schema.fields])
