"""Grouping on text whose spelling varies."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import text_key


def merge_spellings(
    df: DataFrame, text: list[str], measures: dict[str, Column], keys: list[str] | None = None
) -> DataFrame:
    """Group by `keys` and by the text columns under text_key, showing the smallest spelling.

    MIN over text cannot be hash-aggregated, so each task sorts its rows first. Use this on rows
    that are already few (pre-aggregated, or joined from a dimension) or nearly unique.
    """
    grouped = df.groupBy(*(keys or []), *[text_key(c).alias(f"_key_{c}") for c in text])
    return grouped.agg(
        *[F.min(c).alias(c) for c in text], *[m.alias(n) for n, m in measures.items()]
    ).drop(*[f"_key_{c}" for c in text])


def distinct_spellings(df: DataFrame, text: list[str]) -> DataFrame:
    """DISTINCT that stays in the plan when merge_spellings follows.

    The optimizer drops a plain DISTINCT below a MIN as redundant, which leaves every row to the
    sort of merge_spellings. It cannot know that the count is positive, so this one is kept.
    """
    counted = df.groupBy(*text).agg(F.count("*").alias("_copies"))
    return counted.filter(F.col("_copies") > 0).select(*text)


def total_by_text(
    df: DataFrame, text: list[str], measures: dict[str, Column], keys: list[str] | None = None
) -> DataFrame:
    """As merge_spellings for many rows per spelling; every measure must be a sum or a count.

    The first step hash-aggregates on the exact spelling, with map-side partial sums, so the sort
    of the second one sees one row per spelling.
    """
    spelled = df.groupBy(*(keys or []), *text).agg(*[m.alias(n) for n, m in measures.items()])
    return merge_spellings(spelled, text, {n: F.sum(n) for n in measures}, keys)
