"""Upserts as joins and unions: existing rows keep their ids, new keys get the next ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions import blank_to_null, city_key, text_key
from tillworks.operators.bloom import bloom_of, split_by
from tillworks.operators.dedup import dedup_transactions
from tillworks.operators.grouping import distinct_spellings, merge_spellings
from tillworks.operators.ordering import number_rows
from tillworks.schema import TRANSACTION_COLUMNS
from tillworks.session import saved


def store_keys(raw: DataFrame) -> DataFrame:
    """Distinct (store_name, city) of the batch; rows without a store name have none."""
    named = distinct_spellings(raw.filter(F.col("store_name").isNotNull()), ["store_name", "city"])
    spelled = named.withColumn("city", blank_to_null("city"))
    return merge_spellings(spelled, ["store_name", "city"], {}).select("store_name", "city")


def payment_keys(raw: DataFrame) -> DataFrame:
    spelled = distinct_spellings(raw.filter(F.col("payment_method").isNotNull()), ["payment_method"])
    return merge_spellings(spelled, ["payment_method"], {}).select("payment_method")


def _largest_id(table: DataFrame, column: str):
    return table.agg(F.coalesce(F.max(column), F.lit(0)).alias("_max")).scalar()


def upsert_stores(stores: DataFrame, raw: DataFrame) -> DataFrame:
    """Stores after the batch, matched on name and city; NULL and '' are the same city."""
    old = stores.select(
        text_key("store_name").alias("_name"), city_key("city").alias("_city")
    )
    found = store_keys(raw)
    new = found.join(
        old, (text_key(found["store_name"]) == old["_name"]) & (city_key(found["city"]) == old["_city"]),
        "left_anti",
    )
    numbered = number_rows(
        new,
        [F.asc("store_name"), F.asc_nulls_first("city")],
        "store_id",
        start=_largest_id(stores, "store_id"),
    )
    kept = stores.select("store_id", "store_name", blank_to_null("city").alias("city"))
    return kept.unionByName(numbered.select("store_id", "store_name", "city"))


def upsert_payment_methods(payment_methods: DataFrame, raw: DataFrame) -> DataFrame:
    """Payment methods after the batch; nothing is updated, only new ones are added."""
    old = payment_methods.select(text_key("payment_method").alias("_method"))
    found = payment_keys(raw)
    new = found.join(old, text_key(found["payment_method"]) == old["_method"], "left_anti")
    numbered = number_rows(
        new, [F.asc("payment_method")], "payment_id", start=_largest_id(payment_methods, "payment_id")
    )
    return payment_methods.unionByName(numbered.select("payment_id", "payment_method"))


def resolve_keys(rows: DataFrame, stores: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """Replace the natural keys by ids; a row without a dimension row keeps a NULL id.

    No broadcast hint: dimensions read from files are broadcast when their size on disk allows,
    and otherwise joined by shuffle, where adaptive execution splits a hot store.
    """
    s = stores.select(
        "store_id", text_key("store_name").alias("_name"), city_key("city").alias("_city")
    )
    p = payment_methods.select("payment_id", text_key("payment_method").alias("_method"))
    return (
        rows.join(
            s, (text_key(rows["store_name"]) == s["_name"]) & (city_key(rows["city"]) == s["_city"]), "left"
        )
        .join(p, text_key(rows["payment_method"]) == p["_method"], "left")
        .select(*TRANSACTION_COLUMNS)
    )


def merge_source(raw: DataFrame, stores: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """What the batch writes into the transactions: deduplicated, ids looked up."""
    return resolve_keys(dedup_transactions(raw), stores, payment_methods)


def not_in(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows whose transaction_id the source does not have.

    Rows that the Bloom filter of the source's ids rules out stay where they lie; the rest are joined by
    the ids themselves. The source's ids are saved, so that they are worked out once.
    """
    new_ids = saved(source.select(text_key("transaction_id").alias("_id")).distinct())
    key = text_key("transaction_id")
    doubtful, others = split_by(target, key, bloom_of(new_ids, F.col("_id"), new_ids.count()))
    return others.unionByName(doubtful.join(new_ids, key == new_ids["_id"], "left_anti"))


def upsert_transactions(
    target: DataFrame, raw: DataFrame, stores: DataFrame, payment_methods: DataFrame
) -> DataFrame:
    """Transactions after the batch: its rows replace those of the same id, the others stay."""
    source = merge_source(raw, stores, payment_methods)
    # The batch has the ids of its source and needs no deduplication to tell them; a row without an id matches none.
    return not_in(target.select(*TRANSACTION_COLUMNS), raw).unionByName(source)
