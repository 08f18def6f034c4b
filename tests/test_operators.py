"""Operators against brute force on small tables."""

import random

from conftest import rows_of
from pyspark.sql import functions as F

from tillworks.operators.checks import error_samples, fk_orphans, pk_violations, quarantine, run_metrics
from tillworks.operators.dedup import dedup_transactions
from tillworks.operators.grouping import merge_spellings, total_by_text
from tillworks.operators.merge import (
    payment_keys,
    resolve_keys,
    store_keys,
    upsert_payment_methods,
    upsert_stores,
    upsert_transactions,
)
from tillworks.operators.ordering import number_rows, rank_descending, sum_before


def test_numbers_follow_the_global_order(spark):
    words = [f"w{i:04d}" for i in range(500)]
    shuffled = random.Random(1).sample(words, len(words))
    df = spark.createDataFrame([(w,) for w in shuffled], "w string").repartition(7)
    got = number_rows(df, [F.asc("w")], "id", start=10)
    assert rows_of(got, "w", "id") == [(w, i + 11) for i, w in enumerate(words)]


def test_numbers_of_nothing(spark):
    assert number_rows(spark.createDataFrame([], "w string"), [F.asc("w")], "id").count() == 0


def test_sum_before_spans_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    got = {r["id"]: r["s"] for r in sum_before(df, [F.asc("id")], F.col("v"), "s").collect()}
    total = 0
    for i in range(1000):
        assert got[i] == total
        total += i % 7


def test_rank_with_hot_ties_and_nulls(spark):
    rng = random.Random(2)
    # A third of the rows share one value and some have none.
    values = [50] * 100 + [None] * 20 + [rng.randrange(100) for _ in range(180)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v int").repartition(5)
    got = {r["k"]: r["r"] for r in rank_descending(df, "v", "r").collect()}
    for i, v in enumerate(values):
        larger = sum(1 for w in values if w is not None and (v is None or w > v))
        assert got[i] == larger + 1


def test_spellings_are_merged_and_the_smallest_is_shown(spark):
    rows = [("Cash", 1), ("CASH", 2), ("cash ", 4), (" cash", 8), (None, 16), (None, 32)]
    df = spark.createDataFrame(rows, "m string, v int")
    want = sorted([("CASH", 7), (" cash", 8), (None, 48)], key=repr)
    assert rows_of(total_by_text(df, ["m"], {"v": F.sum("v")}), "m", "v") == want
    assert rows_of(merge_spellings(df, ["m"], {"v": F.sum("v")}), "m", "v") == want


def test_dedup_keeps_the_earliest_row(raw):
    got = dedup_transactions(
        raw(
            {"transaction_id": "A", "transaction_date": "2024-01-02 00:00:00", "items_count": 1},
            {"transaction_id": "a ", "transaction_date": "2024-01-01 00:00:00", "items_count": 2},
            {"transaction_id": "B", "transaction_date": None, "items_count": 3},
            {"transaction_id": "B", "transaction_date": "2020-01-01 00:00:00", "items_count": 4},
            {"transaction_id": None, "items_count": 5},
        )
    )
    assert rows_of(got, "transaction_id", "items_count") == [("B", 3), ("a ", 2)]


def test_dedup_ties_do_not_depend_on_arrival(raw):
    rows = [{"transaction_id": "A", "receipt_number": f"R{i}", "items_count": i} for i in range(6)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert rows_of(dedup_transactions(raw(*rows).repartition(3)), "receipt_number") == [("R0",)]


def test_dedup_of_one_hot_id_sends_one_row_per_task(raw):
    df = raw(*[{"transaction_id": "HOT", "items_count": i, "receipt_number": f"{i:03d}"} for i in range(200)])
    result = dedup_transactions(df.repartition(4))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows_of(result, "items_count") == [(0,)]


def test_store_keys_fold_case_blanks_and_missing_city(raw):
    got = store_keys(
        raw(
            {"store_name": "Alpha", "city": "Lagos"},
            {"store_name": "ALPHA ", "city": "lagos"},
            {"store_name": "Alpha", "city": ""},
            {"store_name": "Alpha", "city": None},
            {"store_name": "Alpha", "city": "  "},
            {"store_name": None, "city": "Lagos"},
        )
    )
    assert rows_of(got) == sorted([("ALPHA ", "Lagos"), ("Alpha", None)], key=repr)


def test_payment_keys(raw):
    got = payment_keys(raw({"payment_method": "Card"}, {"payment_method": "card "}, {"payment_method": None}))
    assert rows_of(got) == [("Card",)]


def test_upsert_stores_keeps_ids_and_appends(raw, stores):
    old = stores((7, "Beta", "Abuja"), (3, "Alpha", ""))
    batch = raw(
        {"store_name": "alpha", "city": None},
        {"store_name": "Gamma", "city": "Kano"},
        {"store_name": "Beta", "city": "Kano"},
        {"store_name": None, "city": "Kano"},
    )
    once = upsert_stores(old, batch)
    want = sorted([(7, "Beta", "Abuja"), (3, "Alpha", None), (8, "Beta", "Kano"), (9, "Gamma", "Kano")], key=repr)
    assert rows_of(once) == want
    assert rows_of(upsert_stores(once, batch)) == want


def test_upsert_payment_methods_only_inserts(raw, methods):
    batch = raw({"payment_method": "CASH"}, {"payment_method": "Card"}, {"payment_method": None})
    got = upsert_payment_methods(methods((1, "Cash")), batch)
    assert rows_of(got) == [(1, "Cash"), (2, "Card")]


def test_lookups_leave_missing_keys_null(raw, stores, methods):
    got = resolve_keys(
        raw(
            {"transaction_id": "1", "store_name": "alpha", "city": "LAGOS "},
            {"transaction_id": "2", "store_name": "Alpha", "city": ""},
            {"transaction_id": "3", "store_name": None},
            {"transaction_id": "4", "payment_method": None},
            {"transaction_id": "5", "store_name": "Other", "payment_method": "CASH"},
        ),
        stores((1, "Alpha", "Lagos"), (2, "Alpha", None)),
        methods((1, "Cash")),
    )
    assert rows_of(got, "transaction_id", "store_id", "payment_id") == [
        ("1", 1, 1), ("2", 2, 1), ("3", None, 1), ("4", 1, None), ("5", None, 1),
    ]


def test_upsert_transactions_replaces_inserts_and_keeps(raw, facts, stores, methods):
    target = facts({"transaction_id": "A", "items_count": 1}, {"transaction_id": "B", "items_count": 2})
    batch = raw(
        {"transaction_id": "b ", "items_count": 20},
        {"transaction_id": "C", "items_count": 30},
        {"transaction_id": None, "items_count": 40},
    )
    dims = stores((1, "Alpha", "Lagos")), methods((1, "Cash"))
    once = upsert_transactions(target, batch, *dims)
    want = [("A", 1), ("C", 30), ("b ", 20)]
    assert rows_of(once, "transaction_id", "items_count") == want
    assert rows_of(upsert_transactions(once, batch, *dims)) == rows_of(once)


def test_primary_key_check(facts):
    df = facts({"transaction_id": "A"}, {"transaction_id": "a "}, {"transaction_id": "B"}, {"transaction_id": None})
    assert rows_of(pk_violations(df)) == sorted([("A", 2), (None, 1)], key=repr)


def test_foreign_key_check(facts, stores, methods):
    df = facts(
        {"store_id": 1, "payment_id": 9}, {"store_id": 5, "payment_id": 1}, {"store_id": 5, "payment_id": None},
        {"store_id": None, "payment_id": 1},
    )
    got = fk_orphans(df, stores((1, "Alpha", None), (9, "Beta", None)), methods((1, "Cash")))
    assert rows_of(got, "key_column", "key_value", "row_count") == [("payment_id", 9, 1), ("store_id", 5, 2)]


def test_quarantine_gives_every_reason(raw):
    got = quarantine(
        raw(
            {"transaction_id": None, "receipt_number": "R1"},
            {"transaction_id": "2", "receipt_number": "r1 "},
            {"transaction_id": "3", "transaction_date": None, "receipt_number": "R3"},
            {"transaction_id": "4", "transaction_date": "2030-01-01 00:00:00", "receipt_number": None},
            {"transaction_id": "5", "receipt_number": None},
        ),
        as_of="2024-06-01 00:00:00",
    )
    assert rows_of(got, "transaction_id", "reason") == sorted(
        [
            (None, "missing transaction_id"),
            (None, "repeated receipt_number"),
            ("2", "repeated receipt_number"),
            ("3", "missing transaction_date"),
            ("4", "future transaction_date"),
        ],
        key=repr,
    )


def test_error_samples_are_few_per_reason(raw):
    rows = [{"transaction_id": None, "receipt_number": f"R{i:02d}", "transaction_date": f"2024-01-{i + 1:02d} 00:00:00"} for i in range(20)]
    got = error_samples(raw(*rows), per_reason=3)
    assert rows_of(got, "receipt_number", "sample") == [("R00", 1), ("R01", 2), ("R02", 3)]


def test_run_metrics(raw, facts):
    batch = raw({"transaction_id": "A"}, {"transaction_id": "A"}, {"transaction_id": "B"}, {"transaction_id": None})
    got = run_metrics(batch, facts({"transaction_id": "a"}, {"transaction_id": "Z"})).first().asDict()
    assert got == {"rows_read": 4, "rows_without_id": 1, "rows_processed": 2, "rows_updated": 1, "rows_inserted": 1}
