"""The daily job: merges, repeats, moves between months, failures, logs and the summary table."""

from dataclasses import replace

import pytest
from conftest import rows_of

from tillworks.plans.etl import CheckFailed, compact, log_error, run_etl, save_suspects
from tillworks.plans.summary import load_daily_summary
from tillworks.plans.views import register_views
from tillworks.sources.warehouse import Warehouse, WriteConflict


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), recreate=True)


def tables(warehouse):
    return (
        rows_of(warehouse.stores()),
        rows_of(warehouse.payment_methods()),
        rows_of(warehouse.transactions()),
    )


BATCH1 = [
    {"transaction_id": "A", "transaction_date": "2024-01-10 10:00:00"},
    {"transaction_id": "B", "transaction_date": "2024-01-31 23:30:00", "store_name": "Beta"},
    {"transaction_id": "C", "transaction_date": "2024-03-01 10:00:00", "city": None},
    {"transaction_id": "N", "transaction_date": None, "payment_method": None},
    {"transaction_id": None},
]
BATCH2 = [
    # B is delivered again, an hour later and so in another month.
    {"transaction_id": "B", "transaction_date": "2024-02-01 00:30:00", "store_name": "Beta", "items_count": 9},
    {"transaction_id": "D", "transaction_date": "2024-03-02 10:00:00", "store_name": "Aaa", "payment_method": "Card"},
]


def test_batches_merge_and_repeats_change_nothing(warehouse, raw):
    assert run_etl(warehouse, raw(*BATCH1)).rows_processed == 4
    first_ids = {(r[1], r[2]): r[0] for r in rows_of(warehouse.stores())}
    result = run_etl(warehouse, raw(*BATCH2))
    assert result.months == {"2024-01", "2024-02", "2024-03"}
    after = tables(warehouse)
    assert [(r[0], str(r[3])[:7], r[4]) for r in after[2]] == [
        ("A", "2024-01", 1), ("B", "2024-02", 9), ("C", "2024-03", 1), ("D", "2024-03", 1), ("N", "None", 1),
    ]
    ids = {(r[1], r[2]): r[0] for r in after[0]}
    assert first_ids.items() <= ids.items()
    assert ids[("Aaa", "Lagos")] == max(first_ids.values()) + 1
    for batch in (BATCH2, BATCH2):
        run_etl(warehouse, raw(*batch))
        assert tables(warehouse) == after


def test_new_rows_leave_the_files_of_their_month_alone(warehouse, raw):
    run_etl(warehouse, raw(*BATCH1))
    run_etl(warehouse, raw({"transaction_id": "E", "transaction_date": "2024-01-11 10:00:00"}))
    assert warehouse.state().month_runs == {"2024-01": [1, 2], "2024-03": [1], "undated": [1]}
    run_etl(warehouse, raw({"transaction_id": "A", "transaction_date": "2024-01-12 10:00:00"}))
    assert warehouse.state().month_runs["2024-01"] == [1, 2, 3]
    assert rows_of(warehouse.transactions(), "transaction_id") == [("A",), ("B",), ("C",), ("E",), ("N",)]


def test_only_the_caller_compacts_months(warehouse, raw):
    for i in range(3):
        run_etl(warehouse, raw({"transaction_id": f"T{i}"}))
    assert warehouse.state().month_runs == {"2024-01": [1, 2, 3]}
    before = tables(warehouse)
    assert compact(warehouse, {"2024-01", "2030-01"}) == 4
    assert warehouse.state().month_runs == {"2024-01": [4]} and tables(warehouse) == before
    assert compact(warehouse, {"2030-01"}) is None
    assert run_etl(warehouse, raw({"transaction_id": "T3"})).run == 5
    assert warehouse.state().month_runs == {"2024-01": [4, 5]}


def test_a_snapshot_holds_one_run(warehouse, raw):
    run_etl(warehouse, raw(*BATCH1))
    snapshot = warehouse.snapshot()
    run_etl(warehouse, raw(*BATCH2))
    assert rows_of(snapshot.stores()) != rows_of(warehouse.stores())
    known = {r["store_id"] for r in snapshot.stores().collect()}
    assert {r["store_id"] for r in snapshot.transactions().collect()} - {None} <= known
    assert {r["sales_month"] for r in snapshot.transactions({"2024-03"}).collect()} == {"2024-03"}


def test_recreating_leaves_nothing_of_the_old_warehouse(warehouse, raw, spark):
    result = run_etl(warehouse, raw(*BATCH1))
    save_suspects(warehouse, raw(*BATCH1), result.run)
    anew = Warehouse(spark, warehouse.root, recreate=True)
    assert anew.suspects("quarantine").count() == 0
    assert run_etl(anew, raw({"transaction_id": "Z"})).run == 1
    assert anew.suspects("quarantine").count() == 0 and anew.transactions().count() == 1


def test_two_writers_cannot_both_publish(warehouse, raw):
    run_etl(warehouse, raw(*BATCH1))
    state = warehouse.state()
    warehouse.publish(replace(state, run=2))
    with pytest.raises(WriteConflict):
        warehouse.publish(replace(state, run=2))


def test_a_month_that_loses_all_rows_disappears(warehouse, raw):
    run_etl(warehouse, raw({"transaction_id": "A", "transaction_date": "2024-01-31 23:30:00"}))
    run_etl(warehouse, raw({"transaction_id": "A", "transaction_date": "2024-02-01 00:30:00"}))
    assert warehouse.state().month_runs == {"2024-02": [2]}


def test_readers_see_old_tables_until_the_run_is_published(warehouse, raw, monkeypatch):
    run_etl(warehouse, raw(*BATCH1))
    before, held = tables(warehouse), warehouse.transactions()
    held_rows = rows_of(held)

    def broken(self, state):
        raise OSError("disk full " + "x" * 5000)

    monkeypatch.setattr(Warehouse, "publish", broken)
    with pytest.raises(OSError):
        run_etl(warehouse, raw(*BATCH2))
    assert tables(warehouse) == before
    errors = warehouse.table("error_log").collect()
    assert len(errors) == 1 and len(errors[0]["error_message"]) == 4000
    assert (errors[0]["error_id"], errors[0]["procedure_name"]) == (1, "run_etl")
    assert errors[0]["error_line"] is not None and errors[0]["error_time"] is not None
    monkeypatch.undo()
    run_etl(warehouse, raw(*BATCH2))
    assert rows_of(held) == held_rows
    assert len(rows_of(warehouse.transactions())) == 5
    audit = [(r["audit_id"], r["status"], r["rows_processed"]) for r in warehouse.table("etl_audit").orderBy("audit_id").collect()]
    assert audit == [(1, "SUCCESS", 4), (2, "FAILED", None), (3, "SUCCESS", 2)]


def test_ambiguous_dimension_stops_the_run(warehouse, raw, spark, stores):
    # Two rows for one store would give every transaction twice.
    run_etl(warehouse, raw(*BATCH1))
    state = warehouse.state()
    warehouse.write_dimension("stores", stores((1, "Alpha", "Lagos"), (2, "alpha", "Lagos")), state.stores_run)
    before = warehouse.state()
    with pytest.raises(CheckFailed):
        run_etl(warehouse, raw({"transaction_id": "Z"}))
    assert warehouse.state() == before


def test_empty_batch(warehouse, raw):
    assert run_etl(warehouse, raw()).rows_processed == 0
    assert tables(warehouse) == ([], [], [])


def test_log_error_without_traceback(warehouse):
    log_error(warehouse, ValueError(), "step")
    assert warehouse.table("error_log").first()["error_message"] == "NULL"


def test_opening_a_warehouse_keeps_it_and_recreating_clears_it(warehouse, raw, spark):
    run_etl(warehouse, raw(*BATCH1))
    assert Warehouse(spark, warehouse.root).state().run == 1
    assert Warehouse(spark, warehouse.root, recreate=True).state().run == 0


def test_daily_summary_table_replaces_days(warehouse, raw):
    run_etl(warehouse, raw(*BATCH1))
    load_daily_summary(warehouse)
    first = {r["report_date"]: r["summary_id"] for r in warehouse.daily_summary().collect()}
    assert sorted(first.values()) == [1, 2, 3, 4]
    result = run_etl(warehouse, raw(*BATCH2))
    load_daily_summary(warehouse, set(result.months))
    second = warehouse.daily_summary().collect()
    shown = {str(r["report_date"]): (r["summary_id"], r["total_transactions"], r["top_store"]) for r in second}
    ids = {str(d): i for d, i in first.items()}
    assert shown == {
        "None": (ids["None"], 1, "Alpha"),
        "2024-01-10": (ids["2024-01-10"], 1, "Alpha"),
        "2024-02-01": (5, 1, "Beta"),
        "2024-03-01": (ids["2024-03-01"], 1, "Alpha"),
        "2024-03-02": (6, 1, "Aaa"),
    }
    load_daily_summary(warehouse, set(result.months))
    assert rows_of(warehouse.daily_summary()) == sorted((tuple(r) for r in second), key=repr)


def test_basic_daily_summary_fills_three_columns(warehouse, raw):
    run_etl(warehouse, raw({"transaction_id": "A"}))
    load_daily_summary(warehouse, basic=True)
    row = warehouse.daily_summary().first().asDict()
    assert (row["total_transactions"], str(row["total_revenue"])) == (1, "100.00")
    assert [row[c] for c in ("transactions_with_discount", "total_loyalty_points", "top_city", "top_store")] == [None] * 4


def test_views(warehouse, raw, spark):
    run_etl(warehouse, raw(*BATCH1))
    load_daily_summary(warehouse)
    register_views(spark, warehouse)
    got = spark.sql("SELECT store_name, total_revenue FROM vw_revenue_per_store")
    assert [(n, str(v)) for n, v in rows_of(got)] == [("Alpha", "300.00"), ("Beta", "100.00")]
    assert spark.sql("SELECT * FROM vw_daily_revenue").columns == ["report_date", "daily_revenue"]
    assert spark.sql("SELECT count(*) FROM transactions JOIN stores USING (store_id)").first()[0] == 4
    assert spark.sql("SELECT count(*) FROM etl_audit").first()[0] == 1


def test_suspects_are_kept_by_run_and_reason(warehouse, raw):
    result = run_etl(warehouse, raw(*BATCH1))
    for _ in range(2):
        save_suspects(warehouse, raw(*BATCH1), result.run)
    kept = warehouse.suspects("quarantine")
    assert rows_of(kept.groupBy("run", "reason").count()) == [
        (1, "missing transaction_date", 1), (1, "missing transaction_id", 1), (1, "repeated receipt_number", 5),
    ]
    # A run that was never published shows nothing.
    warehouse.write_suspects("quarantine", kept.drop("run"), warehouse.new_run())
    assert warehouse.suspects("quarantine").count() == 7
    samples = warehouse.suspects("error_samples").filter("reason = 'repeated receipt_number'")
    assert sorted(r["sample"] for r in samples.collect()) == [1, 2, 3, 4, 5]
