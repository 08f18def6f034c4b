"""Versions, writers at the same moment, merge on read, the id filter and what a landing folder leaves."""

import datetime as dt
import threading
from dataclasses import replace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_csv_load import line, write

from tillworks.operators.bloom import bloom_of, maybe_in
from tillworks.plans import etl
from tillworks.plans.etl import compact, replaced, run_etl
from tillworks.sources.warehouse import Part, Warehouse, WriteConflict
from tillworks.streaming import new_files
from tillworks.streaming.new_files import merge_new_files


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), recreate=True)


def batch(raw, *ids, day="2024-01-10"):
    return raw(*[{"transaction_id": i, "transaction_date": f"{day} 10:00:00", "receipt_number": day} for i in ids])


def test_a_replaced_row_writes_no_other_row(spark, warehouse, raw):
    run_etl(warehouse, batch(raw, "A", "B", "C"))
    run_etl(warehouse, batch(raw, "b ", day="2024-03-10"))
    assert warehouse.written(2).count() == 1
    state = warehouse.state()
    assert {(p.kind, p.sales_month, p.run, p.rows, p.dead) for p in state.parts} == {
        ("facts", "2024-01", 1, 3, 1), ("facts", "2024-03", 2, 1, 0), ("replaced", "2024-01", 2, 1, 0),
    }
    before = rows_of(warehouse.transactions())
    assert [r[0] for r in before] == ["A", "C", "b "]
    held = warehouse.transactions()
    compact(warehouse, {"2024-01", "2024-03"})
    assert rows_of(warehouse.transactions()) == before == rows_of(held)
    assert {p.kind for p in warehouse.state().parts} == {"facts"}
    assert not any(p.dead for p in warehouse.state().parts)


def test_a_row_replaced_again_and_again_counts_once(warehouse, raw):
    run_etl(warehouse, batch(raw, "A", "B"))
    for day in ("2024-01-11", "2024-02-01", "2024-01-12", "2024-01-12"):
        run_etl(warehouse, batch(raw, "A", day=day))
        assert rows_of(warehouse.transactions(), "transaction_id", "receipt_number") == [("A", day), ("B", "2024-01-10")]
    # February has lost its only row, and the runs of January's other rows of A are gone as a whole.
    assert warehouse.state().month_runs == {"2024-01": [1, 5]}


def test_reading_some_months_opens_only_their_files(warehouse, raw):
    run_etl(warehouse, batch(raw, "A"))
    run_etl(warehouse, batch(raw, "B", day="2024-02-10"))
    run_etl(warehouse, batch(raw, "C", "D", day="2024-03-10"))
    run_etl(warehouse, batch(raw, "D", day="2024-02-11"))
    state = warehouse.state()
    assert all("sales_month=2024-02" in f for f in warehouse.transactions(state, {"2024-02"}).inputFiles())
    assert rows_of(warehouse.transactions(state, {"2024-03"}), "transaction_id") == [("C",)]
    assert warehouse.transactions(state, {"2030-01"}).count() == 0


def test_dates_and_counts_are_in_the_manifest(warehouse, raw):
    run_etl(warehouse, raw({"transaction_id": "A", "transaction_date": "2024-01-02 03:04:05"}, {"transaction_id": "B", "transaction_date": "2024-01-31 00:00:00"}, {"transaction_id": "N", "transaction_date": None}))
    assert set(warehouse.state().parts) == {
        Part("facts", "2024-01", 1, 2, 0, dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 31)),
        Part("facts", "undated", 1, 1),
    }


def test_two_writers_of_one_version(spark, warehouse, raw, monkeypatch):
    """The second writer starts before the first publishes and publishes after it: it fails, and may run again."""
    run_etl(warehouse, batch(raw, "A"))
    other = Warehouse(spark, warehouse.root)
    publish = Warehouse.publish

    def late(self, state):
        if self is warehouse:
            run_etl(other, batch(raw, "B"))
        publish(self, state)

    monkeypatch.setattr(Warehouse, "publish", late)
    with pytest.raises(WriteConflict):
        run_etl(warehouse, batch(raw, "C"))
    monkeypatch.undo()
    assert rows_of(other.transactions(), "transaction_id") == [("A",), ("B",)]
    run_etl(warehouse, batch(raw, "C"))
    assert rows_of(warehouse.transactions(), "transaction_id") == [("A",), ("B",), ("C",)]


def test_of_many_writers_at_one_moment_one_wins(spark, warehouse):
    state, start, won = warehouse.state(), threading.Barrier(6), []

    def writer(run):
        start.wait()
        if warehouse._create("commits/0000000001.json", f'{{"run": {run}}}'):
            won.append(run)

    threads = [threading.Thread(target=writer, args=(run,)) for run in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(won) == 1
    assert warehouse.names_in("commits") == ["0000000001.json"]
    assert warehouse.published().first()["run"] == won[0]
    with pytest.raises(WriteConflict):
        warehouse.publish(replace(state, run=7))


def test_run_numbers_are_given_once(spark, warehouse):
    numbers, other = [], Warehouse(spark, warehouse.root)
    threads = [threading.Thread(target=lambda w=w: numbers.append(w.new_run())) for w in (warehouse, other) * 4]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(numbers) == list(range(1, 9))


def test_many_directories_are_published_fast(spark, warehouse):
    parts = tuple(Part("facts", f"{2000 + m // 12}-{m % 12 + 1:02d}", run, 10) for m in range(240) for run in range(59))
    warehouse.publish(replace(warehouse.state(), run=1, parts=parts))
    assert sorted(map(repr, warehouse.state().parts)) == sorted(map(repr, parts))


def test_filter_loses_no_key_and_drops_most_others(spark):
    ids = spark.range(5000).select(F.concat(F.lit("TXN"), "id").alias("id"))
    bloom = bloom_of(ids, F.col("id"), 5000)
    assert maybe_in(ids, F.col("id"), bloom).count() == 5000
    others = spark.range(10_000, 60_000).select(F.concat(F.lit("TXN"), "id").alias("id"))
    assert maybe_in(others, F.col("id"), bloom).count() < 50_000 * 0.05
    empty = bloom_of(ids.limit(0), F.col("id"), 0)
    assert maybe_in(ids, F.col("id"), empty).count() == 0
    assert bloom.words.count() <= (1 << bloom.size) >> 6


def test_stored_ids_are_filtered_before_they_are_shuffled(spark, warehouse, raw):
    run_etl(warehouse, raw(*[{"transaction_id": f"T{i}"} for i in range(3000)]))
    warehouse.write_months(warehouse.transactions().limit(5).drop("sales_month"), 9)
    source = warehouse.written(9)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = replaced(warehouse.located(warehouse.state()), source, 5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Going down from the join of ids, the stored side's exchange has both filters beneath it.
    stored = plan[: plan.index("run=1") if "run=1" in plan else plan.rindex("FileScan")]
    exchange = stored.index("Exchange hashpartitioning")
    assert stored.count("BroadcastHashJoin") == 2 and stored.index("BroadcastHashJoin") > exchange


def test_recreating_reads_the_landing_folder_anew(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    landing = write(tmp_path, line(transaction_id="A"), line(transaction_id="B"), name="a.csv")
    assert merge_new_files(spark, Warehouse(spark, root), landing).rows_processed == 2
    anew = Warehouse(spark, root, recreate=True)
    write(tmp_path, line(transaction_id="C"), name="b.csv")
    merge_new_files(spark, anew, landing)
    assert rows_of(anew.transactions(), "transaction_id") == [("A",), ("B",), ("C",)]


def test_loads_are_numbered_without_a_clock(spark, tmp_path, monkeypatch):
    """A load that was staged but not merged keeps its place whatever the time is."""
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for day, lost in ((1, False), (2, True), (3, False), (4, False)):
        landing = write(tmp_path, line(transaction_id=f"T{day}"), line(transaction_id="A", items_count=str(day)), name=f"{day}.csv")
        with monkeypatch.context() as m:
            m.setattr("time.time_ns", lambda: (10 - day) * 3_600_000_000_000)
            m.setattr("time.time", lambda: (10 - day) * 3600.0)
            if lost:
                m.setattr(new_files, "run_etl", lambda *_: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    merge_new_files(spark, warehouse, landing)
            else:
                merge_new_files(spark, warehouse, landing)
    assert rows_of(warehouse.transactions(), "transaction_id") == [("A",), ("T1",), ("T2",), ("T3",), ("T4",)]
    assert {r["items_count"] for r in warehouse.transactions().filter("transaction_id = 'A'").collect()} == {4}
    assert sorted(warehouse.names_in("staging"), key=len)[:4] == [f"load={i}" for i in range(1, 5)]


def test_a_failed_run_is_audited_and_its_number_is_not_used_again(warehouse, raw, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(etl, "check_keys", lambda *_: (_ for _ in ()).throw(etl.CheckFailed("bad")))
        with pytest.raises(etl.CheckFailed):
            run_etl(warehouse, batch(raw, "A"))
    assert run_etl(warehouse, batch(raw, "A")).run == 2
    assert warehouse.transactions().count() == 1
