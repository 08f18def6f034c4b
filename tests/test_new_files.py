"""The landing folder: each file is read once, and a failed merge is caught up."""

import pytest
from conftest import rows_of
from test_csv_load import line, write

from tillworks.plans.summary import load_daily_summary
from tillworks.sources.warehouse import Warehouse
from tillworks.streaming.new_files import merge_new_files, rejects, replay, staged_since


def test_new_files_are_merged_once(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landing = write(tmp_path, line(transaction_id="A"), line(transaction_id="B", items_count="x"), name="day1.csv")
    assert merge_new_files(spark, warehouse, landing).rows_processed == 1
    assert rows_of(staged_since(spark, f"{warehouse.root}/staging", 0)[1], "reject_reason") == [("not a int: items_count",)]
    assert merge_new_files(spark, warehouse, landing) is None

    write(tmp_path, line(transaction_id="A", items_count="8"), line(transaction_id="C"), name="day2.csv")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_new_files(spark, warehouse, landing)
    assert rows_of(warehouse.transactions(), "transaction_id", "items_count") == [("A", 3)]

    load_daily_summary(warehouse)  # takes a run number of its own
    write(tmp_path, line(transaction_id="D"), name="day3.csv")
    assert merge_new_files(spark, warehouse, landing).rows_processed == 3
    assert rows_of(warehouse.transactions(), "transaction_id", "items_count") == [("A", 8), ("C", 3), ("D", 3)]


def test_empty_landing_folder(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    (tmp_path / "landing").mkdir()
    assert merge_new_files(spark, warehouse, str(tmp_path / "landing")) is None
    assert warehouse.state().run == 0


@pytest.mark.parametrize("lost", [(), (2,), (2, 3)])
def test_a_failed_run_changes_no_answer(spark, tmp_path, monkeypatch, lost):
    """The latest delivery wins, whether its run went through at once or was caught up."""
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for day, items, hour in ((1, 1, "10"), (2, 9, "11"), (3, 4, "09"), (4, 7, "12")):
        rows = [line(transaction_id="A", items_count=str(items), transaction_date=f"2024-01-01 {hour}:00:00")] if day < 4 else [line(transaction_id="B", items_count="7")]
        landing = write(tmp_path, *rows, name=f"day{day}.csv")
        with monkeypatch.context() as m:
            if day in lost:
                m.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    merge_new_files(spark, warehouse, landing)
            else:
                merge_new_files(spark, warehouse, landing)
    assert rows_of(warehouse.transactions(), "transaction_id", "items_count") == [("A", 4), ("B", 7)]


def test_a_repaired_line_is_taken_in_once(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    assert rejects(spark, warehouse).count() == 0
    bad = [line(transaction_id="B", items_count="x"), line(transaction_id="C", items_count="y", cashier_id='"a, b"'), "D,too,few"]
    landing = write(tmp_path, line(transaction_id="A"), *bad, name="day1.csv")
    merge_new_files(spark, warehouse, landing)
    found = {r["line"]: r for r in rejects(spark, warehouse).collect()}
    assert set(found) == set(bad) and found[bad[2]]["reject_reason"].startswith("malformed line")

    # B is mended, C is not, nobody looks at D; an unknown id and a null line do nothing.
    repaired = [(found[bad[0]]["reject_id"], bad[0].replace(",x,", ",8,")), (found[bad[1]]["reject_id"], bad[1].replace(",y,", ",z,")), ("no such id", line(transaction_id="E")), (found[bad[2]]["reject_id"], None)]
    mended = spark.createDataFrame(repaired, "reject_id string, line string")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            replay(spark, warehouse, mended)
    assert replay(spark, warehouse, mended).rows_processed == 1  # caught up, not staged again
    assert replay(spark, warehouse, mended) is None
    assert merge_new_files(spark, warehouse, landing) is None
    assert rows_of(warehouse.transactions(), "transaction_id", "items_count") == [("A", 3), ("B", 8)]
    left = {r["line"]: (r["load"], r["reject_reason"]) for r in rejects(spark, warehouse).collect()}
    assert set(left) == {repaired[1][1], bad[2]} and left[repaired[1][1]] == (2, "not a int: items_count")

    again = rejects(spark, warehouse).filter("load = 2").selectExpr("reject_id", "replace(line, ',z,', ',5,') AS line")
    assert replay(spark, warehouse, again).rows_processed == 1
    assert rows_of(warehouse.transactions(), "transaction_id", "items_count", "cashier_id") == [("A", 3, "CASH1"), ("B", 8, "CASH1"), ("C", 5, "a, b")]
    recreated = Warehouse(spark, warehouse.root, recreate=True)
    assert rejects(spark, recreated).count() == 0
    merge_new_files(spark, recreated, landing)
    assert rejects(spark, recreated).count() == 3
