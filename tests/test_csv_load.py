"""CSV loading: quotes, blanks, bad values, short lines, line ends, encodings."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of

from tillworks.schema import RAW_COLUMNS
from tillworks.sources.csv_load import read_csv, read_staging, stage_csv

HEADER = ",".join(RAW_COLUMNS)


def write(tmp_path, *lines, end="\n", name="a.csv"):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((end.join([HEADER, *lines]) + end).encode("utf-8"))
    return str(folder)


def line(**changes):
    values = {
        "transaction_id": "T1", "store_name": "Alpha", "city": "Lagos", "transaction_date": "2024-01-02 03:04:05",
        "cashier_id": "CASH1", "items_count": "3", "total_amount_ngn": "12.50", "payment_method": "Cash",
        "discount_applied": "True", "loyalty_points_earned": "7", "receipt_number": "R1",
    }
    return ",".join((values | changes).values())


def one(df, *columns):
    rows = df.select(*columns).collect()
    assert len(rows) == 1
    return tuple(rows[0])


def test_types_and_values(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, line()))
    assert one(df, *RAW_COLUMNS, "reject_reason") == (
        "T1", "Alpha", "Lagos", dt.datetime(2024, 1, 2, 3, 4, 5), "CASH1", 3, Decimal("12.50"), "Cash", "True", 7, "R1", None,
    )


def test_empty_fields_are_null(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, "," * 10))
    assert one(df, *RAW_COLUMNS, "reject_reason") == (None,) * 12


def test_quotes_and_blanks(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, line(store_name='"A, ""B"" C"', city='""', cashier_id=" c1 ", receipt_number="Ọ̀yọ́")))
    assert one(df, "store_name", "city", "cashier_id", "receipt_number", "reject_reason") == (
        'A, "B" C', None, " c1 ", "Ọ̀yọ́", None,
    )


def test_amounts_round_half_up(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, line(total_amount_ngn="1.005")))
    assert one(df, "total_amount_ngn") == (Decimal("1.01"),)


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (line(items_count="3.7"), "not a int: items_count"),
        (line(loyalty_points_earned="x"), "not a int: loyalty_points_earned"),
        (line(total_amount_ngn="99999999999.00"), "not a decimal(12,2): total_amount_ngn"),
        (line(transaction_date="2024-13-01"), "not a timestamp_ntz: transaction_date"),
        (line(cashier_id="c" * 51), "too long: cashier_id"),
        ("T1,Alpha", "malformed line"),
        (line() + ",extra", "malformed line"),
    ],
)
def test_reject_reasons(spark, tmp_path, text, reason):
    assert one(read_csv(spark, write(tmp_path, text)), "reject_reason") == (reason,)


@pytest.mark.parametrize("multi_line", [False, True])
def test_carriage_returns_are_not_data(spark, tmp_path, multi_line):
    folder = write(tmp_path, line(receipt_number="R1"), line(receipt_number="R2"), end="\r\n")
    df = read_csv(spark, folder, multi_line=multi_line)
    assert rows_of(df, "receipt_number", "reject_reason") == [("R1", None), ("R2", None)]


def test_line_breaks_in_quotes(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, line(store_name='"A\nB"')), multi_line=True)
    assert one(df, "store_name", "reject_reason") == ("A\nB", None)


def test_timestamp_pattern_keeps_wall_time(spark, tmp_path):
    folder = write(tmp_path, line(transaction_date="31/03/2024 02:30"), line(transaction_date="oops"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there
    try:
        df = read_csv(spark, folder, timestamp_pattern="dd/MM/yyyy HH:mm")
        got = rows_of(df, "transaction_date", "reject_reason")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(None, "not a timestamp_ntz: transaction_date"), (dt.datetime(2024, 3, 31, 2, 30), None)]


def test_every_file_has_a_header(spark, tmp_path):
    write(tmp_path, line(receipt_number="R1"), name="a.csv")
    folder = write(tmp_path, line(receipt_number="R2"), name="b.csv")
    assert rows_of(read_csv(spark, folder), "receipt_number") == [("R1",), ("R2",)]


def test_staging_splits_and_is_recreated(spark, tmp_path):
    staging = str(tmp_path / "staging")
    stage_csv(spark, write(tmp_path, line(receipt_number="OLD")), staging)
    good, bad = stage_csv(spark, write(tmp_path, line(), line(items_count="x", receipt_number="R2")), staging)
    assert good.columns == RAW_COLUMNS
    assert rows_of(good, "receipt_number") == [("R1",)]
    assert rows_of(bad, "receipt_number", "reject_reason") == [("R2", "not a int: items_count")]
    good, bad = stage_csv(spark, write(tmp_path, line()), staging)
    assert (good.count(), read_staging(spark, staging)[1].count()) == (1, 0)
