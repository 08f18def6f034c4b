import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillworks import schema as S  # noqa: E402
from tillworks.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def money(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


RAW_DEFAULTS = {
    "transaction_id": "T1",
    "store_name": "Alpha",
    "city": "Lagos",
    "transaction_date": "2024-01-01 10:00:00",
    "cashier_id": "CASH1",
    "items_count": 1,
    "total_amount_ngn": 100,
    "payment_method": "Cash",
    "discount_applied": "TRUE",
    "loyalty_points_earned": 10,
    "receipt_number": "R1",
}
FACT_DEFAULTS = {
    "transaction_id": "T1",
    "store_id": 1,
    "cashier_id": "CASH1",
    "transaction_date": "2024-01-01 10:00:00",
    "items_count": 1,
    "total_amount_ngn": 100,
    "payment_id": 1,
    "discount_applied": "TRUE",
    "loyalty_points_earned": 10,
    "receipt_number": "R1",
}


def _frame(spark, schema, defaults, rows):
    filled = []
    for row in rows:
        unknown = set(row) - set(defaults)
        assert not unknown, unknown
        row = defaults | row
        row["transaction_date"] = ts(row["transaction_date"])
        row["total_amount_ngn"] = money(row["total_amount_ngn"])
        filled.append(tuple(row[f] for f in schema.fieldNames()))
    return spark.createDataFrame(filled, schema)


@pytest.fixture(scope="session")
def raw(spark):
    """Raw rows from partial dictionaries."""
    return lambda *rows: _frame(spark, S.RAW, RAW_DEFAULTS, rows)


@pytest.fixture(scope="session")
def facts(spark):
    return lambda *rows: _frame(spark, S.TRANSACTIONS, FACT_DEFAULTS, rows)


@pytest.fixture(scope="session")
def stores(spark):
    return lambda *rows: spark.createDataFrame(list(rows), S.STORES)


@pytest.fixture(scope="session")
def methods(spark):
    return lambda *rows: spark.createDataFrame(list(rows), S.PAYMENT_METHODS)


def rows_of(df, *columns):
    """Rows as tuples in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
