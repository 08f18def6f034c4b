"""Reports against plain Python on random facts, and their edge cases."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from conftest import money, rows_of, ts

from tillworks.plans import initial_load, kpi, profile, summary, targets, trends

STORES = [(1, "Alpha", "Lagos"), (2, "Alpha", "Abuja"), (3, "Beta", "Lagos"), (4, "Gamma", None), (5, "beta ", "Kano")]
METHODS = [(1, "Cash"), (2, "Card")]


def random_rows(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.datetime(2023, 11, 1) + dt.timedelta(days=rng.randrange(90), hours=rng.randrange(24))
        rows.append(
            {
                "transaction_id": f"T{i}",
                # One store holds a third of the rows.
                "store_id": 1 if rng.random() < 0.33 else rng.choice([None, 1, 2, 3, 4, 5]),
                "cashier_id": rng.choice(["C1", "c1 ", " C1", "C2", "c3"]),
                "transaction_date": str(day),
                "items_count": rng.choice([None, 1, 2, 3]),
                "total_amount_ngn": rng.randrange(1, 10**6) / 100,
                "payment_id": rng.choice([None, 1, 2]),
                "discount_applied": rng.choice(["TRUE", "True", "1", "FALSE", "False", "0", "maybe", None]),
                "loyalty_points_earned": rng.choice([None, 0, 5, 7]),
                "receipt_number": f"R{i % 300}",
            }
        )
    return rows


@pytest.fixture(scope="module")
def rows():
    return random_rows()


@pytest.fixture(scope="module")
def data(facts, stores, methods, rows):
    return facts(*rows).cache(), stores(*STORES), methods(*METHODS)


NAME = {i: n.rstrip().upper() for i, n, _ in STORES}
CITY = {i: c for i, _, c in STORES}
SHOWN = {"ALPHA": "Alpha", "BETA": "Beta", "GAMMA": "Gamma"}


def total(rows):
    return sum((money(r["total_amount_ngn"]) for r in rows), Decimal(0))


def grouped(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def test_revenue_by_city_and_store(data, rows):
    facts, stores, _ = data
    placed = [r for r in rows if r["store_id"]]
    want = sorted(((c, total(g)) for c, g in grouped(placed, lambda r: CITY[r["store_id"]]).items()), key=repr)
    assert rows_of(kpi.revenue_by_city(facts, stores)) == want
    want = sorted((SHOWN[n], total(g)) for n, g in grouped(placed, lambda r: NAME[r["store_id"]]).items())
    assert rows_of(kpi.revenue_per_store(facts, stores)) == want


def test_shares_add_up(data, rows):
    facts, stores, _ = data
    shares = kpi.store_revenue_share(facts, stores).collect()
    everything = total([r for r in rows if r["store_id"]])
    for r in shares:
        assert abs(r["revenue_percentage"] - 100 * r["total_revenue"] / everything) <= Decimal("0.005001")
    assert abs(sum(r["revenue_percentage"] for r in shares) - 100) <= Decimal("0.01") * len(shares)


def test_city_rank_as_written_is_one(data):
    facts, stores, _ = data
    assert {r["revenue_rank"] for r in kpi.city_revenue_rank(facts, stores).collect()} == {1}


def test_top_stores_per_city(facts, stores):
    dims = stores(*[(i, f"S{i}", "Lagos" if i <= 7 else "Abuja") for i in range(1, 10)])
    amounts = {1: 10, 2: 70, 3: 70, 4: 30, 5: 40, 6: 50, 7: 60, 8: 5, 9: 6}
    df = facts(*[{"transaction_id": str(i), "store_id": i, "total_amount_ngn": a} for i, a in amounts.items()])
    got = [(r["city"], r["store_name"], r["revenue_rank"]) for r in kpi.top_stores_per_city(df, dims).collect()]
    assert got == [
        ("Abuja", "S9", 1), ("Abuja", "S8", 2),
        ("Lagos", "S2", 1), ("Lagos", "S3", 1), ("Lagos", "S7", 3), ("Lagos", "S6", 4), ("Lagos", "S5", 5),
    ]


def test_overview(data, rows):
    got = kpi.revenue_overview(data[0]).first().asDict()
    flags = Counter((r["discount_applied"] or "").upper() for r in rows)
    yes, no = flags["TRUE"] + flags["1"], flags["FALSE"] + flags["0"]
    assert got["total_transactions"] == len(rows)
    assert got["total_revenue"] == total(rows)
    assert got["avg_transaction_value"] == (total(rows) / len(rows)).quantize(Decimal("0.000001"))
    assert (got["transactions_with_discount"], got["transactions_without_discount"]) == (yes, no)
    assert yes + no + flags["MAYBE"] + flags[""] == len(rows)
    assert got["total_loyalty_points"] == sum(r["loyalty_points_earned"] or 0 for r in rows)


def test_overview_of_nothing(facts):
    assert tuple(kpi.revenue_overview(facts()).first()) == (0, None, None, None, None, None)


def test_cashiers(data, rows):
    groups = grouped(rows, lambda r: r["cashier_id"].rstrip().upper())
    shown = {k: min(r["cashier_id"] for r in g) for k, g in groups.items()}
    want = sorted(((shown[k], len(g), total(g)) for k, g in groups.items()), key=lambda r: -r[2])
    got = kpi.cashier_rank(data[0]).collect()
    assert [(r["cashier_id"], r["transactions_count"], r["total_revenue"], r["sales_rank"]) for r in got] == [
        (*w, i + 1) for i, w in enumerate(want)
    ]
    best = kpi.best_cashiers(data[0]).collect()
    assert [(r["cashier_id"], r["TotalSales"]) for r in best] == [(w[0], w[2]) for w in want]
    assert kpi.cashier_count(data[0]).first()[0] == len(groups)


def test_payment_reports(data, rows):
    facts, stores, methods = data
    paid = grouped([r for r in rows if r["payment_id"]], lambda r: dict(METHODS)[r["payment_id"]])
    assert rows_of(kpi.payment_revenue(facts, methods)) == sorted((m, len(g), total(g)) for m, g in paid.items())
    discounts = {r["payment_method"]: r for r in kpi.payment_discounts(facts, methods).collect()}
    for m, g in paid.items():
        flags = Counter((r["discount_applied"] or "").upper() for r in g)
        assert discounts[m]["discounted_transactions"] == flags["TRUE"] + flags["1"]
        assert discounts[m]["full_price_transactions"] == flags["FALSE"] + flags["0"]
    both = grouped(
        [r for r in rows if r["payment_id"] and r["store_id"]],
        lambda r: (SHOWN[NAME[r["store_id"]]], dict(METHODS)[r["payment_id"]]),
    )
    assert rows_of(kpi.payment_by_store(facts, stores, methods)) == sorted(
        (*k, len(g), total(g)) for k, g in both.items()
    )


def test_counts(data, stores):
    assert kpi.store_count(data[1]).first()[0] == 3
    assert kpi.city_count(data[1]).first()[0] == 3
    assert kpi.receipt_count(data[0]).first()[0] == 300


def test_loyalty_average_is_cut_off(facts):
    df = facts(*[{"transaction_id": str(p), "loyalty_points_earned": p} for p in (4, 5, None)])
    assert tuple(kpi.loyalty_overview(df).first()) == (9, 4)


def test_top_days_break_ties_by_date(facts):
    df = facts(*[{"transaction_id": str(i), "transaction_date": f"2024-01-{i:02d} 10:00:00"} for i in range(1, 15)])
    got = [r["report_date"].day for r in kpi.top_revenue_days(df).collect()]
    assert got == list(range(1, 11))


def test_all_trends_have_the_same_total(data, rows):
    facts = data[0]
    for df, column in [
        (trends.revenue_by_timestamp(facts), "DailyTotal"),
        (trends.revenue_daily(facts), "DailyTotal"),
        (trends.revenue_weekly(facts), "WeeklyTotal"),
        (trends.revenue_monthly(facts), "MonthlyTotal"),
        (trends.revenue_quarterly(facts), "QuarterlyTotal"),
        (trends.revenue_yearly(facts), "YearlyTotal"),
        (trends.daily_revenue(facts), "daily_revenue"),
    ]:
        assert sum(r[column] for r in df.collect()) == total(rows)


def test_months_are_named(data):
    got = trends.revenue_monthly(data[0]).collect()
    assert [(r["Month"], r["MonthNumber"], r["Year"]) for r in got] == [
        ("November", 11, 2023), ("December", 12, 2023), ("January", 1, 2024),
    ]


def test_one_year_of_months(data, rows):
    january = [r for r in rows if r["transaction_date"].startswith("2024-01")]
    assert rows_of(trends.monthly_revenue(data[0], 2024)) == [(1, total(january))]


def test_cashier_targets_leave_out_the_exact_amount(facts):
    df = facts(
        *[
            {"transaction_id": c, "cashier_id": c, "total_amount_ngn": a, "transaction_date": "2024-01-05 00:00:00"}
            for c, a in [("a", 99.99), ("b", 100), ("c", 100.01)]
        ],
        {"transaction_id": "d", "cashier_id": " A ", "total_amount_ngn": 0.01, "transaction_date": "2024-02-01 00:00:00"},
    )
    limit = Decimal("100")
    assert rows_of(targets.cashiers_below_target(df, "2024-01", limit), "cashier_id") == [("A",)]
    assert rows_of(targets.cashiers_above_target(df, "2024-01", limit), "cashier_id") == [("C",)]


def test_store_targets(facts, stores):
    df = facts(
        *[{"transaction_id": str(i), "store_id": i, "total_amount_ngn": a} for i, a in enumerate([50, 150, 10**6 + 100], 1)]
    )
    dims = stores((1, "A", None), (2, "B", None), (3, "C", None))
    got = rows_of(targets.store_target_all(df, dims, "2024-01", Decimal(100)), "store_name", "PerformanceStatus")
    assert got == [("A", targets.BELOW), ("B", targets.MEETS), ("C", targets.BEYOND)]
    assert rows_of(targets.store_target_one(df, dims, "b ", "2024-01", Decimal(100)), "store_name") == [("B",)]
    assert targets.store_target_one(df, dims, "A", "2024-01", Decimal(100)).count() == 0


def test_daily_summary(data, rows):
    facts, stores, _ = data
    got = {r["report_date"]: r for r in summary.daily_summary(facts, stores).collect()}
    days = grouped(rows, lambda r: ts(r["transaction_date"]).date())
    assert set(got) == set(days)

    def leader(names):
        counts = Counter(names)
        return min(counts, key=lambda n: (-counts[n], n is not None, n or "")) if counts else None

    for day, g in days.items():
        placed = [r["store_id"] for r in g if r["store_id"]]
        assert got[day]["total_transactions"] == len(g)
        assert got[day]["total_revenue"] == total(g)
        assert got[day]["top_city"] == leader(CITY[i] for i in placed)
        assert got[day]["top_store"] == leader(SHOWN[NAME[i]] for i in placed)


def test_daily_summary_ties_and_days_without_store(facts, stores):
    df = facts(
        {"transaction_id": "1", "store_id": 2}, {"transaction_id": "2", "store_id": 1},
        {"transaction_id": "3", "store_id": None, "transaction_date": "2024-01-02 00:00:00"},
    )
    got = rows_of(summary.daily_summary(df, stores((1, "B", "Y"), (2, "A", "X"))), "total_transactions", "top_city", "top_store")
    assert got == [(1, None, None), (2, "X", "A")]


def test_profile(raw):
    df = raw(
        {"transaction_date": "2024-01-01 07:59:59", "receipt_number": "R1", "total_amount_ngn": 200000, "items_count": 200},
        {"transaction_date": "2024-01-01 08:00:00", "receipt_number": "r1 ", "total_amount_ngn": 200000.01, "items_count": None},
        {"transaction_date": "2024-01-01 22:59:59", "receipt_number": None, "total_amount_ngn": None, "items_count": 201},
        {"transaction_date": None, "receipt_number": None, "total_amount_ngn": 1, "items_count": 1},
        {"transaction_date": None, "receipt_number": "R4", "total_amount_ngn": 1, "items_count": 1},
        {"transaction_date": "2024-01-01 23:00:00", "receipt_number": "R5", "total_amount_ngn": 1, "items_count": 1},
    )
    assert rows_of(profile.dup_receipts(df)) == sorted([("R1", 2), (None, 2)], key=repr)
    assert rows_of(profile.dup_stores(df)) == [("Alpha", 6)]
    assert rows_of(profile.dup_cities(df)) == [("Lagos", 6)]
    assert rows_of(profile.dup_timestamps(df)) == [(None, 2)]
    assert tuple(profile.null_profile(df).first()) == (None, None, None, 2, None, 1, 1)
    assert profile.outliers(df).count() == 2
    assert sorted(r["transaction_hour"] for r in profile.off_hours(df).collect()) == [7, 23]
    assert profile.future_dates(df, "2024-01-01 22:59:59").count() == 1
    assert profile.future_dates(df).count() == 0


def test_initial_load_drops_incomplete_rows_and_keeps_repeats(raw):
    df = raw(
        {"transaction_id": "1"}, {"transaction_id": "1"}, {"transaction_id": "2", "store_name": "ALPHA"},
        {"transaction_id": "3", "city": None}, {"transaction_id": "4", "payment_method": None},
    )
    stores, methods = initial_load.stores_initial(df), initial_load.payment_methods_initial(df)
    assert rows_of(stores) == [(1, "ALPHA", "Lagos")]
    assert rows_of(methods) == [(1, "Cash")]
    got = initial_load.transactions_initial(df, stores, methods)
    assert rows_of(got, "transaction_id") == [("1",), ("1",), ("2",)]
