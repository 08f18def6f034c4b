"""The same results as plain SQL over the order tables, for the side-by-side check.

One WITH list builds the raw rows, the dimensions and the facts; each query adds its SELECT.
"""

from tillworks.plans.catalog import (
    AS_OF,
    CASHIER_TARGET,
    MONTH,
    SAMPLES,
    STORE,
    STORE_TARGET,
    YEAR,
)
from tillworks.plans.mart import CURRENCY_METHOD, PIECES_METHOD, SECOND_BATCH_FROM

_RAW = """transaction_id, store_name, city, transaction_date, cashier_id, items_count, total_amount_ngn,
    payment_method, discount_applied, loyalty_points_earned, receipt_number"""

_FACT = """transaction_id, store_id, cashier_id, transaction_date, items_count, total_amount_ngn,
    payment_id, discount_applied, loyalty_points_earned, receipt_number"""

_EARLIEST = """PARTITION BY upper(rtrim(transaction_id)) ORDER BY transaction_date NULLS FIRST,
    receipt_number NULLS FIRST, store_name NULLS FIRST, city NULLS FIRST, cashier_id NULLS FIRST,
    items_count NULLS FIRST, total_amount_ngn NULLS FIRST, payment_method NULLS FIRST,
    discount_applied NULLS FIRST, loyalty_points_earned NULLS FIRST"""


def _dedup(rows: str) -> str:
    return f"""SELECT {_RAW} FROM (
        SELECT *, row_number() OVER ({_EARLIEST}) AS rn FROM {rows} WHERE transaction_id IS NOT NULL) z
    WHERE rn = 1"""


def _stores(rows: str, condition: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY store_name, city NULLS FIRST) AS INT) AS store_id,
        store_name, city
    FROM (SELECT min(store_name) AS store_name, min(city) AS city FROM {rows} WHERE {condition}
          GROUP BY upper(rtrim(store_name)), coalesce(upper(rtrim(city)), '')) x"""


def _methods(rows: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY payment_method) AS INT) AS payment_id, payment_method
    FROM (SELECT min(payment_method) AS payment_method FROM {rows} WHERE payment_method IS NOT NULL
          GROUP BY upper(rtrim(payment_method))) x"""


def _resolved(rows: str, stores: str, methods: str, join: str) -> str:
    same_city = "coalesce(s.city, '') = coalesce(d.city, '')" if join == "LEFT" else "s.city = d.city"
    return f"""SELECT d.transaction_id, s.store_id, d.cashier_id, d.transaction_date, d.items_count,
        d.total_amount_ngn, p.payment_id, d.discount_applied, d.loyalty_points_earned, d.receipt_number
    FROM {rows} d
    {join} JOIN {stores} s ON s.store_name = d.store_name AND {same_city}
    {join} JOIN {methods} p ON p.payment_method = d.payment_method"""


_BASE = f"""WITH base AS (
    SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderdate AS od, o.o_totalprice AS tp,
        o.o_orderpriority AS pr, c.c_mktsegment AS seg, n.n_name AS nn, l.q AS q
    FROM orders o
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) l
        ON l.l_orderkey = o.o_orderkey
),
delivered AS (
    SELECT base.*, 0 AS redelivery FROM base
    UNION ALL
    SELECT base.*, 1 AS redelivery FROM base WHERE k % 50 = 7
),
pos_all AS (
    SELECT redelivery,
        CASE WHEN k % 997 = 0 THEN NULL ELSE concat('TXN', CAST(k AS STRING)) END AS transaction_id,
        CASE WHEN k % 89 = 0 THEN NULL ELSE seg END AS store_name,
        CASE WHEN k % 83 = 0 THEN NULL ELSE nn END AS city,
        od + CAST(((k * 7) % 24 + redelivery) * 3600 AS INT) * INTERVAL '1' SECOND AS transaction_date,
        CASE WHEN k % 3 = 0 THEN concat(' cash', CAST(ck % 90 AS STRING), ' ')
             ELSE concat('CASH', CAST(ck % 90 AS STRING)) END AS cashier_id,
        CAST(q AS INT) AS items_count,
        CAST(tp AS DECIMAL(12,2)) AS total_amount_ngn,
        CASE WHEN k % 101 = 0 THEN NULL ELSE pr END AS payment_method,
        CASE k % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'True' WHEN 2 THEN '1'
                   WHEN 3 THEN 'FALSE' WHEN 4 THEN '0' ELSE 'true' END AS discount_applied,
        CAST((k * 37) % 1000 AS INT) AS loyalty_points_earned,
        concat('RCP', CAST(k % 14000 AS STRING)) AS receipt_number
    FROM delivered
),
pos_raw AS (SELECT {_RAW} FROM pos_all),
stores AS ({_stores("pos_raw", "store_name IS NOT NULL")}),
pay AS ({_methods("pos_raw")}),
dedup AS ({_dedup("pos_raw")}),
fact AS ({_resolved("dedup", "stores", "pay", "LEFT")}),
stores_initial AS ({_stores("pos_raw", "store_name IS NOT NULL AND city IS NOT NULL")})"""

_IS_FIRST = f"redelivery = 0 AND transaction_date < TIMESTAMP '{SECOND_BATCH_FROM}'"
_IN_PIECES = f"coalesce(payment_method = '{PIECES_METHOD}' AND items_count IS NOT NULL, false)"
_IN_CURRENCY = f"coalesce(payment_method = '{CURRENCY_METHOD}' AND total_amount_ngn IS NOT NULL, false)"


def _merged(first_stores: str, first_join: str, is_first: str = _IS_FIRST) -> str:
    """The first batch loaded, the second merged into it."""
    return f""",
batch1 AS (SELECT {_RAW} FROM pos_all WHERE {is_first}),
batch2 AS (SELECT {_RAW} FROM pos_all WHERE NOT coalesce({is_first}, false)),
stores1 AS ({_stores("batch1", first_stores)}),
pay1 AS ({_methods("batch1")}),
source1 AS ({_dedup("batch1")}),
fact1 AS ({_resolved("source1", "stores1", "pay1", first_join)}),
found_stores AS ({_stores("batch2", "store_name IS NOT NULL")}),
found_pay AS ({_methods("batch2")}),
stores2 AS (
    SELECT store_id, store_name, city FROM stores1
    UNION ALL
    SELECT CAST((SELECT coalesce(max(store_id), 0) FROM stores1)
                + row_number() OVER (ORDER BY store_name, city NULLS FIRST) AS INT), store_name, city
    FROM found_stores f WHERE NOT EXISTS (
        SELECT 1 FROM stores1 s WHERE s.store_name = f.store_name
            AND coalesce(s.city, '') = coalesce(f.city, ''))
),
pay2 AS (
    SELECT payment_id, payment_method FROM pay1
    UNION ALL
    SELECT CAST((SELECT coalesce(max(payment_id), 0) FROM pay1)
                + row_number() OVER (ORDER BY payment_method) AS INT), payment_method
    FROM found_pay f WHERE NOT EXISTS (SELECT 1 FROM pay1 p WHERE p.payment_method = f.payment_method)
),
source2 AS ({_dedup("batch2")}),
fact2 AS (
    {_resolved("source2", "stores2", "pay2", "LEFT")}
    UNION ALL
    SELECT {_FACT} FROM fact1 WHERE transaction_id NOT IN (SELECT transaction_id FROM source2)
)"""


# Into tables that an initial load has filled, and into tables that the job itself has filled.
_MERGED = _merged("store_name IS NOT NULL AND city IS NOT NULL", "INNER")
_TWO_RUNS = _merged("store_name IS NOT NULL", "LEFT")
# Lines that can be loaded, then the repaired ones.
_REPLAYED = _merged("store_name IS NOT NULL", "LEFT", f"NOT {_IN_PIECES} AND NOT {_IN_CURRENCY}")

_REJECTED = f""",
faulty AS (
    SELECT {_RAW}, {_IN_PIECES} AS in_pieces, {_IN_CURRENCY} AS in_currency FROM pos_raw
    WHERE {_IN_PIECES} OR {_IN_CURRENCY}
),
rejected_lines AS (
    SELECT *, array_to_string([coalesce(transaction_id, ''), coalesce(store_name, ''), coalesce(city, ''),
        coalesce(strftime(transaction_date, '%Y-%m-%d %H:%M:%S'), ''), coalesce(cashier_id, ''),
        coalesce(CAST(items_count AS VARCHAR), '') || CASE WHEN in_pieces THEN ' pcs' ELSE '' END,
        CASE WHEN in_currency THEN 'NGN ' ELSE '' END || coalesce(CAST(total_amount_ngn AS VARCHAR), ''),
        coalesce(payment_method, ''), coalesce(discount_applied, ''),
        coalesce(CAST(loyalty_points_earned AS VARCHAR), ''), coalesce(receipt_number, '')], ',') AS line
    FROM faulty
)"""

_QUARANTINE = f""",
repeated AS (SELECT receipt_number AS r FROM pos_raw WHERE receipt_number IS NOT NULL
             GROUP BY receipt_number HAVING count(*) > 1),
quarantine AS (
    SELECT {_RAW}, 'missing transaction_id' AS reason FROM pos_raw WHERE transaction_id IS NULL
    UNION ALL
    SELECT {_RAW}, 'missing transaction_date' FROM pos_raw WHERE transaction_date IS NULL
    UNION ALL
    SELECT {_RAW}, 'future transaction_date' FROM pos_raw WHERE transaction_date > TIMESTAMP '{AS_OF}'
    UNION ALL
    SELECT {_RAW}, 'repeated receipt_number' FROM pos_raw WHERE receipt_number IN (SELECT r FROM repeated)
)"""

_MONEY = "CAST(sum(total_amount_ngn) AS DECIMAL(38,2))"
_YES = "CAST(sum(CASE WHEN upper(rtrim(discount_applied)) IN ('TRUE','1') THEN 1 ELSE 0 END) AS BIGINT)"
_NO = "CAST(sum(CASE WHEN upper(rtrim(discount_applied)) IN ('FALSE','0') THEN 1 ELSE 0 END) AS BIGINT)"
_POINTS = "CAST(sum(loyalty_points_earned) AS BIGINT)"
_ITEMS = "CAST(sum(items_count) AS BIGINT)"
_BY_STORE = "FROM fact JOIN stores USING (store_id)"
_DAY = "CAST(transaction_date AS DATE)"
_MONTH_ROWS = f"WHERE strftime(transaction_date, '%Y-%m') = '{MONTH}'"


def _nulls(column: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {column} IS NULL THEN 1 END) AS BIGINT) AS {name}"


def _top(column: str, by_store: str = _BY_STORE) -> str:
    return f"""SELECT day, {column} FROM (
        SELECT {_DAY} AS day, {column},
            row_number() OVER (PARTITION BY {_DAY} ORDER BY count(*) DESC, {column} NULLS FIRST) AS rn
        {by_store} GROUP BY 1, 2) x
    WHERE rn = 1"""


def _daily(fact: str, stores: str) -> str:
    by_store = f"FROM {fact} JOIN {stores} USING (store_id)"
    return f"""SELECT d.*, c.city AS top_city, s.store_name AS top_store FROM (
            SELECT {_DAY} AS report_date, count(*) AS total_transactions, {_MONEY} AS total_revenue,
                {_YES} AS transactions_with_discount, {_NO} AS transactions_without_discount,
                {_POINTS} AS total_loyalty_points
            FROM {fact} GROUP BY 1) d
        LEFT JOIN ({_top("city", by_store)}) c ON c.day = d.report_date
        LEFT JOIN ({_top("store_name", by_store)}) s ON s.day = d.report_date"""


def _cashiers(comparison: str) -> str:
    return f"""SELECT upper(trim(cashier_id)) AS cashier_id, '{MONTH}' AS "SalesMonth",
        {_ITEMS} AS "TotalItems", {_MONEY} AS "TotalSales"
    FROM fact {_MONTH_ROWS} GROUP BY 1
    HAVING sum(total_amount_ngn) {comparison} {CASHIER_TARGET}"""


_STORE_TARGETS = f"""SELECT store_name, '{MONTH}' AS "SalesMonth", {_ITEMS} AS "TotalItems",
        {_MONEY} AS "TotalSales",
        CASE WHEN sum(total_amount_ngn) < {STORE_TARGET} THEN 'Below Expectation'
             WHEN sum(total_amount_ngn) BETWEEN {STORE_TARGET} AND {STORE_TARGET} + 999999.99
                 THEN 'Meets Expectation'
             ELSE 'Beyond Expectation' END AS "PerformanceStatus"
    {_BY_STORE} {_MONTH_ROWS} GROUP BY store_name"""


def _per_cashier(columns: str) -> str:
    return f"""SELECT min(cashier_id) AS cashier_id, {columns} FROM fact GROUP BY upper(rtrim(cashier_id))"""


def _average(total: str, count: str) -> str:
    return f"CAST(CAST({total} AS DOUBLE) / {count} AS DECIMAL(38,6))"


def _week() -> str:
    ts = "transaction_date"
    return f"CAST((dayofyear({ts}) + dayofweek(date_trunc('year', {ts})) - 1) // 7 + 1 AS INT)"


_SELECTS = {
    "csv_load": f"SELECT {_RAW} FROM pos_raw",
    "raw_scan": f"SELECT {_RAW} FROM pos_raw",
    "dup_receipts": """SELECT min(receipt_number) AS receipt_number, count(*) AS duplicate_count
        FROM pos_raw GROUP BY upper(rtrim(receipt_number)) HAVING count(*) > 1""",
    "dup_stores": """SELECT min(store_name) AS store_name, count(*) AS duplicate_stores
        FROM pos_raw GROUP BY upper(rtrim(store_name)) HAVING count(*) > 1""",
    "dup_cities": """SELECT min(city) AS city, count(*) AS duplicate_city
        FROM pos_raw GROUP BY upper(rtrim(city)) HAVING count(*) > 1""",
    "null_profile": "SELECT "
    + ", ".join(
        [
            _nulls("transaction_id", "null_transaction_id"),
            _nulls("store_name", "null_store_name"),
            _nulls("city", "null_city"),
            _nulls("transaction_date", "null_txn_date"),
            _nulls("cashier_id", "null_cashier"),
            _nulls("items_count", "null_items"),
            _nulls("total_amount_ngn", "null_amount"),
        ]
    )
    + " FROM pos_raw",
    "outliers": f"SELECT {_RAW} FROM pos_raw WHERE total_amount_ngn > 200000 OR items_count > 200",
    "future_dates": f"SELECT {_RAW} FROM pos_raw WHERE transaction_date > TIMESTAMP '{AS_OF}'",
    "dup_timestamps": """SELECT transaction_date, count(*) AS duplicate_count
        FROM pos_raw GROUP BY transaction_date HAVING count(*) > 1""",
    "off_hours": """SELECT transaction_id, store_name, cashier_id, transaction_date,
            CAST(hour(transaction_date) AS INT) AS transaction_hour
        FROM pos_raw WHERE hour(transaction_date) NOT BETWEEN 8 AND 22""",
    "stores_initial": "SELECT store_id, store_name, city FROM stores_initial",
    "payment_methods_initial": "SELECT payment_id, payment_method FROM pay",
    "transactions_initial": _resolved("pos_raw", "stores_initial", "pay", "INNER"),
    "dedup_transactions": f"SELECT {_RAW} FROM dedup",
    "run_etl": f"SELECT {_FACT} FROM fact",
    "store_count": 'SELECT count(DISTINCT upper(rtrim(store_name))) AS "Store_Count" FROM stores',
    "city_count": 'SELECT count(DISTINCT upper(rtrim(city))) AS "City_count" FROM stores',
    "cashier_count": 'SELECT count(DISTINCT upper(rtrim(cashier_id))) AS "Cashier_Count" FROM fact',
    "receipt_count": 'SELECT count(DISTINCT upper(rtrim(receipt_number))) AS "ReceiptCount" FROM fact',
    "total_items": f'SELECT {_ITEMS} AS "Total_Items_Count" FROM fact',
    "best_cashiers": _per_cashier(f'{_ITEMS} AS "TotalItems", {_MONEY} AS "TotalSales"'),
    "revenue_overview": f"""SELECT count(*) AS total_transactions, {_MONEY} AS total_revenue,
            {_average("sum(total_amount_ngn)", "count(*)")} AS avg_transaction_value,
            {_YES} AS transactions_with_discount, {_NO} AS transactions_without_discount,
            {_POINTS} AS total_loyalty_points FROM fact""",
    "revenue_by_city": f"SELECT city, {_MONEY} AS total_revenue {_BY_STORE} GROUP BY city",
    "city_revenue_rank": f"""SELECT city, total_revenue, CAST(revenue_rank AS INT) AS revenue_rank FROM (
            SELECT city, {_MONEY} AS total_revenue,
                rank() OVER (PARTITION BY city ORDER BY sum(total_amount_ngn) DESC) AS revenue_rank
            {_BY_STORE} GROUP BY city) x
        WHERE revenue_rank <= 5""",
    "top_stores_per_city": f"""SELECT city, store_name, total_revenue,
            CAST(revenue_rank AS INT) AS revenue_rank FROM (
            SELECT city, store_name, {_MONEY} AS total_revenue,
                rank() OVER (PARTITION BY city ORDER BY sum(total_amount_ngn) DESC) AS revenue_rank
            {_BY_STORE} GROUP BY city, store_name) x
        WHERE revenue_rank <= 5""",
    "store_revenue_share": f"""SELECT store_name, total_revenue,
            CAST(round(CAST(CAST(100 * total_revenue AS DOUBLE) / sum(total_revenue) OVER ()
                 AS DECIMAL(38,6)), 2) AS DECIMAL(18,2)) AS revenue_percentage
        FROM (SELECT store_name, {_MONEY} AS total_revenue {_BY_STORE} GROUP BY store_name) x""",
    "cashier_rank": f"""SELECT cashier_id, transactions_count, total_revenue,
            {_average("total_revenue", "transactions_count")} AS avg_ticket_value,
            rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS sales_rank
        FROM ({_per_cashier(f"count(*) AS transactions_count, {_MONEY} AS total_revenue")}) x""",
    "top_revenue_days": f"""SELECT {_DAY} AS report_date, {_MONEY} AS daily_revenue FROM fact
        GROUP BY 1 ORDER BY daily_revenue DESC, report_date LIMIT 10""",
    "payment_revenue": f"""SELECT payment_method, count(*) AS transaction_count, {_MONEY} AS total_revenue
        FROM fact JOIN pay USING (payment_id) GROUP BY payment_method""",
    "payment_discounts": f"""SELECT payment_method, count(*) AS transaction_count,
            {_MONEY} AS total_revenue, {_YES} AS discounted_transactions, {_NO} AS full_price_transactions
        FROM fact JOIN pay USING (payment_id) GROUP BY payment_method""",
    "payment_by_store": f"""SELECT store_name, payment_method, count(transaction_id) AS total_transactions,
            {_MONEY} AS total_sales_amount
        {_BY_STORE} JOIN pay USING (payment_id) GROUP BY store_name, payment_method""",
    "loyalty_overview": f"""SELECT {_POINTS} AS total_loyalty_points,
            CAST(sum(loyalty_points_earned) // count(loyalty_points_earned) AS BIGINT)
                AS avg_points_per_transaction FROM fact""",
    "revenue_per_store": f"SELECT store_name, {_MONEY} AS total_revenue {_BY_STORE} GROUP BY store_name",
    "cashiers_below_target": _cashiers("<"),
    "cashiers_above_target": _cashiers(">"),
    "store_target_all": _STORE_TARGETS,
    "store_target_one": f"""SELECT * FROM ({_STORE_TARGETS}) x
        WHERE store_name = '{STORE}' AND "TotalSales" > {STORE_TARGET}""",
    "revenue_by_timestamp": f'SELECT transaction_date, {_MONEY} AS "DailyTotal" FROM fact GROUP BY 1',
    "revenue_daily": f'SELECT {_DAY} AS transaction_date_only, {_MONEY} AS "DailyTotal" FROM fact GROUP BY 1',
    "revenue_weekly": f"""SELECT {_week()} AS "WeekNumber", CAST(year(transaction_date) AS INT) AS "Year",
            {_MONEY} AS "WeeklyTotal" FROM fact GROUP BY 1, 2""",
    "revenue_monthly": f"""SELECT monthname(transaction_date) AS "Month",
            CAST(month(transaction_date) AS INT) AS "MonthNumber",
            CAST(year(transaction_date) AS INT) AS "Year", {_MONEY} AS "MonthlyTotal"
        FROM fact GROUP BY 1, 2, 3""",
    "revenue_quarterly": f"""SELECT CAST(year(transaction_date) AS INT) AS "Year",
            CAST(quarter(transaction_date) AS INT) AS "Quarter", {_MONEY} AS "QuarterlyTotal"
        FROM fact GROUP BY 1, 2""",
    "revenue_yearly": f"""SELECT CAST(year(transaction_date) AS INT) AS "Year", {_MONEY} AS "YearlyTotal"
        FROM fact GROUP BY 1""",
    "monthly_revenue_for_year": f"""SELECT CAST(month(transaction_date) AS INT) AS "MonthNumber",
            {_MONEY} AS "TotalRevenue" FROM fact WHERE year(transaction_date) = {YEAR} GROUP BY 1""",
    "daily_revenue": f"SELECT {_DAY} AS report_date, {_MONEY} AS daily_revenue FROM fact GROUP BY 1",
    "daily_summary": _daily("fact", "stores"),
    "daily_summary_basic": f"""SELECT {_DAY} AS report_date, count(*) AS total_transactions,
            {_MONEY} AS total_revenue FROM fact GROUP BY 1""",
    "pk_violations": f"""SELECT upper(rtrim(transaction_id)) AS transaction_id, count(*) AS row_count
        FROM ({_resolved("pos_raw", "stores_initial", "pay", "INNER")}) x
        GROUP BY 1 HAVING upper(rtrim(transaction_id)) IS NULL OR count(*) > 1""",
    "fk_orphans": """SELECT 'store_id' AS key_column, store_id AS key_value, count(*) AS row_count FROM fact
        WHERE store_id IS NOT NULL AND store_id NOT IN (SELECT store_id FROM stores_initial) GROUP BY 2
        UNION ALL
        SELECT 'payment_id', payment_id, count(*) FROM fact
        WHERE payment_id IS NOT NULL AND payment_id NOT IN (SELECT payment_id FROM pay) GROUP BY 2""",
}

# Tables that two runs of the daily job have filled.
_TWO_RUN_SELECTS = {
    "run_etl_two_batches": f"SELECT {_FACT} FROM fact2",
    "run_etl_repeated": f"SELECT {_FACT} FROM fact2",
    "run_etl_compacted": f"SELECT {_FACT} FROM fact2",
    "run_etl_stores": "SELECT store_id, store_name, city FROM stores2",
    "run_etl_payment_methods": "SELECT payment_id, payment_method FROM pay2",
    # Days of the first run are numbered first; a day keeps its number.
    "daily_summary_table": f"""SELECT CAST(coalesce(o.id, n.first_id + row_number() OVER (
                PARTITION BY o.id IS NULL ORDER BY d.report_date NULLS FIRST)) AS INT) AS summary_id, d.*
        FROM ({_daily("fact2", "stores2")}) d
        LEFT JOIN (SELECT day, row_number() OVER (ORDER BY day NULLS FIRST) AS id
                   FROM (SELECT DISTINCT {_DAY} AS day FROM fact1) x) o ON o.day IS NOT DISTINCT FROM d.report_date
        CROSS JOIN (SELECT count(DISTINCT {_DAY}) + max(CASE WHEN {_DAY} IS NULL THEN 1 ELSE 0 END) AS first_id FROM fact1) n""",
    "etl_audit_counts": """SELECT CAST(1 AS INT) AS audit_id, 'SUCCESS' AS status, (SELECT count(*) FROM source1) AS rows_processed
        UNION ALL SELECT 2, 'SUCCESS', (SELECT count(*) FROM source2)
        UNION ALL SELECT 3, 'SUCCESS', (SELECT count(*) FROM source2)""",
}

_MERGE_SELECTS = {
    "upsert_stores": "SELECT store_id, store_name, city FROM stores2",
    "upsert_payment_methods": "SELECT payment_id, payment_method FROM pay2",
    "upsert_transactions": f"SELECT {_FACT} FROM fact2",
    "run_metrics": """SELECT (SELECT count(*) FROM batch2) AS rows_read,
            (SELECT count(*) FROM batch2 WHERE transaction_id IS NULL) AS rows_without_id,
            count(*) AS rows_processed, count(known) AS rows_updated,
            count(*) - count(known) AS rows_inserted
        FROM source2 LEFT JOIN (SELECT transaction_id AS known FROM fact1) f
            ON f.known = source2.transaction_id""",
}

_REPLAY_SELECTS = {"csv_replayed": f"SELECT {_FACT} FROM fact2"}

_REJECT_SELECTS = {
    "csv_rejects": """SELECT sha256('1:' || line) AS reject_id, CAST(1 AS BIGINT) AS load, line,
            CASE WHEN in_pieces THEN 'not a int: items_count' ELSE 'not a decimal(12,2): total_amount_ngn' END AS reject_reason,
            transaction_id, store_name, city, transaction_date, cashier_id,
            CASE WHEN NOT in_pieces THEN items_count END AS items_count,
            CASE WHEN NOT in_currency THEN total_amount_ngn END AS total_amount_ngn,
            payment_method, discount_applied, loyalty_points_earned, receipt_number
        FROM rejected_lines""",
}

_QUARANTINE_SELECTS = {
    "quarantine": f"SELECT {_RAW}, reason FROM quarantine",
    "error_samples": f"""SELECT {_RAW}, reason, CAST(rn AS INT) AS sample FROM (
            SELECT *, row_number() OVER (PARTITION BY reason ORDER BY transaction_date NULLS FIRST,
                transaction_id NULLS FIRST, store_name NULLS FIRST, city NULLS FIRST,
                cashier_id NULLS FIRST, items_count NULLS FIRST, total_amount_ngn NULLS FIRST,
                payment_method NULLS FIRST, discount_applied NULLS FIRST,
                loyalty_points_earned NULLS FIRST, receipt_number NULLS FIRST) AS rn
            FROM quarantine) x
        WHERE rn <= {SAMPLES}""",
}


def oracle_sql() -> dict[str, str]:
    texts = {}
    for selects, tables in (
        (_SELECTS, _BASE),
        (_MERGE_SELECTS, _BASE + _MERGED),
        (_TWO_RUN_SELECTS, _BASE + _TWO_RUNS),
        (_QUARANTINE_SELECTS, _BASE + _QUARANTINE),
        (_REPLAY_SELECTS, _BASE + _REPLAYED),
        (_REJECT_SELECTS, _BASE + _REJECTED),
    ):
        texts.update({name: f"{tables}\n{select}" for name, select in selects.items()})
    # A view has the rows of the report that it saves.
    return texts | {f"view_{name}": texts[name] for name in ("revenue_per_store", "daily_revenue")}
