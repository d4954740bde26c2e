"""The same queries as plain SQL for DuckDB, written independently of the Spark code.

Money is handled as whole cents and rounded in integers: DuckDB divides decimals
as doubles, which round differently at ties.
"""

from __future__ import annotations

# ---------------------------------------------------------------- base tables

_LINES = """
lines AS (
  SELECT
    CASE WHEN l_partkey % 503 = 0 THEN NULL ELSE number END AS "TransactionID",
    CASE WHEN number % 401 = 0 THEN NULL ELSE l_orderkey END AS "AccountID",
    CASE WHEN number % 307 = 0 THEN NULL ELSE l_shipdate END AS "TransactionDate",
    CASE WHEN number % 211 = 0 THEN NULL ELSE l_extendedprice END AS "TransactionAmount",
    l_linestatus AS "TransactionType",
    ' ch' || (l_suppkey % 4) || ' ' AS "TransactionChannel",
    l_partkey AS "ProductID",
    CASE WHEN l_returnflag = 'R' THEN (CASE WHEN number % 7 = 0 THEN 'FAILED' ELSE 'Failed' END)
         WHEN number % 11 = 0 THEN 'COMPLETED'
         WHEN number % 17 = 0 THEN ' success '
         ELSE 'Success' END AS "Status"
  FROM (SELECT *, l_orderkey * 10 + l_linenumber AS number FROM lineitem))"""



def _first_per(key: str, rows: str, *order_by: str) -> str:
    """Rows with a key, the smallest one per key, nulls first."""
    ordering = ", ".join(f'"{column}" NULLS FIRST' for column in order_by)
    return f"""
  SELECT * FROM {rows} WHERE "{key}" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "{key}" ORDER BY {ordering}) = 1"""


_FIRST_TXN = _first_per(
    "TransactionID", "lines", "AccountID", "TransactionDate", "TransactionAmount", "TransactionType",
    "TransactionChannel", "ProductID", "Status",
)
_TRANSACTION = f"{_LINES},\ntxn AS ({_FIRST_TXN})"

_ACCOUNT_ROWS = """
account_rows AS (
  SELECT
    o_orderkey AS "AccountID",
    o_custkey AS "CustomerID",
    ' ' || o_orderpriority || ' ' AS "AccountType",
    CASE WHEN o_orderkey % 389 = 0 THEN NULL ELSE o_orderdate END AS "OpenDate",
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 365 DAY END AS "ClosedDate",
    CASE WHEN o_orderstatus = 'F' THEN ' closed' ELSE 'Open ' END AS "Status",
    o_orderkey + 1000000 AS "RegistrationID",
    CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS "Balance"
  FROM orders WHERE (o_orderkey % 499 = 0) IS NOT TRUE)"""

_ACCOUNT_DETAILS = ("AccountType", "OpenDate", "ClosedDate", "Status", "RegistrationID", "Balance")
_FIRST_ACCOUNT = _first_per("AccountID", "account_rows", "CustomerID", *_ACCOUNT_DETAILS)
_FIRST_OF_CUSTOMER = _first_per("CustomerID", "account_rows", "AccountID", *_ACCOUNT_DETAILS)
_ACCOUNT = f"{_ACCOUNT_ROWS},\naccount AS ({_FIRST_ACCOUNT})"


def _customer(name: str, condition: str) -> str:
    details = ("FullName", "DOB", "Gender", "Region", "Email", "Status", "JoinDate")
    return f"""
{name}_rows AS (
  SELECT
    c_custkey AS "CustomerID",
    '  ' || c_name || ' ' AS "FullName",
    CASE WHEN c_custkey % 50 = 0 THEN NULL
         WHEN c_custkey % 3 = 0 THEN (c_custkey % 28 + 1) || '/' || (c_custkey % 12 + 1) || '/' || (c_custkey % 70 + 1940)
         ELSE lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') || '/' || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0')
              || '/' || (c_custkey % 70 + 1940) END AS "DOB",
    CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN ' Female' END AS "Gender",
    r_name || ' ' AS "Region",
    ' User' || c_custkey || '@Example.COM' AS "Email",
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' Active' WHEN 'BUILDING' THEN 'INACTIVE '
         WHEN 'FURNITURE' THEN 'suspended' WHEN 'MACHINERY' THEN 'active' ELSE 'Dormant' END AS "Status",
    TIMESTAMP '2010-01-01' + to_days((c_custkey % 3650)::INT) AS "JoinDate"
  FROM customer, nation, region
  WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND {condition}),
{name} AS ({_first_per("CustomerID", f"{name}_rows", *details)})"""


_CUSTOMER = _customer("cust", "TRUE")

_PRODUCT = """
cat AS (
  SELECT min(p_partkey) AS "ProductCategoryID", p_type || ' ' AS "ProductCategoryName" FROM part GROUP BY p_type),
sub AS (
  SELECT
    min(p_partkey) AS "ProductSubCategoryID",
    CASE WHEN min(p_partkey) % 41 = 0 THEN NULL ELSE
      (SELECT "ProductCategoryID" FROM cat WHERE "ProductCategoryName" = p_type || ' ') END AS "ProductCategoryID",
    ' ' || p_brand AS "ProductSubCategoryName"
  FROM part GROUP BY p_type, p_brand),
prod AS (
  SELECT
    p_partkey AS "ProductID",
    CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE min(p_partkey) OVER (PARTITION BY p_type, p_brand) END AS "ProductSubcategoryID",
    ' ' || p_name || ' ' AS "ProductName"
  FROM part)"""

# -------------------------------------------------------------------- models

# Column names, join keys, statuses, age labels and the form of quarters and hierarchies in the models below.

_STG_TXN = """
stg_transactions AS (
  SELECT "TransactionID" AS transaction_id, "AccountID" AS account_id, "ProductID" AS product_id,
    "TransactionDate"::DATE AS transaction_date, "TransactionAmount"::DECIMAL(15,2) AS transaction_amount,
    upper(trim("TransactionType")) AS transaction_type, upper(trim("TransactionChannel")) AS transaction_channel,
    upper(trim("Status")) AS status
  FROM txn WHERE "AccountID" IS NOT NULL AND "TransactionAmount" IS NOT NULL)"""

_STG_ACCOUNT = """
stg_accounts AS (
  SELECT "AccountID" AS account_id, "CustomerID" AS customer_id, trim("AccountType") AS account_type,
    "OpenDate" AS open_date, "ClosedDate" AS closed_date, upper(trim("Status")) AS status,
    "RegistrationID" AS registration_id, "Balance"::DECIMAL(15,2) AS balance
  FROM account)"""

_STG_CUSTOMER = """
stg_customers AS (
  SELECT "CustomerID" AS customer_id, trim("FullName") AS full_name, "DOB" AS date_of_birth,
    trim("Gender") AS gender, trim("Region") AS region, lower(trim("Email")) AS email,
    upper(trim("Status")) AS status, "JoinDate" AS join_date
  FROM cust)"""

_STG_PRODUCT = """
stg_products AS (
  SELECT prod."ProductID" AS product_id, trim(prod."ProductName") AS product_name,
    sub."ProductSubCategoryID" AS sub_category_id, trim(sub."ProductSubCategoryName") AS sub_category_name,
    cat."ProductCategoryID" AS category_id, trim(cat."ProductCategoryName") AS category_name
  FROM prod
  LEFT JOIN sub ON prod."ProductSubcategoryID" = sub."ProductSubCategoryID"
  LEFT JOIN cat ON sub."ProductCategoryID" = cat."ProductCategoryID")"""

_DIM_CUSTOMER = """
dim_customer AS (
  SELECT *, CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
                 WHEN age < 50 THEN '35-49' WHEN age < 65 THEN '50-64' ELSE '65+' END AS age_bucket
  FROM (SELECT *, date_part('year', age(TIMESTAMP '2024-01-01', strptime(date_of_birth, '%d/%m/%Y'))) AS age
        FROM stg_customers))"""

_DIM_ACCOUNT = """
dim_account AS (
  SELECT a.account_id, a.customer_id, c.full_name AS customer_name, c.region AS customer_region, a.account_type,
    a.open_date, a.closed_date, a.status AS account_status, c.status AS customer_status, a.registration_id,
    a.balance, date_diff('day', a.open_date, TIMESTAMP '2024-01-01') AS account_age_days
  FROM stg_accounts a LEFT JOIN dim_customer c ON a.customer_id = c.customer_id)"""

_DIM_PRODUCT = """
dim_product AS (
  SELECT *, category_name || ' > ' || sub_category_name || ' > ' || product_name AS product_hierarchy
  FROM stg_products)"""

_DIM_DATE = """
dim_date AS (
  SELECT d AS date_key, d AS full_date, year(d)::INT AS "year", month(d)::INT AS "month",
    rpad(strftime(d, '%B'), 9, ' ') AS month_name, day(d)::INT AS "day", dayofweek(d)::INT AS day_of_week,
    rpad(strftime(d, '%A'), 9, ' ') AS day_name, quarter(d)::INT AS "quarter", 'Q' || quarter(d) AS quarter_label,
    weekofyear(d)::INT AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(min(transaction_date), max(transaction_date), INTERVAL 1 DAY))::DATE AS d
        FROM stg_transactions))"""

_FACT = """
fact AS (
  SELECT t.transaction_id, t.account_id, a.customer_id, t.product_id, t.transaction_date AS date_key,
    t.transaction_type, t.transaction_channel, t.status AS transaction_status, a.account_type, a.account_status,
    a.customer_region, p.product_name, p.sub_category_name, p.category_name,
    d."year", d."month", d."quarter", d.quarter_label, d.is_weekend, t.transaction_amount,
    (t.status = 'FAILED')::INT AS is_failed, (t.status = 'COMPLETED')::INT AS is_completed,
    coalesce(d.is_weekend, FALSE)::INT AS is_weekend_txn
  FROM stg_transactions t
  LEFT JOIN dim_account a ON t.account_id = a.account_id
  LEFT JOIN dim_product p ON t.product_id = p.product_id
  LEFT JOIN dim_date d ON t.transaction_date = d.date_key)"""

_CUSTOMER_MART = [_CUSTOMER, _STG_CUSTOMER, _DIM_CUSTOMER]
_ACCOUNT_MART = [*_CUSTOMER_MART, _ACCOUNT, _STG_ACCOUNT, _DIM_ACCOUNT]
_PRODUCT_MART = [_PRODUCT, _STG_PRODUCT, _DIM_PRODUCT]
_CALENDAR = [_TRANSACTION, _STG_TXN, _DIM_DATE]
_STAR = [*_CALENDAR, *_ACCOUNT_MART, *_PRODUCT_MART, _FACT]


def _with(parts: list[str], select: str) -> str:
    return "WITH" + ",".join(parts) + "\n" + select


# ------------------------------------------------------------------- queries

_CENTS = """
paid AS (SELECT *, CAST(round("TransactionAmount" * 100) AS BIGINT) AS cents FROM txn)"""


def _scaled(whole: str, digits: int, width: int = 25) -> str:
    """An integer count of 10**-digits units as a decimal."""
    unit = f"0.{'0' * (digits - 1)}1"
    return f"CAST(CAST({whole} AS DECIMAL({width},0)) * CAST({unit} AS DECIMAL({digits + 1},{digits})) AS DECIMAL({width},{digits}))"


def _average(cents: str, n: str) -> str:
    """Average of whole cents, rounded half away from zero."""
    return _scaled(f"sign({cents}) * ((2 * abs({cents}) + {n}) // (2 * {n}))", 2)


_MONTHLY = _with([_TRANSACTION, _CENTS], f"""
SELECT month, transactiontype, txn_count, {_scaled('cents', 2)} AS total_amount,
  {_average('cents', 'n')} AS avg_amount,
  {_scaled('sum(cents) OVER (PARTITION BY transactiontype ORDER BY month)', 2)} AS running_total_by_type,
  {_scaled('sum(cents) OVER (ORDER BY month)', 2)} AS overall_running_total
FROM (SELECT date_trunc('month', "TransactionDate") AS month, "TransactionType" AS transactiontype,
        count(*) AS txn_count, sum(cents) AS cents, count(cents) AS n
      FROM paid WHERE "Status" = 'Success' AND "TransactionDate" IS NOT NULL GROUP BY ALL)""")

_SPENT = _with([_TRANSACTION, _CENTS, _ACCOUNT, _CUSTOMER], f"""
SELECT "CustomerID", "FullName", "Region", customer_status, txn_count, {_scaled('cents', 2)} AS total_spent,
  {_average('cents', 'n')} AS avg_txn_amount, last_transaction_date, spend_rank,
  {_scaled('(2000 * smaller + others) // (2 * others)', 1, 12)} AS spend_percentile
FROM (SELECT *, rank() OVER (ORDER BY cents DESC NULLS FIRST) AS spend_rank,
        rank() OVER (ORDER BY cents NULLS LAST) - 1 AS smaller, count(*) OVER () - 1 AS others
      FROM (SELECT cust."CustomerID", "FullName", "Region", cust."Status" AS customer_status,
              count("TransactionID") AS txn_count, sum(cents) AS cents, count(cents) AS n,
              max("TransactionDate") AS last_transaction_date
            FROM paid, account, cust
            WHERE paid."AccountID" = account."AccountID" AND account."CustomerID" = cust."CustomerID"
              AND paid."Status" = 'Success'
            GROUP BY ALL))""")
_TOP = f'{_SPENT}\nORDER BY spend_rank, "CustomerID" LIMIT 20'


def _outcomes(keys: str, completed: str, failed: str) -> str:
    """Outcome counts per product attributes, as the body of a derived table."""
    return f"""
  SELECT {keys}, count("TransactionID") AS total_txns,
    count(CASE WHEN "Status" = '{completed}' THEN "TransactionID" END) AS completed,
    count(CASE WHEN "Status" = '{failed}' THEN "TransactionID" END) AS failed,
    sum(cents) AS cents, sum(CASE WHEN "Status" = '{failed}' THEN cents END) AS failed_cents
  FROM (SELECT paid.*, "ProductCategoryName" AS category, "ProductSubCategoryName" AS sub_category,
          "ProductName" AS productname
        FROM paid, prod, sub, cat
        WHERE paid."ProductID" = prod."ProductID"
          AND prod."ProductSubcategoryID" = sub."ProductSubCategoryID"
          AND sub."ProductCategoryID" = cat."ProductCategoryID")
  GROUP BY {keys}"""


_RISK = _with([_TRANSACTION, _CENTS, _PRODUCT], f"""
SELECT category, sub_category, productname, total_txns, completed, failed,
  {_scaled('(20000 * failed + total_txns) // (2 * total_txns)', 2, 12)} AS failure_rate_pct,
  {_scaled('cents', 2)} AS total_volume, {_scaled('failed_cents', 2)} AS failed_volume,
  rank() OVER (PARTITION BY category ORDER BY failed / total_txns DESC NULLS FIRST) AS risk_rank_in_category
FROM ({_outcomes('category, sub_category, productname', 'Success', 'Failed')})""")

_VOLUME = _with([_TRANSACTION, _CENTS, _PRODUCT], f"""
SELECT category, productname, total_txns, failed, {_scaled('cents', 2)} AS total_volume,
  rank() OVER (PARTITION BY category ORDER BY total_txns DESC) AS volume_rank
FROM ({_outcomes('category, productname', 'Success', 'Failed')})""")

_VOLUME_SUB = _with([_TRANSACTION, _CENTS, _PRODUCT], f"""
SELECT category, sub_category, productname, total_txns, completed, failed, {_scaled('cents', 2)} AS total_volume,
  rank() OVER (PARTITION BY category ORDER BY total_txns DESC) AS volume_rank
FROM ({_outcomes('category, sub_category, productname', 'COMPLETED', 'FAILED')})""")

_COUNTS = _with(
    [_TRANSACTION, _ACCOUNT, _CUSTOMER, _customer("cust_usa", "r_name = 'AMERICA'"), _PRODUCT],
    "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS rows FROM {cte}"
        for table, cte in (
            ("DimProductCategory", "cat"), ("DimProductSubCategory", "sub"), ("DimProduct", "prod"),
            ("DimCustomer", "cust"), ("DimCustomerUSA", "cust_usa"), ("DimAccount", "account"),
            ("FactTransaction", "txn"),
        )
    ),
)

# Dataset, base table, its rows here, and its columns with the ingest stamp.
_DATASETS = (
    ("dim_product_category", "DimProductCategory", "cat", 2),
    ("dim_product_sub_category", "DimProductSubCategory", "sub", 3),
    ("dim_product", "DimProduct", "prod", 3),
    ("dim_customer", "DimCustomer", "cust", 9),
    ("dim_customer_usa", "DimCustomerUSA", "cust_usa", 9),
    ("dim_account", "DimAccount", "account", 9),
    ("fact_transaction", "FactTransaction", "txn", 9),
)
_BASE = [_TRANSACTION, _ACCOUNT, _CUSTOMER, _customer("cust_usa", "r_name = 'AMERICA'"), _PRODUCT]

_LOADED = _with(_BASE, "\nUNION ALL ".join(
    f"SELECT '{name}' AS name, '{table}' AS \"table\", 'SUCCESS' AS status, count(*) AS rows,"
    f" {columns}::INTEGER AS \"columns\", NULL::VARCHAR AS error FROM {cte}"
    for name, table, cte, columns in _DATASETS
))

_STAMPS = _with(_BASE, "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS rows, count(*) AS stamped, true AS one_stamp FROM {cte}"
    for _, table, cte, columns in _DATASETS if columns == 9
))

# Outcomes of a load in which the products are refused, and of the one after it.
_RESUMED = _with(_BASE, "\nUNION ALL ".join(
    f"SELECT {run} AS run, '{name}' AS name, '{table}' AS \"table\", '{status}' AS status, "
    + (f"count(*) AS rows, {columns}::INTEGER AS \"columns\", NULL::VARCHAR AS error FROM {cte}" if not error
       else f"NULL::BIGINT AS rows, NULL::INTEGER AS \"columns\", '{error}' AS error")
    for run, refused, kept in ((1, True, "SUCCESS"), (2, False, "LOADED_BEFORE"))
    for name, table, cte, columns in _DATASETS
    for status, error in [{
        "DimProduct": ("FAILED", "refused") if refused else ("SUCCESS", ""),
        "FactTransaction": ("PARENT_FAILED", "not loaded: DimProduct") if refused else ("SUCCESS", ""),
    }.get(table, (kept, ""))]
))

_REJECTS = """
SELECT CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END AS outcome, reason, count(*) AS rows
FROM (SELECT CASE WHEN l_partkey % 29 = 0 THEN '7 fields instead of 8' WHEN l_partkey % 31 = 0 THEN '9 fields instead of 8'
                  WHEN l_partkey % 37 = 0 THEN 'quote without end' END AS reason FROM lineitem)
GROUP BY reason"""


def _placed(report: str, order: str) -> str:
    """A report with the place of each row, by a total order."""
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({report})"


# -------------------------------------------------------------------- checks


# Model, column, kind, severity, and accepted values or parent, of the 42 declared checks.
_EXPECTED = (
    ("stg_transactions", "transaction_id", "unique", "error", ""),
    ("stg_transactions", "transaction_id", "not_null", "error", ""),
    ("stg_transactions", "account_id", "not_null", "error", ""),
    ("stg_transactions", "transaction_amount", "not_null", "error", ""),
    ("stg_transactions", "transaction_date", "not_null", "error", ""),
    ("stg_transactions", "status", "accepted_values", "error", "SUCCESS FAILED"),
    ("stg_customers", "customer_id", "unique", "error", ""),
    ("stg_customers", "customer_id", "not_null", "error", ""),
    ("stg_customers", "full_name", "not_null", "error", ""),
    ("stg_accounts", "account_id", "unique", "error", ""),
    ("stg_accounts", "account_id", "not_null", "error", ""),
    ("stg_accounts", "customer_id", "not_null", "error", ""),
    ("stg_products", "product_id", "unique", "error", ""),
    ("stg_products", "product_id", "not_null", "error", ""),
    ("stg_products", "product_name", "not_null", "error", ""),
    ("dim_customer", "customer_id", "unique", "error", ""),
    ("dim_customer", "customer_id", "not_null", "error", ""),
    ("dim_customer", "full_name", "not_null", "error", ""),
    ("dim_customer", "status", "accepted_values", "error", "ACTIVE INACTIVE SUSPENDED"),
    ("dim_account", "account_id", "unique", "error", ""),
    ("dim_account", "account_id", "not_null", "error", ""),
    ("dim_account", "customer_id", "not_null", "error", ""),
    ("dim_account", "balance", "not_null", "error", ""),
    ("dim_account", "account_status", "accepted_values", "error", "OPEN CLOSED"),
    ("dim_account", "customer_id", "relationships", "error", "dim_customer customer_id"),
    ("dim_product", "product_id", "unique", "error", ""),
    ("dim_product", "product_id", "not_null", "error", ""),
    ("dim_product", "product_name", "not_null", "error", ""),
    ("dim_product", "category_name", "not_null", "error", ""),
    ("dim_date", "date_key", "unique", "error", ""),
    ("dim_date", "date_key", "not_null", "error", ""),
    ("dim_date", "year", "not_null", "error", ""),
    ("dim_date", "month", "not_null", "error", ""),
    ("fact_transactions", "transaction_id", "unique", "error", ""),
    ("fact_transactions", "transaction_id", "not_null", "error", ""),
    ("fact_transactions", "account_id", "not_null", "error", ""),
    ("fact_transactions", "date_key", "not_null", "error", ""),
    ("fact_transactions", "transaction_amount", "not_null", "error", ""),
    ("fact_transactions", "transaction_status", "accepted_values", "error", "SUCCESS FAILED"),
    ("fact_transactions", "account_id", "relationships", "warn", "dim_account account_id"),
    ("fact_transactions", "product_id", "relationships", "error", "dim_product product_id"),
    ("fact_transactions", "date_key", "relationships", "error", "dim_date date_key"),
)


def _check_failures(name: str, column: str, kind: str, other: str) -> str:
    model = {"fact_transactions": "fact"}.get(name, name)
    column = f'"{column}"'
    if kind == "unique":
        repeated = f"SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
        return f"SELECT count(*) FROM ({repeated})"
    if kind == "not_null":
        return f"SELECT count(*) FROM {model} WHERE {column} IS NULL"
    if kind == "accepted_values":
        accepted = ", ".join(f"'{value}'" for value in other.split())
        return f"SELECT count(DISTINCT {column}) FROM {model} WHERE {column} NOT IN ({accepted})"
    parent, parent_column = other.split()
    return (
        f"SELECT count(*) FROM {model} WHERE {column} IS NOT NULL"
        f' AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p."{parent_column}" = {model}.{column})'
    )


_CHECK_RESULTS = _with(
    _STAR,
    "SELECT *, failures = 0 AS passed FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{kind}_{model}_{column}' AS test_name, '{model}' AS model, '{column}' AS \"column\", '{kind}' AS kind,"
        f" '{severity}' AS severity, ({_check_failures(model, column, kind, other)}) AS failures"
        for model, column, kind, severity, other in _EXPECTED
    )
    + ")",
)

# ---------------------------------------------------------------- indicators

_RANGE = "BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'"


def _daily_volume(condition: str) -> str:
    return _with(_CALENDAR, f"""
SELECT date_key, count(transaction_id) AS txn_count,
  coalesce(sum(transaction_amount), 0)::DECIMAL(25,2) AS total_amount
FROM dim_date LEFT JOIN stg_transactions ON transaction_date = date_key
WHERE {condition} GROUP BY date_key""")


def _rolling(condition: str) -> str:
    return _with([_TRANSACTION, _STG_TXN], f"""
SELECT account_id, date_key, {_scaled('cents', 2)} AS daily_amount, {_average('w_cents', 'w_days')} AS rolling_avg
FROM (SELECT *, sum(cents) OVER w AS w_cents, count(*) OVER w AS w_days
      FROM (SELECT account_id, transaction_date AS date_key, sum(transaction_amount * 100)::BIGINT AS cents
            FROM stg_transactions WHERE transaction_date IS NOT NULL GROUP BY ALL)
      WINDOW w AS (PARTITION BY account_id ORDER BY date_key
                   RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW))
WHERE {condition}""")


def _branch_rank(condition: str) -> str:
    return _with(_STAR, f"""
SELECT *, rank() OVER (ORDER BY total_amount DESC) AS volume_rank
FROM (SELECT customer_region, count(*) AS txn_count, sum(transaction_amount)::DECIMAL(25,2) AS total_amount
      FROM fact WHERE {condition} GROUP BY customer_region)""")


def _type_breakdown(condition: str) -> str:
    return _with(_ACCOUNT_MART, f"""
SELECT account_type, count(*) AS account_count, sum(balance)::DECIMAL(25,2) AS total_balance
FROM dim_account WHERE {condition} GROUP BY account_type""")


def oracle_sql() -> dict[str, str]:
    fact_columns = """
SELECT transaction_id, account_id, customer_id, product_id, date_key, transaction_type, transaction_channel,
  transaction_status, account_type, account_status, customer_region, product_name, sub_category_name,
  category_name, "year", "month", "quarter", quarter_label, is_weekend, transaction_amount, is_failed,
  is_completed, is_weekend_txn FROM fact"""
    fact = _with(_STAR, fact_columns)
    return {
        "failure_risk": _RISK,
        "monthly_revenue": _MONTHLY,
        "top_customers": _TOP,
        "customer_percentiles": _SPENT,
        "monthly_revenue_in_order": _placed(_MONTHLY, "month NULLS LAST, transactiontype NULLS LAST"),
        "top_customers_in_order": _placed(_TOP, 'spend_rank, "CustomerID"'),
        "failure_risk_in_order": _placed(_RISK, "failure_rate_pct DESC NULLS FIRST, category, sub_category, productname"),
        "product_volume_rank_in_order": _placed(_VOLUME, "total_txns DESC NULLS FIRST, category, productname"),
        "product_volume_rank_sub_in_order": _placed(_VOLUME_SUB, "total_txns DESC NULLS FIRST, category, sub_category, productname"),
        "product_volume_rank": _VOLUME,
        "product_volume_rank_sub": _VOLUME_SUB,
        "row_counts": _COUNTS,
        "clean_product_category": _with([_PRODUCT], "SELECT * FROM cat"),
        "clean_product_sub_category": _with([_PRODUCT], "SELECT * FROM sub"),
        "clean_product": _with([_PRODUCT], "SELECT * FROM prod"),
        "clean_customer": _with([_CUSTOMER], "SELECT * FROM cust"),
        "clean_customer_usa": _with([_customer("cust_usa", "r_name = 'AMERICA'")], "SELECT * FROM cust_usa"),
        "dedup_accounts_per_customer": _with([_ACCOUNT_ROWS], _FIRST_OF_CUSTOMER),
        "raw_zone_accounts": _with([_ACCOUNT_ROWS], _FIRST_OF_CUSTOMER),
        "clean_account_by_id": _with([_ACCOUNT], "SELECT * FROM account"),
        "dedup_transactions": _with([_TRANSACTION], "SELECT * FROM txn"),
        "raw_zone_transactions": _with([_TRANSACTION], "SELECT * FROM txn"),
        "stg_transactions": _with([_TRANSACTION, _STG_TXN], "SELECT * FROM stg_transactions"),
        "stg_accounts": _with([_ACCOUNT, _STG_ACCOUNT], "SELECT * FROM stg_accounts"),
        "stg_customers": _with([_CUSTOMER, _STG_CUSTOMER], "SELECT * FROM stg_customers"),
        "stg_products": _with([_PRODUCT, _STG_PRODUCT], "SELECT * FROM stg_products"),
        "dim_customer": _with(_CUSTOMER_MART, "SELECT * EXCLUDE (age) FROM dim_customer"),
        "dim_account": _with(_ACCOUNT_MART, "SELECT * FROM dim_account"),
        "dim_product": _with(_PRODUCT_MART, "SELECT * FROM dim_product"),
        "dim_date": _with(_CALENDAR, "SELECT * FROM dim_date"),
        "fact_transactions": fact,
        "fact_transactions_joined_calendar": fact,
        "fact_transactions_split": fact,
        "published_fact": fact,
        "published_fact_joined_calendar": fact,
        "load_outcomes": _LOADED,
        "resumed_load": _RESUMED,
        "raw_zone_rejects": _REJECTS,
        "ingest_stamps": _STAMPS,
        "undated_volume": _with(_STAR, """
SELECT count(*) AS txn_count, coalesce(sum(transaction_amount), 0)::DECIMAL(25,2) AS total_amount
FROM fact WHERE date_key IS NULL"""),
        "dq_results": _CHECK_RESULTS,
        "daily_volume": _daily_volume("TRUE"),
        "daily_volume_in_range": _daily_volume(f"date_key {_RANGE}"),
        "branch_liquidity": _with(_ACCOUNT_MART, """
SELECT customer_region, count(*) AS open_accounts, sum(balance)::DECIMAL(25,2) AS total_balance
FROM dim_account WHERE account_status = 'OPEN' GROUP BY customer_region"""),
        "balance_distribution": _with(_ACCOUNT_MART, """
SELECT account_type, (floor(balance / 50000) * 50000)::BIGINT AS bucket_from, count(*) AS account_count
FROM dim_account GROUP BY ALL"""),
        "rolling_30d": _rolling("TRUE"),
        "rolling_30d_in_range": _rolling(f"date_key {_RANGE}"),
        "branch_volume_rank": _branch_rank("TRUE"),
        "branch_volume_rank_in_range": _branch_rank(f"date_key {_RANGE}"),
        "account_type_breakdown": _type_breakdown("TRUE"),
        "account_type_breakdown_filtered": _type_breakdown("account_type IN ('1-URGENT', '5-LOW')"),
    }
