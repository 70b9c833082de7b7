"""DuckDB SQL for every registered query (the cross-engine correctness check).

The driver registers the parquet tables as views and runs each string.
A shared ``WITH`` prefix rebuilds the raw feeds (mirroring
``sources/testdata.py``), the staging tables and the dimensions; each
query then selects from it.  Surrogate keys use ``row_number()`` in the
same total order as ``operators.keys.assign_keys``.
"""

from __future__ import annotations

from ..sources.schemas import RAW_LENGTHS

# Fixed values shared with sources/testdata.py.
_RAW = r"""
raw_check_summary AS (
  SELECT CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 30 = 4 THEN '  ' ELSE '' END AS check_id,
    CASE WHEN o_orderkey % 120 = 110 THEN '9999' ELSE CAST(o_orderkey % 120 AS VARCHAR) END AS store_id,
    CASE WHEN o_orderkey % 120 = 110 THEN '' ELSE CAST(1 + o_orderkey % 10 AS VARCHAR) END AS cashier_id,
    CASE WHEN o_orderkey % 1000 = 7 THEN '31-02-1997 10:00'
         ELSE strftime(o_orderdate, '%d-%m-%Y') || ' ' || lpad(CAST(8 + o_orderkey % 15 AS VARCHAR), 2, '0')
              || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') END AS datetime,
    CASE WHEN o_orderkey % 5 < 2 THEN ''
         WHEN o_orderkey % 50 = 2 THEN CAST(o_custkey + 1000000 AS VARCHAR)
         ELSE CAST(o_custkey AS VARCHAR) END AS customer_id
  FROM orders),
li_base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, p.p_name,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS up,
         CAST(l.l_quantity AS DECIMAL(10,2)) AS q,
         CAST(round(l.l_discount * 100) AS INTEGER) AS pct
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
li_amt AS (
  SELECT *, CAST(up * q * pct * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS dabs FROM li_base),
li_tot AS (
  SELECT *, CAST(CAST(greatest(up * q - dabs, 0) AS DECIMAL(18,2)) AS VARCHAR) AS tot FROM li_amt),
raw_check_details AS (
  SELECT CASE WHEN l_orderkey % 400 = 399 THEN CAST(l_orderkey + 100000000 AS VARCHAR)
              ELSE CAST(l_orderkey AS VARCHAR) END AS check_id,
    CAST(l_partkey AS VARCHAR) AS product_id,
    p_name AS product_name,
    CASE WHEN l_orderkey % 500 = 13 AND l_linenumber = 1 THEN '12,50' ELSE ' ' || CAST(up AS VARCHAR) END AS unit_price,
    CASE WHEN l_orderkey % 500 = 14 AND l_linenumber = 1 THEN 'abc'
         WHEN pct = 0 THEN '' ELSE CAST(pct AS VARCHAR) END AS discount_pct,
    CASE WHEN pct = 0 THEN '' ELSE CAST(dabs AS VARCHAR) END AS discount_abs,
    CASE WHEN pct = 0 THEN '' WHEN l_linenumber % 2 = 0 THEN '99'
         ELSE '1' || CAST(l_linenumber AS VARCHAR) END AS discount_type,
    CASE WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 4 THEN '-1'
         ELSE CAST(q AS VARCHAR) END AS quantity,
    CASE WHEN l_orderkey % 500 = 15 AND l_linenumber = 1 THEN '123456789012345678'
         WHEN l_linenumber = 7 THEN '-' || tot ELSE tot END AS total_amount
  FROM li_tot),
raw_products AS (
  SELECT CAST(CASE WHEN p_partkey % 97 = 96 THEN p_partkey + 1000000000 ELSE p_partkey END AS VARCHAR) AS product_id,
         ' ' || p_name || ' ' AS name, p_brand AS unit, p_type AS category
  FROM part),
raw_pricing AS (
  SELECT CAST(CASE WHEN p_partkey % 50 = 0 THEN p_partkey + 1000000000 ELSE p_partkey END AS VARCHAR) AS product_id,
    CAST(CAST(CASE WHEN r.seq = 5 THEN p_retailprice + 55 ELSE p_retailprice + (r.seq - 1) * 10 END
              AS DECIMAL(10,2)) AS VARCHAR) AS price,
    CASE WHEN r.seq = 5 AND p_partkey % 11 <> 0 THEN '01-01-2005' ELSE r.a END AS start_date,
    CASE WHEN r.seq = 5 AND p_partkey % 11 <> 0 THEN '31-12-2005' ELSE r.b END AS end_date,
    CASE WHEN (r.seq = 4 AND p_partkey % 7 <> 0) OR (r.seq = 5 AND p_partkey % 11 = 0) THEN '1' ELSE '0' END AS is_active,
    r.seq AS load_seq
  FROM (SELECT p_partkey, p_retailprice,
               unnest([{'seq': 1, 'a': '01-01-1995', 'b': '30-06-1996'},
                       {'seq': 2, 'a': '01-07-1996', 'b': '31-12-1997'},
                       {'seq': 3, 'a': '01-01-1998', 'b': '30-06-1999'},
                       {'seq': 4, 'a': '01-07-1999', 'b': '31-12-2000'},
                       {'seq': 5, 'a': '01-06-2000', 'b': '31-12-2001'}]) AS r
        FROM part)),
raw_promo AS (
  SELECT r.t AS promo_type, CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN r.seq = 1 THEN CAST(10 + p_partkey % 41 AS VARCHAR)
         WHEN p_partkey % 45 = 0 THEN '-5'
         ELSE CAST(10 + p_partkey % 41 + 5 AS VARCHAR) END AS discount_pct,
    CASE WHEN p_partkey % 5 = 0 THEN r.a ELSE '01-01-2005' END AS start_date,
    CASE WHEN p_partkey % 5 = 0 THEN r.b ELSE '31-12-2005' END AS end_date,
    CASE WHEN r.seq = 2 AND p_partkey % 2 = 0 THEN '1' ELSE '0' END AS is_active,
    r.d AS description, r.seq AS load_seq
  FROM (SELECT p_partkey,
               unnest([{'seq': 1, 't': '10', 'a': '01-01-1996', 'b': '01-01-1998', 'd': ' Weekly deal '},
                       {'seq': 2, 't': '11', 'a': '01-01-1997', 'b': '01-01-1999', 'd': ' Clearance '}]) AS r
        FROM part)),
raw_stores AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id,
    CASE s_suppkey % 3 WHEN 0 THEN 'hyper' WHEN 1 THEN 'super' ELSE 'to go' END AS format,
    ' ' || n_name AS city, r_name || ' region' AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
raw_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
    CASE WHEN c_custkey % 10 = 0 THEN '9999' ELSE n_name END AS city,
    CASE WHEN c_custkey % 5 = 0 THEN ''
         ELSE strftime(DATE '1970-01-01' + CAST(c_custkey AS INTEGER), '%d-%m-%Y') END AS birthday
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_customers_delta AS (
  SELECT customer_id, name,
    CASE WHEN CAST(customer_id AS BIGINT) % 7 = 0 THEN 'NEW'
         WHEN CAST(customer_id AS BIGINT) % 11 = 0 THEN ''
         WHEN CAST(customer_id AS BIGINT) % 17 = 0 THEN lower(city) ELSE city END AS city,
    birthday
  FROM raw_customers
  UNION ALL
  SELECT CAST(CAST(customer_id AS BIGINT) + 2000000000 AS VARCHAR), name, city, birthday
  FROM raw_customers),
customer_changes AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 10 < 3 THEN DATE '1998-01-01' ELSE DATE '1980-01-01' END AS change_date,
    'OLD ' || n_name AS old_city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_STG = r"""
stg_stores AS (
  SELECT TRY_CAST(trim(store_id) AS INTEGER) AS store_id, trim(format) AS store_format,
         trim(city) AS city, trim(region) AS region FROM raw_stores
  UNION ALL SELECT 9999, 'Online', 'Online', 'Online'),
stg_customers AS (
  SELECT TRY_CAST(trim(customer_id) AS BIGINT) AS customer_id, trim(name) AS name,
    CASE WHEN trim(city) = '9999' THEN 'Online' ELSE trim(city) END AS city,
    CAST(try_strptime(NULLIF(trim(birthday), ''), '%d-%m-%Y') AS DATE) AS birthday
  FROM raw_customers),
stg_delta AS (
  SELECT TRY_CAST(trim(customer_id) AS BIGINT) AS customer_id, trim(name) AS name,
    CASE WHEN trim(city) = '9999' THEN 'Online' ELSE trim(city) END AS city,
    CAST(try_strptime(NULLIF(trim(birthday), ''), '%d-%m-%Y') AS DATE) AS birthday
  FROM raw_customers_delta),
stg_pricing AS (
  SELECT TRY_CAST(trim(product_id) AS INTEGER) AS product_id,
    TRY_CAST(NULLIF(trim(price), '') AS DECIMAL(10,2)) AS price,
    CAST(try_strptime(NULLIF(trim(start_date), ''), '%d-%m-%Y') AS DATE) AS start_date,
    CAST(try_strptime(NULLIF(trim(end_date), ''), '%d-%m-%Y') AS DATE) AS end_date,
    TRY_CAST(NULLIF(trim(is_active), '') AS INTEGER) = 1 AS is_active,
    load_seq
  FROM raw_pricing),
stg_promo AS (
  SELECT TRY_CAST(NULLIF(trim(promo_type), '') AS INTEGER) AS promo_type,
    TRY_CAST(trim(product_id) AS INTEGER) AS product_id,
    greatest(COALESCE(TRY_CAST(NULLIF(trim(discount_pct), '') AS INTEGER), 0), 0) AS discount_pct,
    CAST(try_strptime(NULLIF(trim(start_date), ''), '%d-%m-%Y') AS DATE) AS start_date,
    CAST(try_strptime(NULLIF(trim(end_date), ''), '%d-%m-%Y') AS DATE) AS end_date,
    TRY_CAST(NULLIF(trim(is_active), '') AS INTEGER) = 1 AS is_active,
    trim(description) AS description,
    load_seq
  FROM raw_promo),
stg_products AS (
  SELECT p.product_id, p.name, p.unit, p.category, pr.price AS current_retail_price
  FROM (SELECT TRY_CAST(trim(product_id) AS INTEGER) AS product_id, trim(name) AS name,
               trim(unit) AS unit, trim(category) AS category FROM raw_products) p
  LEFT JOIN stg_pricing pr ON p.product_id = pr.product_id AND pr.is_active),
stg_transactions AS (
  SELECT TRY_CAST(trim(s.check_id) AS BIGINT) AS check_id,
    TRY_CAST(trim(s.store_id) AS INTEGER) AS store_id,
    TRY_CAST(NULLIF(trim(s.cashier_id), '') AS INTEGER) AS cashier_id,
    TRY_CAST(NULLIF(trim(s.customer_id), '') AS BIGINT) AS customer_id,
    try_strptime(NULLIF(trim(s.datetime), ''), '%d-%m-%Y %H:%M') AS transaction_datetime,
    TRY_CAST(trim(d.product_id) AS INTEGER) AS product_id,
    COALESCE(greatest(TRY_CAST(NULLIF(trim(d.unit_price), '') AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4))), CAST(0 AS DECIMAL(18,4))) AS unit_price,
    COALESCE(greatest(TRY_CAST(NULLIF(trim(d.quantity), '') AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4))), CAST(0 AS DECIMAL(18,4))) AS quantity,
    COALESCE(greatest(TRY_CAST(NULLIF(trim(d.total_amount), '') AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4))), CAST(0 AS DECIMAL(18,4))) AS total_amount,
    COALESCE(greatest(TRY_CAST(NULLIF(trim(d.discount_abs), '') AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4))), CAST(0 AS DECIMAL(18,4))) AS discount_abs,
    greatest(COALESCE(TRY_CAST(NULLIF(trim(d.discount_pct), '') AS INTEGER), 0), 0) AS discount_pct,
    COALESCE(TRY_CAST(NULLIF(trim(d.discount_type), '') AS INTEGER), 0) AS discount_type
  FROM raw_check_details d JOIN raw_check_summary s ON rtrim(d.check_id) = rtrim(s.check_id))"""

_DIMS = r"""
bounds AS (
  SELECT MIN(CAST(transaction_datetime AS DATE)) AS lo, MAX(CAST(transaction_datetime AS DATE)) AS hi
  FROM stg_transactions),
days AS (
  SELECT CAST(gs AS DATE) AS full_date
  FROM bounds, generate_series(CAST(bounds.lo AS TIMESTAMP), CAST(bounds.hi AS TIMESTAMP), INTERVAL 1 DAY) t(gs)),
dim_date AS (
  SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
    full_date,
    CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week_num,
    strftime(full_date, '%A') AS day_of_week_name,
    CAST(month(full_date) AS INTEGER) AS month_number,
    strftime(full_date, '%B') AS month_name,
    CAST(quarter(full_date) AS INTEGER) AS quarter,
    CAST(year(full_date) AS INTEGER) AS year
  FROM days),
dim_products AS (
  SELECT CAST(row_number() OVER (ORDER BY product_id NULLS LAST, name NULLS LAST, unit NULLS LAST,
                                 category NULLS LAST, current_retail_price NULLS LAST) AS INTEGER) AS product_key,
    product_id, name, unit AS unit_of_measure, category, current_retail_price
  FROM stg_products
  UNION ALL SELECT -1, -1, 'Unknown', NULL, NULL, NULL),
dim_stores AS (
  SELECT CAST(row_number() OVER (ORDER BY store_id NULLS LAST, store_format NULLS LAST, city NULLS LAST,
                                 region NULLS LAST) AS INTEGER) AS store_key,
    store_id, store_format AS format, city, region
  FROM stg_stores
  UNION ALL SELECT -1, -1, 'Unknown', 'Unknown', 'Unknown'),
first_purchase AS (
  SELECT customer_id, MIN(CAST(transaction_datetime AS DATE)) AS first_purchase_date
  FROM stg_transactions WHERE customer_id IS NOT NULL GROUP BY customer_id),
scd2_init AS (
  SELECT c.customer_id, c.name, c.city, c.birthday,
    COALESCE(fp.first_purchase_date, DATE '2002-01-01') AS valid_from,
    DATE '9999-12-31' AS valid_to, TRUE AS is_current
  FROM stg_customers c LEFT JOIN first_purchase fp ON c.customer_id = fp.customer_id),
scd2_split AS (
  SELECT i.customer_id, i.name, ch.old_city AS city, i.birthday, i.valid_from,
         ch.change_date - 1 AS valid_to, FALSE AS is_current
  FROM scd2_init i JOIN customer_changes ch ON i.customer_id = ch.customer_id
  WHERE i.valid_from < ch.change_date
  UNION ALL
  SELECT i.customer_id, i.name, i.city, i.birthday,
    CASE WHEN ch.customer_id IS NOT NULL AND i.valid_from < ch.change_date
         THEN ch.change_date ELSE i.valid_from END AS valid_from,
    i.valid_to, i.is_current
  FROM scd2_init i LEFT JOIN customer_changes ch ON i.customer_id = ch.customer_id),
dim_customers AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS LAST, valid_from NULLS LAST, valid_to NULLS LAST,
                                 city NULLS LAST, name NULLS LAST, birthday NULLS LAST) AS BIGINT) AS customer_key,
    customer_id, name, city, birthday, valid_from, valid_to, is_current
  FROM scd2_split
  UNION ALL SELECT 0, NULL, 'Guest Customer', 'Unknown', NULL, DATE '1900-01-01', DATE '9999-12-31', TRUE),
scd2_changed AS (
  SELECT s.customer_id, s.name, s.city, s.birthday
  FROM stg_delta s JOIN dim_customers d ON s.customer_id = d.customer_id AND d.is_current
  WHERE COALESCE(s.city, '') <> COALESCE(d.city, '')),
scd2_close AS (
  SELECT d.customer_key, d.customer_id, d.name, d.city, d.birthday, d.valid_from,
    CASE WHEN d.is_current AND d.customer_id IN (SELECT customer_id FROM scd2_changed)
         THEN DATE '2024-05-31' ELSE d.valid_to END AS valid_to,
    CASE WHEN d.is_current AND d.customer_id IN (SELECT customer_id FROM scd2_changed)
         THEN FALSE ELSE d.is_current END AS is_current
  FROM dim_customers d),
scd2_new AS (
  SELECT s.customer_id, s.name, s.city, s.birthday, DATE '2024-06-01' AS valid_from,
         DATE '9999-12-31' AS valid_to, TRUE AS is_current
  FROM stg_delta s
  WHERE NOT EXISTS (SELECT 1 FROM dim_customers d WHERE d.customer_id = s.customer_id)),
scd2_fresh AS (
  SELECT 0 AS batch, customer_id, name, city, birthday FROM scd2_changed
  UNION ALL SELECT 1, customer_id, name, city, birthday FROM scd2_new),
scd2_apply AS (
  SELECT * FROM scd2_close
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY batch, customer_id NULLS LAST, name NULLS LAST, city NULLS LAST,
                                 birthday NULLS LAST)
              + (SELECT MAX(customer_key) FROM dim_customers) AS BIGINT) AS customer_key,
    customer_id, name, city, birthday, DATE '2024-06-01', DATE '9999-12-31', TRUE
  FROM scd2_fresh),
fct_sales AS (
  SELECT d.date_key, COALESCE(p.product_key, -1) AS product_key, COALESCE(s.store_key, -1) AS store_key,
    COALESCE(c.customer_key, 0) AS customer_key, t.check_id, t.quantity, t.unit_price,
    t.total_amount, t.discount_abs
  FROM stg_transactions t
  LEFT JOIN dim_date d ON d.full_date = CAST(t.transaction_datetime AS DATE)
  LEFT JOIN dim_products p ON p.product_id = t.product_id
  LEFT JOIN dim_stores s ON s.store_id = t.store_id
  LEFT JOIN dim_customers c ON t.customer_id = c.customer_id
       AND CAST(t.transaction_datetime AS DATE) BETWEEN c.valid_from AND c.valid_to),
lines AS (
  SELECT check_id, product_id, CAST(transaction_datetime AS DATE) AS sale_date FROM stg_transactions),
probes AS (
  SELECT DISTINCT product_id, sale_date FROM lines
  WHERE product_id IS NOT NULL AND sale_date IS NOT NULL)"""

_PREFIX = "WITH" + _RAW + "," + _STG + "," + _DIMS + "\n"


def _q(body: str) -> str:
    return _PREFIX + body


_STG_COLS = {
    "stg_transactions": "check_id, store_id, cashier_id, customer_id, transaction_datetime, product_id, "
                        "unit_price, quantity, total_amount, discount_abs, discount_pct, discount_type",
    "stg_products": "product_id, name, unit, category, current_retail_price",
    "stg_stores": "store_id, store_format, city, region",
    "stg_customers": "customer_id, name, city, birthday",
    "stg_pricing": "product_id, price, start_date, end_date, is_active",
    "stg_promo": "promo_type, product_id, discount_pct, start_date, end_date, is_active, description",
}


def _per_column(table_sql: str, prefix: str, tests: dict[str, str]) -> str:
    parts = [f"SELECT '{prefix}{c}' AS rule, CAST(COALESCE(SUM(CASE WHEN {t} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad FROM {table_sql}"
             for c, t in tests.items()]
    return "\nUNION ALL ".join(parts)


def _neg(c: str) -> str:
    return f"TRY_CAST(NULLIF(trim({c}), '') AS DECIMAL(38,10)) < 0"


def _unique(table_sql: str, keys: str, rule: str) -> str:
    return (f"SELECT '{rule}' AS rule, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_bad FROM "
            f"(SELECT COUNT(*) AS n FROM {table_sql} GROUP BY {keys} HAVING COUNT(*) > 1)")


def _fk(col: str, dim: str, pk: str) -> str:
    return (f"SELECT 'fct_sales.fk:{col}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_bad FROM fct_sales f "
            f"WHERE f.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{col})")


def _overlap(table: str, rule: str) -> str:
    return (f"SELECT '{rule}' AS rule, CAST(COALESCE(SUM(CASE WHEN prev_end >= start_date THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad "
            f"FROM (SELECT start_date, MAX(end_date) OVER (PARTITION BY product_id ORDER BY start_date, end_date, load_seq "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM {table} WHERE product_id IS NOT NULL)")


def _rejected(c: str, kind: str) -> str:
    text = f"NULLIF(trim({c}), '')"
    fmt = {"date": "%d-%m-%Y", "datetime": "%d-%m-%Y %H:%M"}.get(kind)
    typed = f"try_strptime({text}, '{fmt}')" if fmt else f"TRY_CAST({text} AS {kind})"
    return f"{text} IS NOT NULL AND {typed} IS NULL"


#: Each raw table's columns by type, and the mart's columns that are never NULL.
_TYPED = {
    "raw_stores": {"store_id": "int"},
    "raw_customers": {"customer_id": "bigint", "birthday": "date"},
    "raw_products": {"product_id": "int"},
    "raw_pricing": {"product_id": "int", "is_active": "int", "price": "decimal(10,2)", "start_date": "date",
                    "end_date": "date"},
    "raw_promo": {"promo_type": "int", "product_id": "int", "discount_pct": "int", "is_active": "int",
                  "start_date": "date", "end_date": "date"},
    "raw_check_summary": {"check_id": "bigint", "customer_id": "bigint", "store_id": "int", "cashier_id": "int",
                          "datetime": "datetime"},
    "raw_check_details": {"check_id": "bigint", "product_id": "int", "discount_pct": "int", "discount_type": "int",
                          "unit_price": "decimal(18,4)", "quantity": "decimal(18,4)",
                          "total_amount": "decimal(18,4)", "discount_abs": "decimal(18,4)"},
}
_PRESENT = {
    "dim_date": ["date_key", "full_date", "day_of_week_num", "month_number", "quarter", "year"],
    "dim_products": ["product_key", "product_id"],
    "dim_stores": ["store_key", "store_id"],
    "dim_customers": ["customer_key", "valid_from", "valid_to", "is_current"],
    "fct_sales": ["date_key", "product_key", "store_key", "customer_key"],
}


_ROW_ID = {
    "raw_stores": "store_id", "raw_customers": "customer_id", "raw_products": "product_id",
    "raw_pricing": "product_id, start_date, end_date", "raw_promo": "product_id, promo_type, start_date, end_date",
    "raw_check_summary": "check_id", "raw_check_details": "check_id, product_id",
    "stg_pricing": "product_id, start_date, end_date", "stg_promo": "product_id, promo_type, start_date, end_date",
    "stg_transactions": "check_id, product_id", "dim_date": "date_key", "dim_products": "product_key",
    "dim_stores": "store_key", "dim_customers": "customer_key", "fct_sales": "check_id, product_key",
}


def _bad(table: str, rule: str, test: str, value: str, source: str | None = None) -> str:
    ids = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _ROW_ID[table].split(", "))
    return (f"SELECT '{table}.{rule}' AS rule, '{table}' AS \"table\", {ids} AS row_id, CAST({value} AS VARCHAR) AS value "
            f"FROM {source or table} WHERE {test}")


def _twice(table: str, rule: str, key: str, where: str = "TRUE") -> str:
    return _bad(table, f"{rule}:{key}", "n_same > 1", key,
                f"(SELECT *, COUNT(*) OVER (PARTITION BY {key}) AS n_same FROM {table} WHERE {where})")


_BAD_RAW = "\nUNION ALL ".join([
    *(_bad(t, f"negative:{c}", _neg(c), c) for t, cols in (
        ("raw_check_details", ["unit_price", "quantity", "total_amount", "discount_abs"]), ("raw_promo", ["discount_pct"])) for c in cols),
    *(_bad(t, f"too_long:{c}", f"length({c}) > {n}", c) for t, lens in RAW_LENGTHS.items() for c, n in lens.items()),
    *(_bad(t, f"rejected:{c}", _rejected(c, kind), c) for t, cols in _TYPED.items() for c, kind in cols.items()),
    _bad("raw_check_details", "no_header", "NOT EXISTS (SELECT 1 FROM raw_check_summary s WHERE rtrim(s.check_id) = rtrim(d.check_id))",
         "rtrim(check_id)", "raw_check_details d"),
    "SELECT DISTINCT 'raw_check_summary.no_lines', 'raw_check_summary', rtrim(s.check_id), rtrim(s.check_id) FROM raw_check_summary s "
    "WHERE NOT EXISTS (SELECT 1 FROM raw_check_details d WHERE rtrim(d.check_id) = rtrim(s.check_id))",
])
_EARLIER = ("(SELECT *, MAX(end_date) OVER (PARTITION BY product_id ORDER BY start_date, end_date, load_seq "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM {t} WHERE product_id IS NOT NULL)")
_SOLD = ("(SELECT t.*, h.promo_type AS t_type, h.discount_pct AS t_pct FROM stg_transactions t LEFT JOIN ("
         "SELECT pr.product_id, pr.sale_date, arg_min(p.promo_type, p.load_seq) AS promo_type, arg_min(p.discount_pct, p.load_seq) AS discount_pct "
         "FROM probes pr JOIN stg_promo p ON p.product_id = pr.product_id AND pr.sale_date BETWEEN p.start_date AND p.end_date "
         "GROUP BY pr.product_id, pr.sale_date) h ON h.product_id = t.product_id AND h.sale_date = CAST(t.transaction_datetime AS DATE))")
_BAD_STAGING = "\nUNION ALL ".join([
    _twice("stg_pricing", "multi_active", "product_id", "is_active"),
    *(_bad(t, "overlap", "prev_end >= start_date", "prev_end", _EARLIER.format(t=t)) for t in ("stg_pricing", "stg_promo")),
    _bad("stg_transactions", "promo_mismatch", "discount_type NOT IN (0, 99) AND (t_type IS NULL OR t_type <> discount_type OR t_pct <> discount_pct)",
         "CAST(discount_type AS VARCHAR) || '/' || CAST(discount_pct AS VARCHAR)", _SOLD),
    _bad("stg_transactions", "total_mismatch", "abs(total_amount - CAST(greatest(round(unit_price * quantity - COALESCE(discount_abs, 0), 2), 0) "
         "AS DECIMAL(18,2))) > 0.01", "total_amount"),
])
_BAD_MART = "\nUNION ALL ".join([
    *(_twice(t, "unique", c) for t, c in (("dim_date", "date_key"), ("dim_products", "product_key"), ("dim_products", "product_id"),
                                          ("dim_stores", "store_key"), ("dim_stores", "store_id"), ("dim_customers", "customer_key"))),
    _twice("dim_customers", "one_current", "customer_id", "is_current AND customer_id IS NOT NULL"),
    *(_bad(t, f"not_null:{c}", f"{c} IS NULL", f"'{c}'") for t, cols in _PRESENT.items() for c in cols),
    *(_bad("fct_sales", f"fk:{c}", f"{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d} WHERE {d}.{c} = f.{c})", c, "fct_sales f")
      for c, d in (("date_key", "dim_date"), ("product_key", "dim_products"), ("store_key", "dim_stores"), ("customer_key", "dim_customers"))),
])


ORACLE: dict[str, str] = {
    **{name: _q(f"SELECT {cols} FROM {name}") for name, cols in _STG_COLS.items()},
    "stg_transactions_csv": _q(f"SELECT {_STG_COLS['stg_transactions']} FROM stg_transactions"),
    "dim_date": _q("SELECT * FROM dim_date"),
    "dim_products": _q("SELECT * FROM dim_products"),
    "dim_stores": _q("SELECT * FROM dim_stores"),
    "upsert_members": _q(
        "SELECT * FROM dim_stores WHERE NOT (store_key % 10 = 0 OR store_key = -1)\n"
        "UNION ALL SELECT store_key, store_id, format, upper(city) AS city, region FROM dim_stores "
        "WHERE store_key % 10 = 0 OR store_key = -1"),
    "first_purchase": _q("SELECT * FROM first_purchase"),
    "scd2_init": _q("SELECT * FROM scd2_init"),
    "scd2_split": _q("SELECT * FROM scd2_split"),
    "dim_customers": _q("SELECT * FROM dim_customers"),
    "hash_sample": _q("SELECT * FROM stg_customers WHERE customer_id IS NOT NULL "
                      f"AND CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 15) AS BIGINT) < {int(0.3 * 2**60)}"),
    "hash_sample_all": _q("SELECT * FROM stg_customers WHERE customer_id IS NOT NULL"),
    "exact_sample": _q(
        "SELECT customer_id, name, city, birthday FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY "
        "CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 15) AS BIGINT), customer_id, name NULLS FIRST, city NULLS FIRST, "
        "birthday NULLS FIRST) AS place, COUNT(*) OVER () AS n FROM stg_customers WHERE customer_id IS NOT NULL) "
        "WHERE place <= floor(0.3 * n + 0.5)"),
    "fact_by_year": _q("SELECT * FROM fct_sales"),
    "append_batches": _q("SELECT customer_id, name, city, birthday, 'load' || CAST(COALESCE(customer_id % 3, 0) AS VARCHAR) AS batch "
                         "FROM stg_customers"),
    "contract_write": _q("SELECT * FROM dim_customers"),
    "scd2_changed": _q("SELECT * FROM scd2_changed"),
    "scd2_changed_ci": _q(
        "SELECT s.customer_id, s.name, s.city, s.birthday FROM stg_delta s "
        "JOIN dim_customers d ON s.customer_id = d.customer_id AND d.is_current "
        "WHERE lower(COALESCE(s.city, '')) <> lower(COALESCE(d.city, ''))"),
    "scd2_close": _q("SELECT * FROM scd2_close"),
    "load_report": _q("\nUNION ALL ".join(
        f"SELECT '{t}' AS feed, COUNT(*) AS n_rows FROM {t}" for t in RAW_LENGTHS)),
    "warehouse_pipeline": _q("SELECT * FROM fct_sales"),
    "scd2_new": _q("SELECT * FROM scd2_new"),
    "scd2_apply": _q("SELECT * FROM scd2_apply"),
    "scd2_apply_bucketed": _q("SELECT * FROM scd2_apply"),
    "line_checks": "SELECT l_orderkey, l_linenumber, CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '1997-06-01') AS INTEGER) AS days, "
                   "CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS tax_ratio FROM lineitem",
    "fct_sales": _q("SELECT * FROM fct_sales"),
    "lookup_scd2": _q(
        "SELECT t.check_id, t.customer_id, CAST(t.transaction_datetime AS DATE) AS sale_date, "
        "COALESCE(c.customer_key, 0) AS customer_key FROM stg_transactions t "
        "LEFT JOIN dim_customers c ON t.customer_id = c.customer_id "
        "AND CAST(t.transaction_datetime AS DATE) BETWEEN c.valid_from AND c.valid_to"),
    "price_at": _q(
        ", hits AS (SELECT pr.product_id, pr.sale_date, arg_min(p.price, p.load_seq) AS price "
        "FROM probes pr JOIN stg_pricing p ON p.product_id = pr.product_id "
        "AND pr.sale_date BETWEEN p.start_date AND p.end_date GROUP BY pr.product_id, pr.sale_date),\n"
        "last AS (SELECT product_id, arg_max(price, load_seq) AS price FROM stg_pricing GROUP BY product_id)\n"
        "SELECT l.check_id, l.product_id, l.sale_date, "
        "CASE WHEN l.product_id IS NULL OR l.sale_date IS NULL THEN NULL "
        "ELSE COALESCE(h.price, la.price) END AS list_price "
        "FROM lines l LEFT JOIN hits h ON l.product_id = h.product_id AND l.sale_date = h.sale_date "
        "LEFT JOIN last la ON l.product_id = la.product_id").replace("\n, hits", "\n, hits", 1),
    "promo_at": _q(
        ", hits AS (SELECT pr.product_id, pr.sale_date, arg_min(p.promo_type, p.load_seq) AS promo_type, "
        "arg_min(p.discount_pct, p.load_seq) AS discount_pct "
        "FROM probes pr JOIN stg_promo p ON p.product_id = pr.product_id "
        "AND pr.sale_date BETWEEN p.start_date AND p.end_date GROUP BY pr.product_id, pr.sale_date)\n"
        "SELECT l.check_id, l.product_id, l.sale_date, h.promo_type AS promo_promo_type, "
        "h.discount_pct AS promo_discount_pct "
        "FROM lines l LEFT JOIN hits h ON l.product_id = h.product_id AND l.sale_date = h.sale_date"),
    "line_amounts": _q(
        ", a AS (SELECT check_id, product_id, unit_price, quantity, "
        "CAST(round(unit_price * quantity * discount_pct * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS d "
        "FROM stg_transactions)\n"
        "SELECT check_id, product_id, d AS calc_discount_abs, "
        "CAST(greatest(round(unit_price * quantity - d, 2), 0) AS DECIMAL(18,2)) AS calc_total FROM a"),
    "active_promo": _q(
        "SELECT product_id, promo_type, start_date, end_date, "
        "DATE '1997-06-01' BETWEEN start_date AND end_date AS active_on_day FROM stg_promo"),
    "fmt_dates": _q(
        "SELECT check_id, strftime(transaction_datetime, '%d-%m-%Y %H:%M') AS sale_text, "
        "strftime(CAST(transaction_datetime AS DATE), '%d-%m-%Y') AS day_text, "
        "CAST(CAST(total_amount AS DECIMAL(18,2)) AS VARCHAR) AS amount_text FROM stg_transactions"),
    "audit_unique": _q("\nUNION ALL ".join([
        _unique("dim_date", "date_key", "dim_date.unique:date_key"),
        _unique("dim_products", "product_key", "dim_products.unique:product_key"),
        _unique("dim_products", "product_id", "dim_products.unique:product_id"),
        _unique("dim_stores", "store_key", "dim_stores.unique:store_key"),
        _unique("dim_stores", "store_id", "dim_stores.unique:store_id"),
        _unique("dim_customers", "customer_key", "dim_customers.unique:customer_key"),
        _unique("(SELECT * FROM dim_customers WHERE is_current AND customer_id IS NOT NULL)",
                "customer_id", "dim_customers.one_current:customer_id"),
        _unique("(SELECT * FROM stg_pricing WHERE is_active)", "product_id",
                "stg_pricing.multi_active:product_id"),
    ])),
    "audit_not_null": _q("\nUNION ALL ".join([
        _per_column(t, f"{t}.not_null:", {c: f"{c} IS NULL" for c in cols}) for t, cols in _PRESENT.items()])),
    "audit_fk": _q("\nUNION ALL ".join([
        _fk("date_key", "dim_date", "date_key"),
        _fk("product_key", "dim_products", "product_key"),
        _fk("store_key", "dim_stores", "store_key"),
        _fk("customer_key", "dim_customers", "customer_key"),
    ])),
    "audit_negative": _q("\nUNION ALL ".join([
        _per_column("raw_check_details", "raw_check_details.negative:",
                    {c: _neg(c) for c in ["unit_price", "quantity", "total_amount", "discount_abs"]}),
        _per_column("raw_promo", "raw_promo.negative:", {"discount_pct": _neg("discount_pct")}),
    ])),
    "audit_overlap": _q("\nUNION ALL ".join([
        _overlap("stg_pricing", "stg_pricing.overlap"),
        _overlap("stg_promo", "stg_promo.overlap"),
    ])),
    "audit_length": _q("\nUNION ALL ".join([
        _per_column(t, f"{t}.too_long:", {c: f"length({c}) > {n}" for c, n in lens.items()})
        for t, lens in RAW_LENGTHS.items()])),
    "audit_rejects": _q("\nUNION ALL ".join([
        _per_column(t, f"{t}.rejected:", {c: _rejected(c, kind) for c, kind in cols.items()})
        for t, cols in _TYPED.items()])),
    "audit_promo": _q(
        ", pl AS (SELECT product_id, discount_pct, discount_type, CAST(transaction_datetime AS DATE) AS d "
        "FROM stg_transactions WHERE discount_type NOT IN (0, 99)),\n"
        "pp AS (SELECT DISTINCT product_id, d FROM pl WHERE product_id IS NOT NULL AND d IS NOT NULL),\n"
        "ph AS (SELECT pp.product_id, pp.d, arg_min(p.promo_type, p.load_seq) AS t, "
        "arg_min(p.discount_pct, p.load_seq) AS pct FROM pp JOIN stg_promo p ON p.product_id = pp.product_id "
        "AND pp.d BETWEEN p.start_date AND p.end_date GROUP BY pp.product_id, pp.d)\n"
        "SELECT 'stg_transactions.promo_mismatch' AS rule, CAST(COALESCE(SUM(CASE WHEN ph.t IS NULL "
        "OR ph.t <> pl.discount_type OR ph.pct <> pl.discount_pct THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad "
        "FROM pl LEFT JOIN ph ON pl.product_id = ph.product_id AND pl.d = ph.d"),
    "audit_total": _q(
        "SELECT 'stg_transactions.total_mismatch' AS rule, CAST(COALESCE(SUM(CASE WHEN abs(total_amount - "
        "CAST(greatest(round(unit_price * quantity - COALESCE(discount_abs, 0), 2), 0) AS DECIMAL(18,2))) > 0.01 "
        "THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad FROM stg_transactions"),
    "audit_orphans": _q(
        "SELECT 'raw_check_details.no_header' AS rule, CAST(COUNT(*) AS BIGINT) AS n_bad FROM raw_check_details d "
        "WHERE NOT EXISTS (SELECT 1 FROM raw_check_summary s WHERE rtrim(s.check_id) = rtrim(d.check_id))\n"
        "UNION ALL SELECT 'raw_check_summary.no_lines', CAST(COUNT(DISTINCT rtrim(s.check_id)) AS BIGINT) "
        "FROM raw_check_summary s "
        "WHERE NOT EXISTS (SELECT 1 FROM raw_check_details d WHERE rtrim(d.check_id) = rtrim(s.check_id))"),
    "bad_rows_raw": _q(_BAD_RAW),
    "bad_rows_staging": _q(_BAD_STAGING),
    "bad_rows_mart": _q(_BAD_MART),
    "flagship_sales": _q(
        "SELECT dd.year, dp.category, dc.city, CAST(COUNT(*) AS BIGINT) AS n_lines, "
        "CAST(SUM(f.quantity) AS DECIMAL(38,4)) AS total_qty, "
        "CAST(SUM(f.total_amount) AS DECIMAL(38,4)) AS total_amount "
        "FROM fct_sales f LEFT JOIN dim_date dd ON f.date_key = dd.date_key "
        "LEFT JOIN dim_products dp ON f.product_key = dp.product_key "
        "LEFT JOIN dim_customers dc ON f.customer_key = dc.customer_key "
        "GROUP BY dd.year, dp.category, dc.city"),
}
ORACLE["catalog_sales"] = ORACLE["flagship_sales"]
#: The audits' own counts, which the counts of the bad rows must equal.
ORACLE["bad_row_counts"] = _q("")[:-1] + ", " + ", ".join(
    f"a{i} AS ({sql[len(_PREFIX):]})" if not sql[len(_PREFIX):].startswith(",") else
    f"a{i} AS (WITH {sql[len(_PREFIX) + 1:].lstrip()})"
    for i, sql in enumerate(ORACLE[k] for k in ORACLE if k.startswith("audit_"))) + "\n" + "\nUNION ALL ".join(
    f"SELECT rule, n_bad FROM a{i}" for i in range(sum(k.startswith("audit_") for k in ORACLE)))
