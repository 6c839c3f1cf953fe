"""The test-table adapters again, as DuckDB SQL (for ``oracle_sql``).

Independent text for the same definitions as ``adapters``: the oracle runs
these CTEs on the driver's views, our queries run the DataFrame versions.
"""

from __future__ import annotations

from nightshift.sources import adapters as A

EPOCH = f"DATE '{A.EPOCH.isoformat()}'"
BDATE = f"DATE '{A.BATCH.date.isoformat()}'"
PDATE = f"DATE '{A.PREV_BATCH.date.isoformat()}'"
BNO = f"CAST({A.BATCH.no} AS INTEGER)"
PNO = f"CAST({A.PREV_BATCH.no} AS INTEGER)"
RUN_TS = f"TIMESTAMP '{A.BATCH.run_ts:%Y-%m-%d %H:%M:%S}'"
PREV_RUN_TS = f"TIMESTAMP '{A.PREV_BATCH.run_ts:%Y-%m-%d %H:%M:%S}'"
END_TS = f"TIMESTAMP '{A.END_TS:%Y-%m-%d %H:%M:%S}'"
BDAY = A.BATCH_DAY


def d(n: str) -> str:
    return f"({EPOCH} + CAST(({n}) AS INTEGER))"


def at(date: str, hours: int) -> str:
    return f"(CAST({date} AS TIMESTAMP) + INTERVAL {hours} HOUR)"


def cday(k: str, rule) -> str:
    return f"(({k}) * {rule[0]} % 2400)"


def uday(k: str, rule) -> str:
    return f"({cday(k, rule)} + ({k}) * {rule[1]} % {rule[2]})"


M = "DECIMAL(12,2)"

SRC = {
    "customers": f"""
  SELECT c_custkey AS customernumber, c_name AS customername,
    c_mktsegment AS contactlastname,
    'Contact ' || CAST(c_custkey AS VARCHAR) AS contactfirstname,
    CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS phone,
    'Street ' || CAST(c_custkey AS VARCHAR) AS addressline1,
    CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
         ELSE ' Suite ' || CAST(c_custkey AS VARCHAR) || ' ' END AS addressline2,
    'City ' || CAST(c_nationkey AS VARCHAR) AS city,
    CAST(NULL AS VARCHAR) AS state,
    CAST(c_custkey + 10000 AS VARCHAR) AS postalcode,
    'N' || CAST(c_nationkey AS VARCHAR) AS country,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS salesrepemployeenumber,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS {M}) END AS creditlimit,
    {at(d(cday('c_custkey', A.CUSTOMER_DAYS)), 9)} AS create_timestamp,
    {at(d(uday('c_custkey', A.CUSTOMER_DAYS)), 17)} AS update_timestamp
  FROM customer""",
    "employees": f"""
  SELECT s_suppkey AS employeenumber, s_name AS lastname,
    'E' || CAST(s_suppkey AS VARCHAR) AS firstname,
    'x' || CAST(s_suppkey + 100 AS VARCHAR) AS extension,
    'e' || CAST(s_suppkey AS VARCHAR) || '@example.com' AS email,
    CASE WHEN s_suppkey % 3 = 1 THEN '{A.UNKNOWN_OFFICE}' ELSE CAST(s_nationkey AS VARCHAR) END AS officecode,
    CASE WHEN s_suppkey = 0 OR s_suppkey % 4 = 2 THEN NULL ELSE s_suppkey // 10 END AS reportsto,
    CASE WHEN s_suppkey < 10 THEN 'Sales Manager' ELSE 'Sales Rep' END AS jobtitle,
    {at(d(cday('s_suppkey', A.EMPLOYEE_DAYS)), 9)} AS create_timestamp,
    {at(d(uday('s_suppkey', A.EMPLOYEE_DAYS)), 17)} AS update_timestamp
  FROM supplier""",
    "offices": f"""
  SELECT CAST(n_nationkey AS VARCHAR) AS officecode, n_name AS city,
    '+1 ' || CAST(n_nationkey AS VARCHAR) AS phone,
    'Office ' || CAST(n_nationkey AS VARCHAR) AS addressline1,
    CAST(NULL AS VARCHAR) AS addressline2, CAST(NULL AS VARCHAR) AS state,
    n_name AS country, CAST(n_nationkey + 1000 AS VARCHAR) AS postalcode,
    r_name AS territory,
    {at(d(f"CASE WHEN n_nationkey >= {A.NEW_OFFICE_FROM} THEN {BDAY + 3} ELSE n_nationkey * 3 END"), 9)} AS create_timestamp,
    {at(d(f"CASE WHEN n_nationkey % 5 = 0 THEN {BDAY + 1} WHEN n_nationkey >= {A.NEW_OFFICE_FROM} THEN {BDAY + 3} ELSE n_nationkey * 3 END"), 17)} AS update_timestamp
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "productlines": f"""
  SELECT productline, 'Line ' || productline AS textdescription,
    '<b>' || productline || '</b>' AS htmldescription,
    CAST(NULL AS VARCHAR) AS image,
    {at(EPOCH, 6)} AS create_timestamp,
    {at(f"CASE WHEN length(productline) = 5 THEN {d(str(BDAY + 1))} ELSE {EPOCH} END", 7)} AS update_timestamp
  FROM (SELECT DISTINCT p_type AS productline FROM part) t""",
    "products": f"""
  SELECT CAST(p_partkey AS VARCHAR) AS productcode, p_name AS productname,
    p_type AS productline, '1:' || CAST(p_size AS VARCHAR) AS productscale,
    p_brand AS productvendor, p_name || ' by ' || p_brand AS productdescription,
    CAST(p_size * 10 AS INTEGER) AS quantityinstock,
    CAST(CAST(p_retailprice AS {M}) - 50 AS {M}) AS buyprice,
    CAST(p_retailprice AS {M}) AS msrp,
    {at(d(cday('p_partkey', A.PRODUCT_DAYS)), 9)} AS create_timestamp,
    {at(d(uday('p_partkey', A.PRODUCT_DAYS)), 17)} AS update_timestamp
  FROM part""",
    "orders": f"""
  SELECT ordernumber, orderdate, requireddate, shippeddate, status, comments,
    customernumber, cancelleddate,
    {at('orderdate', 8)} AS create_timestamp,
    {at('greatest(orderdate, coalesce(shippeddate, orderdate), coalesce(cancelleddate, orderdate))', 18)} AS update_timestamp
  FROM (
    SELECT o_orderkey AS ordernumber, CAST(o_orderdate AS DATE) AS orderdate,
      CAST(o_orderdate AS DATE) + 10 AS requireddate,
      CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER) END AS shippeddate,
      CASE WHEN o_orderstatus = 'F' THEN ' Shipped'
           WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'CANCELLED '
           ELSE 'In Process' END AS status,
      o_orderpriority AS comments, o_custkey AS customernumber,
      CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) END AS cancelleddate
    FROM orders) o""",
    "orderdetails": f"""
  SELECT l.l_orderkey AS ordernumber, CAST(l.l_partkey AS VARCHAR) AS productcode,
    l.quantityordered, l.priceeach, l.orderlinenumber,
    o.create_timestamp, o.update_timestamp
  FROM (SELECT l_orderkey, l_partkey, CAST(SUM(l_quantity) AS INTEGER) AS quantityordered,
               CAST(MAX(l_extendedprice) AS {M}) AS priceeach,
               MIN(l_linenumber) AS orderlinenumber
        FROM lineitem GROUP BY l_orderkey, l_partkey) l
  JOIN src_orders o ON o.ordernumber = l.l_orderkey""",
    "payments": f"""
  SELECT customernumber, checknumber, paymentdate, amount,
    {at('paymentdate', 12)} AS create_timestamp,
    {at('paymentdate + CAST(k % 45 AS INTEGER)', 12)} AS update_timestamp
  FROM (SELECT o_orderkey AS k, o_custkey AS customernumber,
               'CHK' || CAST(o_orderkey AS VARCHAR) AS checknumber,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 AS INTEGER) AS paymentdate,
               CAST(o_totalprice AS {M}) AS amount
        FROM orders) p""",
}

CHANGED = f"CAST(update_timestamp AS DATE) >= {BDATE}"
CREATED_BEFORE = f"CAST(create_timestamp AS DATE) < {BDATE}"
PREV_AUDIT = f"""create_timestamp AS src_create_timestamp,
    CASE WHEN {CHANGED} THEN create_timestamp ELSE update_timestamp END AS src_update_timestamp,
    create_timestamp AS dw_create_timestamp,
    CASE WHEN {CHANGED} THEN create_timestamp ELSE update_timestamp END AS dw_update_timestamp,
    {PNO} AS etl_batch_no, {PDATE} AS etl_batch_date"""
CUR_AUDIT = f"""create_timestamp AS src_create_timestamp, update_timestamp AS src_update_timestamp,
    create_timestamp AS dw_create_timestamp, update_timestamp AS dw_update_timestamp,
    {BNO} AS etl_batch_no, {BDATE} AS etl_batch_date"""


def _known(col: str, rule) -> str:
    """The parent's creation date falls before the batch date."""
    return f"({d(cday(col, rule))} < {BDATE})"


PREV = {
    "offices": f"""
  SELECT CAST(officecode AS BIGINT) + 1 AS dw_office_id, officecode, city, phone,
    addressline1, addressline2, state, country, postalcode,
    CASE WHEN {CHANGED} THEN 'UNASSIGNED' ELSE territory END AS territory,
    {PREV_AUDIT}
  FROM src_offices WHERE {CREATED_BEFORE}""",
    "employees": f"""
  SELECT employeenumber + 1 AS dw_employee_id, employeenumber, lastname, firstname,
    extension, email, officecode, reportsto,
    CASE WHEN {CHANGED} THEN 'Trainee' ELSE jobtitle END AS jobtitle,
    CASE WHEN CAST(officecode AS INTEGER) < {A.NEW_OFFICE_FROM} THEN CAST(officecode AS BIGINT) + 1 END AS dw_office_id,
    CASE WHEN {_known('reportsto', A.EMPLOYEE_DAYS)} THEN reportsto + 1 END AS dw_reporting_employee_id,
    {PREV_AUDIT}
  FROM src_employees WHERE {CREATED_BEFORE}""",
    "customers": f"""
  SELECT customernumber + 1 AS dw_customer_id, customernumber AS src_customernumber,
    CASE WHEN {CHANGED} THEN customername || ' (old)' ELSE customername END AS customername,
    contactlastname, contactfirstname, phone, addressline1,
    CASE WHEN trim(addressline2) = '' THEN NULL ELSE addressline2 END AS addressline2,
    city, state, postalcode, country, salesrepemployeenumber,
    CASE WHEN NOT ({CHANGED}) THEN creditlimit
         WHEN customernumber % 3 = 0 THEN creditlimit
         WHEN customernumber % 3 = 1 THEN CAST(coalesce(creditlimit, 0) - 100 AS {M})
         ELSE CAST(NULL AS {M}) END AS creditlimit,
    {PREV_AUDIT}
  FROM src_customers WHERE {CREATED_BEFORE}""",
    "productlines": f"""
  SELECT CAST(row_number() OVER (ORDER BY productline) AS BIGINT) AS dw_product_line_id,
    productline,
    CASE WHEN {CHANGED} THEN 'Line (draft)' ELSE textdescription END AS textdescription,
    htmldescription, image,
    {PREV_AUDIT}
  FROM src_productlines WHERE {CREATED_BEFORE}""",
    "products": f"""
  SELECT CAST(productcode AS BIGINT) + 1 AS dw_product_id, productcode AS src_productcode,
    productname, p.productline, productscale, productvendor, productdescription,
    quantityinstock, buyprice,
    CASE WHEN NOT ({CHANGED}) THEN msrp
         WHEN CAST(productcode AS BIGINT) % 3 = 0 THEN msrp
         WHEN CAST(productcode AS BIGINT) % 3 = 1 THEN CAST(msrp + 10 AS {M})
         ELSE CAST(NULL AS {M}) END AS msrp,
    pl.dw_product_line_id,
    {PREV_AUDIT}
  FROM src_products p LEFT JOIN prev_productlines pl ON p.productline = pl.productline
  WHERE {CREATED_BEFORE.replace('create_timestamp', 'p.create_timestamp')}""",
    "orders": f"""
  SELECT ordernumber + 1 AS dw_order_id, ordernumber AS src_ordernumber,
    orderdate, requireddate,
    CASE WHEN NOT ({CHANGED}) THEN shippeddate END AS shippeddate,
    CASE WHEN {CHANGED} THEN 'In Process' ELSE status END AS status,
    comments, customernumber AS src_customernumber,
    CASE WHEN NOT ({CHANGED}) THEN cancelleddate END AS cancelleddate,
    customernumber + 1 AS dw_customer_id,
    {PREV_AUDIT}
  FROM src_orders WHERE {CREATED_BEFORE} AND {_known('customernumber', A.CUSTOMER_DAYS)}""",
    "orderdetails": f"""
  SELECT ordernumber + 1 AS dw_order_id, CAST(productcode AS BIGINT) + 1 AS dw_product_id,
    ordernumber AS src_ordernumber, productcode AS src_productcode,
    quantityordered, priceeach, orderlinenumber,
    {PREV_AUDIT}
  FROM src_orderdetails
  WHERE ordernumber IN (SELECT src_ordernumber FROM prev_orders)
    AND {_known('CAST(productcode AS BIGINT)', A.PRODUCT_DAYS)}""",
    "payments": f"""
  SELECT customernumber + 1 AS dw_customer_id, customernumber AS src_customernumber,
    checknumber, paymentdate,
    CASE WHEN {CHANGED} THEN CAST(amount + 1 AS {M}) ELSE amount END AS amount,
    {PREV_AUDIT}
  FROM src_payments WHERE {CREATED_BEFORE} AND {_known('customernumber', A.CUSTOMER_DAYS)}""",
}

CUR = {
    "customers": f"""
  SELECT customernumber + 1 AS dw_customer_id, customernumber AS src_customernumber,
    customername, contactlastname, contactfirstname, phone, addressline1,
    CASE WHEN trim(addressline2) = '' THEN NULL ELSE addressline2 END AS addressline2,
    city, state, postalcode, country, salesrepemployeenumber, creditlimit,
    {CUR_AUDIT}
  FROM src_customers""",
    "products": f"""
  SELECT CAST(productcode AS BIGINT) + 1 AS dw_product_id, productcode AS src_productcode,
    productname, productline, productscale, productvendor, productdescription,
    quantityinstock, buyprice, msrp,
    {CUR_AUDIT}
  FROM src_products""",
    "orders": f"""
  SELECT ordernumber + 1 AS dw_order_id, ordernumber AS src_ordernumber,
    orderdate, requireddate, shippeddate, status, comments,
    customernumber AS src_customernumber, cancelleddate,
    customernumber + 1 AS dw_customer_id,
    {CUR_AUDIT}
  FROM src_orders""",
    "orderdetails": f"""
  SELECT ordernumber + 1 AS dw_order_id, CAST(productcode AS BIGINT) + 1 AS dw_product_id,
    ordernumber AS src_ordernumber, productcode AS src_productcode,
    quantityordered, priceeach, orderlinenumber,
    {CUR_AUDIT}
  FROM src_orderdetails""",
    "payments": f"""
  SELECT customernumber + 1 AS dw_customer_id, customernumber AS src_customernumber,
    checknumber, paymentdate, amount,
    {CUR_AUDIT}
  FROM src_payments""",
}


def with_fixtures(extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause defining every adapter view (plus ``extra`` CTEs)."""
    ctes = [(f"src_{t}", q) for t, q in SRC.items()]
    ctes += [(f"prev_{t}", q) for t, q in PREV.items()]
    ctes += [(f"cur_{t}", q) for t, q in CUR.items()]
    ctes += extra or []
    return "WITH " + ",\n".join(f"{name} AS ({body}\n)" for name, body in ctes)
