"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the DataFrame code: plain joins, GROUP BYs and
UNION ALLs over the adapter CTEs of ``sources.fixture_sql``.  Money is
summed exactly as DECIMAL and returned as DOUBLE; counts as BIGINT; flags
as INTEGER, matching the DataFrame queries after ``as_compared``.
"""

from __future__ import annotations

from nightshift.schemas import DAILY_CUSTOMER_MEASURES, DAILY_PRODUCT_MEASURES
from nightshift.sources.fixture_sql import (
    BDATE, BNO, PDATE, PNO, RUN_TS, with_fixtures,
)

DEC = "DECIMAL(38,2)"


def sql_type(name: str) -> str:
    if name.endswith("_apd") or name.endswith("_apm"):
        return "INTEGER"
    if name.endswith("_amount"):
        return DEC
    return "BIGINT"


def out_type(name: str) -> str:
    return "DOUBLE" if sql_type(name) == DEC else sql_type(name)


def padded(measures, own: dict[str, str]) -> str:
    """Select list: own measures cast to their type, the rest zero."""
    cols = []
    for name, _ in measures:
        expr = own.get(name, "0")
        cols.append(f"CAST({expr} AS {sql_type(name)}) AS {name}")
    return ", ".join(cols)


def finish(measures, key: str, src: str, bno: str = BNO, bdate: str = BDATE,
           ts: str = RUN_TS) -> str:
    aggs = []
    for name, kind in measures:
        fn = "SUM" if kind == "sum" else "MAX"
        aggs.append(f"CAST({fn}({name}) AS {out_type(name)}) AS {name}")
    return f"""SELECT summary_date, {key}, {', '.join(aggs)},
  {ts} AS dw_create_timestamp, {ts} AS dw_update_timestamp,
  {bno} AS etl_batch_no, {bdate} AS etl_batch_date
FROM {src} GROUP BY summary_date, {key}"""


def daily_customer_ctes(cut: str = BDATE, tag: str = "dc") -> list[tuple[str, str]]:
    """One CTE per branch of the daily customer summary, plus their union."""
    M = DAILY_CUSTOMER_MEASURES
    lines = f"""cur_orders o JOIN cur_orderdetails od ON od.dw_order_id = o.dw_order_id"""
    branches = {
        "new": f"""SELECT summary_date, dw_customer_id, {padded(M, {'new_customer_apd': '1'})}
  FROM (SELECT DISTINCT CAST(src_create_timestamp AS DATE) AS summary_date, dw_customer_id
        FROM cur_customers WHERE CAST(src_create_timestamp AS DATE) >= {cut}) x""",
        "ordered": f"""SELECT summary_date, dw_customer_id, {padded(M, {
            'order_count': 'n', 'order_apd': '1', 'order_cost_amount': 'cost',
            'products_ordered_qty': 'qty', 'products_items_qty': 'items',
            'order_mrp_amount': 'mrp'})}
  FROM (SELECT o.orderdate AS summary_date, o.dw_customer_id,
          COUNT(DISTINCT o.dw_order_id) AS n,
          SUM(od.quantityordered * od.priceeach) AS cost,
          SUM(od.quantityordered) AS qty,
          COUNT(DISTINCT od.dw_product_id) AS items,
          SUM(od.quantityordered * p.msrp) AS mrp
        FROM {lines} JOIN cur_products p ON p.dw_product_id = od.dw_product_id
        WHERE o.orderdate >= {cut}
        GROUP BY o.orderdate, o.dw_customer_id) x""",
    }
    for kind, col, word in (("cancelled", "cancelleddate", "cancelled"),
                            ("shipped", "shippeddate", "shipped")):
        branches[kind] = f"""SELECT summary_date, dw_customer_id, {padded(M, {
            f'{kind}_order_count': 'n', f'{kind}_order_amount': 'amount',
            f'{kind}_order_apd': '1'})}
  FROM (SELECT o.{col} AS summary_date, o.dw_customer_id,
          COUNT(DISTINCT o.dw_order_id) AS n,
          SUM(od.quantityordered * od.priceeach) AS amount
        FROM {lines}
        WHERE o.{col} IS NOT NULL AND o.{col} >= {cut} AND lower(trim(o.status)) = '{word}'
        GROUP BY o.{col}, o.dw_customer_id) x"""
    branches["paid"] = f"""SELECT summary_date, dw_customer_id, {padded(M, {
        'payment_apd': '1', 'payment_amount': 'amount', 'new_customer_paid_apd': 'first_flag'})}
  FROM (SELECT pm.paymentdate AS summary_date, pm.dw_customer_id,
          SUM(pm.amount) AS amount,
          MAX(CASE WHEN pm.paymentdate = f.first_day THEN 1 ELSE 0 END) AS first_flag
        FROM cur_payments pm
        JOIN (SELECT dw_customer_id, MIN(paymentdate) AS first_day FROM cur_payments
              WHERE paymentdate IS NOT NULL GROUP BY dw_customer_id) f
          ON f.dw_customer_id = pm.dw_customer_id
        WHERE pm.paymentdate IS NOT NULL AND pm.paymentdate >= {cut}
        GROUP BY pm.paymentdate, pm.dw_customer_id) x"""
    ctes = [(f"{tag}_{k}", v) for k, v in branches.items()]
    ctes.append((f"{tag}_all", "\n  UNION ALL ".join(f"SELECT * FROM {tag}_{k}" for k in branches)))
    return ctes


def daily_product_ctes(cut: str = BDATE, tag: str = "dp") -> list[tuple[str, str]]:
    M = DAILY_PRODUCT_MEASURES
    lines = """cur_orders o JOIN cur_orderdetails od ON od.dw_order_id = o.dw_order_id
        JOIN cur_products p ON p.dw_product_id = od.dw_product_id"""
    branches = {
        "ordered": f"""SELECT summary_date, dw_product_id, {padded(M, {
            'customer_apd': '1', 'product_cost_amount': 'cost', 'product_mrp_amount': 'mrp'})}
  FROM (SELECT o.orderdate AS summary_date, p.dw_product_id,
          SUM(od.quantityordered * od.priceeach) AS cost,
          SUM(od.quantityordered * p.msrp) AS mrp
        FROM {lines} WHERE o.orderdate >= {cut}
        GROUP BY o.orderdate, p.dw_product_id) x""",
        "cancelled": f"""SELECT summary_date, dw_product_id, {padded(M, {
            'customer_apd': '1', 'cancelled_product_qty': 'qty', 'cancelled_cost_amount': 'cost',
            'cancelled_mrp_amount': 'mrp', 'cancelled_order_apd': '1'})}
  FROM (SELECT o.cancelleddate AS summary_date, p.dw_product_id,
          SUM(od.quantityordered) AS qty,
          SUM(od.quantityordered * od.priceeach) AS cost,
          SUM(od.quantityordered * p.msrp) AS mrp
        FROM {lines} WHERE o.cancelleddate IS NOT NULL AND o.cancelleddate >= {cut}
        GROUP BY o.cancelleddate, p.dw_product_id) x""",
    }
    ctes = [(f"{tag}_{k}", v) for k, v in branches.items()]
    ctes.append((f"{tag}_all", "\n  UNION ALL ".join(f"SELECT * FROM {tag}_{k}" for k in branches)))
    return ctes


def branch_select(measures, src: str, key: str) -> str:
    """A single branch, amounts as DOUBLE (for the per-branch queries)."""
    cols = [f"CAST({n} AS {out_type(n)}) AS {n}" for n, _ in measures]
    return f"SELECT summary_date, {key}, {', '.join(cols)} FROM {src}"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    dc = daily_customer_ctes()
    dp = daily_product_ctes()
    q["daily_customer_summary"] = with_fixtures(dc) + "\n" + finish(
        DAILY_CUSTOMER_MEASURES, "dw_customer_id", "dc_all")
    q["daily_product_summary"] = with_fixtures(dp) + "\n" + finish(
        DAILY_PRODUCT_MEASURES, "dw_product_id", "dp_all")
    for b in ("new", "ordered", "cancelled", "shipped", "paid"):
        q[f"daily_customer_{b}"] = with_fixtures(dc) + "\n" + branch_select(
            DAILY_CUSTOMER_MEASURES, f"dc_{b}", "dw_customer_id")
    for b in ("ordered", "cancelled"):
        q[f"daily_product_{b}"] = with_fixtures(dp) + "\n" + branch_select(
            DAILY_PRODUCT_MEASURES, f"dp_{b}", "dw_product_id")
    return q


# --- staged batches and type-1 merges -------------------------------------------

from pyspark.sql import types as _T  # noqa: E402

from nightshift.schemas import (  # noqa: E402
    SCD1_ORDER, SCD1_SPECS, SCD2_SPECS, SOURCE_SCHEMAS,
)
from nightshift.sources.fixture_sql import EPOCH, PREV_RUN_TS  # noqa: E402

MONEY_COLS = {"creditlimit", "buyprice", "msrp", "priceeach", "amount"}


def outcols(cols) -> str:
    """Final projection: exact money as DOUBLE, everything else as is."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY_COLS else c for c in cols)


def extract_sql(t: str) -> str:
    cols = ", ".join(f.name for f in SOURCE_SCHEMAS[t].fields)
    return f"SELECT {cols} FROM src_{t} WHERE CAST(update_timestamp AS DATE) >= {BDATE}"


def staged_sql(t: str) -> str:
    cols = []
    for f in SOURCE_SCHEMAS[t].fields:
        if isinstance(f.dataType, _T.StringType):
            cols.append(f"CASE WHEN trim({f.name}) = '' THEN NULL ELSE {f.name} END AS {f.name}")
        else:
            cols.append(f.name)
    return f"SELECT {', '.join(cols)} FROM ({extract_sql(t)}) e"


def merge_ctes(t: str) -> list[tuple[str, str]]:
    """st_<t> (staged), upd_<t> (target after the update), new_<t> (inserts)."""
    spec = SCD1_SPECS[t]
    attrs = dict((tc, sc) for sc, tc in spec.attrs)
    on_t = " AND ".join(f"t.{tc} = s.{sc}" for sc, tc in spec.keys)
    hit = f"s.{spec.keys[0][0]} IS NOT NULL"
    upd = []
    for c in spec.columns:
        if c in attrs:
            upd.append(f"CASE WHEN {hit} THEN s.{attrs[c]} ELSE t.{c} END AS {c}")
        elif c == "src_update_timestamp":
            upd.append(f"CASE WHEN {hit} THEN s.update_timestamp ELSE t.{c} END AS {c}")
        elif c == "dw_update_timestamp":
            upd.append(f"CASE WHEN {hit} THEN {RUN_TS} ELSE t.{c} END AS {c}")
        elif c == "etl_batch_no":
            upd.append(f"CASE WHEN {hit} THEN {BNO} ELSE t.{c} END AS {c}")
        elif c == "etl_batch_date":
            upd.append(f"CASE WHEN {hit} THEN {BDATE} ELSE t.{c} END AS {c}")
        else:
            upd.append(f"t.{c}")
    upd_sql = f"SELECT {', '.join(upd)} FROM prev_{t} t LEFT JOIN st_{t} s ON {on_t}"

    joins, conds = [], [f"t.{spec.keys[0][1]} IS NULL"]
    look = {}
    for i, lk in enumerate(spec.lookups):
        alias = f"p{i}"
        joins.append(f"LEFT JOIN prev_{lk.parent} {alias} ON s.{lk.stage_col} = {alias}.{lk.parent_key}")
        if lk.required:
            conds.append(f"{alias}.{lk.parent_id} IS NOT NULL")
        look[lk.target_col] = f"{alias}.{lk.parent_id}"
    keys = dict((tc, sc) for sc, tc in spec.keys)
    order = ", ".join(f"s.{sc}" for sc, _ in spec.keys)
    new = []
    for c in spec.columns:
        if c == spec.surrogate:
            new.append(f"(SELECT coalesce(max({c}), 0) FROM prev_{t}) + row_number() OVER (ORDER BY {order}) AS {c}")
        elif c in keys:
            new.append(f"s.{keys[c]} AS {c}")
        elif c in attrs:
            new.append(f"s.{attrs[c]} AS {c}")
        elif c in look:
            new.append(f"{look[c]} AS {c}")
        elif c == "src_create_timestamp":
            new.append(f"s.create_timestamp AS {c}")
        elif c == "src_update_timestamp":
            new.append(f"s.update_timestamp AS {c}")
        elif c in ("dw_create_timestamp", "dw_update_timestamp"):
            new.append(f"{RUN_TS} AS {c}")
        elif c == "etl_batch_no":
            new.append(f"{BNO} AS {c}")
        elif c == "etl_batch_date":
            new.append(f"{BDATE} AS {c}")
        else:
            raise KeyError(c)
    new_sql = (f"SELECT {', '.join(new)} FROM st_{t} s LEFT JOIN prev_{t} t ON {on_t} "
               f"{' '.join(joins)} WHERE {' AND '.join(conds)}")
    return [(f"st_{t}", staged_sql(t)), (f"upd_{t}", upd_sql), (f"new_{t}", new_sql)]


def all_merge_ctes() -> list[tuple[str, str]]:
    out = []
    for t in SCD1_ORDER:
        out += merge_ctes(t)
    return out


def build_merges(q: dict[str, str]) -> None:
    for t in SCD1_ORDER:
        cols = SCD1_SPECS[t].columns
        q[f"upsert_{t}"] = with_fixtures(merge_ctes(t)) + (
            f"\nSELECT {outcols(cols)} FROM (SELECT * FROM upd_{t} UNION ALL SELECT * FROM new_{t}) u")
    parts = []
    for t in SCD1_ORDER:
        spec = SCD1_SPECS[t]
        on = " AND ".join(f"t.{tc} = s.{sc}" for sc, tc in spec.keys)
        parts.append(
            f"SELECT '{t}' AS table_name,"
            f" (SELECT count(*) FROM prev_{t} t WHERE EXISTS (SELECT 1 FROM st_{t} s WHERE {on})) AS updated,"
            f" (SELECT count(*) FROM new_{t}) AS inserted")
    q["merge_counts"] = with_fixtures(all_merge_ctes()) + "\n" + "\nUNION ALL ".join(parts)
    q["surrogate_keys"] = with_fixtures(merge_ctes("customers")) + (
        "\nSELECT src_customernumber, dw_customer_id FROM new_customers")


# --- type-2 history -----------------------------------------------------------------

def history_ctes(name: str) -> list[tuple[str, str]]:
    spec = SCD2_SPECS[name]
    i, v, dim = spec.id_col, spec.tracked, spec.dim
    hist = f"""SELECT {i}, {v}, CAST(src_create_timestamp AS DATE) AS effective_from_date,
    CAST(NULL AS DATE) AS effective_to_date, 1 AS dw_active_record_ind,
    src_create_timestamp AS dw_create_timestamp, src_create_timestamp AS dw_update_timestamp,
    {PNO} AS create_etl_batch_no, CAST(src_create_timestamp AS DATE) AS create_etl_batch_date,
    CAST(NULL AS INTEGER) AS update_etl_batch_no, CAST(NULL AS DATE) AS update_etl_batch_date
  FROM prev_{dim}
  UNION ALL
  SELECT {i}, CAST({v} - 25 AS DECIMAL(12,2)), CAST(src_create_timestamp AS DATE) - 30,
    CAST(src_create_timestamp AS DATE) - 1, 0, src_create_timestamp, src_create_timestamp,
    {PNO}, CAST(src_create_timestamp AS DATE) - 30, {PNO}, CAST(src_create_timestamp AS DATE)
  FROM prev_{dim} WHERE {i} % 4 = 0"""
    close_ids = f"""SELECT DISTINCT a.{i} FROM cur_{dim} a JOIN h_{name} b ON a.{i} = b.{i}
  WHERE b.dw_active_record_ind = 1 AND a.{v} IS DISTINCT FROM b.{v}"""
    c = f"(h.dw_active_record_ind = 1 AND h.{i} IN (SELECT {i} FROM x_{name}))"
    closed = f"""SELECT h.{i}, h.{v}, h.effective_from_date,
    CASE WHEN {c} THEN {BDATE} - 1 ELSE h.effective_to_date END AS effective_to_date,
    CASE WHEN {c} THEN 0 ELSE h.dw_active_record_ind END AS dw_active_record_ind,
    h.dw_create_timestamp,
    CASE WHEN {c} THEN {RUN_TS} ELSE h.dw_update_timestamp END AS dw_update_timestamp,
    h.create_etl_batch_no, h.create_etl_batch_date,
    CASE WHEN {c} THEN {BNO} ELSE h.update_etl_batch_no END AS update_etl_batch_no,
    CASE WHEN {c} THEN {BDATE} ELSE h.update_etl_batch_date END AS update_etl_batch_date
  FROM h_{name} h"""
    opened = f"""SELECT a.{i}, a.{v}, {BDATE} AS effective_from_date,
    CAST(NULL AS DATE) AS effective_to_date, 1 AS dw_active_record_ind,
    {RUN_TS} AS dw_create_timestamp, {RUN_TS} AS dw_update_timestamp,
    {BNO} AS create_etl_batch_no, {BDATE} AS create_etl_batch_date,
    CAST(NULL AS INTEGER) AS update_etl_batch_no, CAST(NULL AS DATE) AS update_etl_batch_date
  FROM cur_{dim} a
  WHERE NOT EXISTS (SELECT 1 FROM c_{name} k WHERE k.{i} = a.{i} AND k.dw_active_record_ind = 1)"""
    return [(f"h_{name}", hist), (f"x_{name}", close_ids), (f"c_{name}", closed), (f"o_{name}", opened)]


def build_history(q: dict[str, str]) -> None:
    for name, short in (("customer_history", "customer"), ("product_history", "product")):
        spec = SCD2_SPECS[name]
        cols = [spec.id_col, spec.tracked, "effective_from_date", "effective_to_date",
                "dw_active_record_ind", "dw_create_timestamp", "dw_update_timestamp",
                "create_etl_batch_no", "create_etl_batch_date", "update_etl_batch_no",
                "update_etl_batch_date"]
        w = with_fixtures(history_ctes(name))
        q[f"scd2_{name}"] = w + (f"\nSELECT {outcols(cols)} FROM (SELECT * FROM c_{name} "
                                 f"UNION ALL SELECT * FROM o_{name}) u")
        q[f"scd2_close_{short}"] = w + f"\nSELECT {outcols(cols)} FROM c_{name} WHERE dw_active_record_ind = 0"
        q[f"scd2_open_{short}"] = w + f"\nSELECT {outcols(cols)} FROM o_{name}"


# --- monthly roll-forward -------------------------------------------------------------

def daily_table_ctes(kind: str) -> list[tuple[str, str]]:
    """The daily table after the batch: all days, exact amounts, restamped."""
    if kind == "customer":
        ctes, M, key, src = daily_customer_ctes(EPOCH, "fc"), DAILY_CUSTOMER_MEASURES, "dw_customer_id", "fc_all"
    else:
        ctes, M, key, src = daily_product_ctes(EPOCH, "fp"), DAILY_PRODUCT_MEASURES, "dw_product_id", "fp_all"
    aggs = ", ".join(f"CAST({'SUM' if k == 'sum' else 'MAX'}({n}) AS {sql_type(n)}) AS {n}" for n, k in M)
    old = f"summary_date < {BDATE}"
    table = f"""SELECT summary_date, {key}, {aggs},
    CASE WHEN {old} THEN {PREV_RUN_TS} ELSE {RUN_TS} END AS dw_create_timestamp,
    CASE WHEN {old} THEN {PREV_RUN_TS} ELSE {RUN_TS} END AS dw_update_timestamp,
    CASE WHEN {old} THEN {PNO} ELSE {BNO} END AS etl_batch_no,
    CASE WHEN {old} THEN {PDATE} ELSE {BDATE} END AS etl_batch_date
  FROM {src} GROUP BY summary_date, {key}"""
    return ctes + [(f"daily_{kind}", table)]


def monthly_ctes(kind: str) -> list[tuple[str, str]]:
    M, key = ((DAILY_CUSTOMER_MEASURES, "dw_customer_id") if kind == "customer"
              else (DAILY_PRODUCT_MEASURES, "dw_product_id"))
    mon = "CAST(date_trunc('month', summary_date) AS DATE)"

    def rollup(where: str, stamp: str | None) -> str:
        cols = []
        for n, k in M:
            if k == "sum":
                cols.append(f"CAST(SUM({n}) AS {sql_type(n)}) AS {n}")
            else:
                cols.append(f"MAX({n}) AS {n}")
                cols.append(f"MAX({n}) AS {n[:-4]}_apm")
        stamps = (f"{stamp} AS dw_create_timestamp, {stamp} AS dw_update_timestamp"
                  if stamp else "")
        sep = ", " if stamps else ""
        return (f"SELECT {mon} AS start_of_the_month_date, {key}, {', '.join(cols)}{sep}{stamps}, "
                f"MAX(etl_batch_no) AS etl_batch_no, MAX(etl_batch_date) AS etl_batch_date "
                f"FROM daily_{kind} WHERE {where} GROUP BY {mon}, {key}")

    prev = rollup(f"summary_date < {BDATE}", PREV_RUN_TS)
    delta = rollup(f"summary_date >= {BDATE}", None)
    hit = "d.start_of_the_month_date IS NOT NULL"
    cols = ["m.start_of_the_month_date", f"m.{key}"]
    for n, k in M:
        if k == "sum":
            cols.append(f"CASE WHEN {hit} THEN m.{n} + d.{n} ELSE m.{n} END AS {n}")
        else:
            apm = n[:-4] + "_apm"
            cols.append(f"CASE WHEN NOT ({hit}) THEN m.{n} WHEN m.{n} = 1 THEN 1 ELSE d.{n} END AS {n}")
            cols.append(f"CASE WHEN NOT ({hit}) THEN m.{apm} WHEN m.{apm} = 1 THEN 1 ELSE d.{n} END AS {apm}")
    cols += ["m.dw_create_timestamp",
             f"CASE WHEN {hit} THEN {RUN_TS} ELSE m.dw_update_timestamp END AS dw_update_timestamp",
             f"CASE WHEN {hit} THEN d.etl_batch_no ELSE m.etl_batch_no END AS etl_batch_no",
             f"CASE WHEN {hit} THEN d.etl_batch_date ELSE m.etl_batch_date END AS etl_batch_date"]
    updated = (f"SELECT {', '.join(cols)} FROM pm_{kind} m LEFT JOIN dm_{kind} d "
               f"ON d.start_of_the_month_date = m.start_of_the_month_date AND d.{key} = m.{key}")
    ins_cols = ["d.start_of_the_month_date", f"d.{key}"]
    for n, k in M:
        ins_cols.append(f"d.{n}")
        if k == "flag":
            ins_cols.append(f"d.{n[:-4]}_apm")
    ins_cols += [f"{RUN_TS} AS dw_create_timestamp", f"{RUN_TS} AS dw_update_timestamp",
                 "d.etl_batch_no", "d.etl_batch_date"]
    inserted = (f"SELECT {', '.join(ins_cols)} FROM dm_{kind} d WHERE NOT EXISTS (SELECT 1 FROM pm_{kind} m "
                f"WHERE m.start_of_the_month_date = d.start_of_the_month_date AND m.{key} = d.{key})")
    return daily_table_ctes(kind) + [(f"pm_{kind}", prev), (f"dm_{kind}", delta),
                                     (f"um_{kind}", updated), (f"im_{kind}", inserted)]


def monthly_out(kind: str) -> str:
    M, key = ((DAILY_CUSTOMER_MEASURES, "dw_customer_id") if kind == "customer"
              else (DAILY_PRODUCT_MEASURES, "dw_product_id"))
    cols = ["start_of_the_month_date", key]
    for n, k in M:
        cols.append(f"CAST({n} AS {out_type(n)}) AS {n}")
        if k == "flag":
            cols.append(f"CAST({n[:-4]}_apm AS INTEGER) AS {n[:-4]}_apm")
    cols += ["dw_create_timestamp", "dw_update_timestamp", "etl_batch_no", "etl_batch_date"]
    return ", ".join(cols)


def build_monthly(q: dict[str, str]) -> None:
    for kind in ("customer", "product"):
        w = with_fixtures(monthly_ctes(kind))
        sel = monthly_out(kind)
        q[f"monthly_{kind}_summary"] = w + (f"\nSELECT {sel} FROM (SELECT * FROM um_{kind} "
                                            f"UNION ALL SELECT * FROM im_{kind}) u")
        q[f"monthly_update_{kind}"] = w + f"\nSELECT {sel} FROM um_{kind} WHERE etl_batch_no = {BNO}"
        q[f"monthly_insert_{kind}"] = w + f"\nSELECT {sel} FROM im_{kind}"


_build_daily = build


def build() -> dict[str, str]:  # noqa: F811
    q = _build_daily()
    build_merges(q)
    build_history(q)
    build_monthly(q)
    return q


# --- A, B-H operator queries -------------------------------------------------------------

from nightshift.schemas import SOURCE_TABLES  # noqa: E402
from nightshift.sources.fixture_sql import END_TS  # noqa: E402


def _control_ctes() -> list[tuple[str, str]]:
    bc = f"""SELECT CAST(d - {EPOCH} + 1 AS INTEGER) AS etl_batch_no, d AS etl_batch_date
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x"""
    log0 = f"""SELECT etl_batch_no, etl_batch_date, 'S' AS etl_batch_status,
    CAST(etl_batch_date + 1 AS TIMESTAMP) + INTERVAL 2 HOUR AS etl_batch_start_time,
    CAST(etl_batch_date + 1 AS TIMESTAMP) + INTERVAL 3 HOUR AS etl_batch_end_time
  FROM bc WHERE etl_batch_date < (SELECT MAX(etl_batch_date) FROM bc)"""
    cur = "SELECT etl_batch_no, etl_batch_date FROM bc ORDER BY etl_batch_no DESC LIMIT 1"
    log1 = f"""SELECT * FROM log0 UNION ALL
  SELECT etl_batch_no, etl_batch_date, 'R', {RUN_TS}, CAST(NULL AS TIMESTAMP) FROM cur"""
    log2 = f"""SELECT l.etl_batch_no, l.etl_batch_date,
    CASE WHEN c.etl_batch_no IS NOT NULL THEN 'S' ELSE l.etl_batch_status END AS etl_batch_status,
    l.etl_batch_start_time,
    CASE WHEN c.etl_batch_no IS NOT NULL THEN {END_TS} ELSE l.etl_batch_end_time END AS etl_batch_end_time
  FROM log1 l LEFT JOIN cur c ON c.etl_batch_no = l.etl_batch_no AND c.etl_batch_date = l.etl_batch_date"""
    return [("bc", bc), ("log0", log0), ("cur", cur), ("log1", log1), ("log2", log2)]


def build_operators(q: dict[str, str]) -> None:
    W = with_fixtures
    for t in SOURCE_TABLES:
        cols = [f.name for f in SOURCE_SCHEMAS[t].fields]
        q[f"extract_incremental_{t}"] = W() + f"\nSELECT {outcols(cols)} FROM ({extract_sql(t)}) e"
        q[f"stage_load_{t}"] = W() + f"\nSELECT {outcols(cols)} FROM ({staged_sql(t)}) e"
    ccols = [f.name for f in SOURCE_SCHEMAS["customers"].fields]
    q["landing_roundtrip"] = W() + f"\nSELECT {outcols(ccols)} FROM ({extract_sql('customers')}) e"
    q["blanks_as_null"] = W() + f"""
SELECT customernumber, addressline2 AS addressline2_raw,
  CASE WHEN trim(addressline2) = '' THEN NULL ELSE addressline2 END AS addressline2
FROM ({extract_sql('customers')}) e"""
    ctl = W(_control_ctes())
    q["current_batch"] = ctl + "\nSELECT * FROM cur"
    q["batch_log_start"] = ctl + "\nSELECT * FROM log1"
    q["batch_log_end"] = ctl + "\nSELECT * FROM log2"

    hist = history_ctes("customer_history")
    q["null_safe_change_filter"] = W(hist) + """
SELECT a.dw_customer_id, CAST(a.creditlimit AS DOUBLE) AS creditlimit,
  CAST(b.creditlimit AS DOUBLE) AS previous_creditlimit
FROM cur_customers a JOIN h_customer_history b ON a.dw_customer_id = b.dw_customer_id
WHERE b.dw_active_record_ind = 1 AND a.creditlimit IS DISTINCT FROM b.creditlimit"""
    q["join_inner_orders_details"] = W() + """
SELECT o.dw_order_id, o.dw_customer_id, o.orderdate, d.dw_product_id, d.quantityordered,
  CAST(d.priceeach AS DOUBLE) AS priceeach
FROM cur_orders o JOIN cur_orderdetails d ON d.dw_order_id = o.dw_order_id"""
    q["join_inner_three_way"] = W() + """
SELECT o.dw_order_id, o.orderdate, d.dw_product_id, d.quantityordered,
  CAST(d.priceeach AS DOUBLE) AS priceeach, CAST(p.msrp AS DOUBLE) AS msrp
FROM cur_orders o JOIN cur_orderdetails d ON d.dw_order_id = o.dw_order_id
JOIN cur_products p ON p.dw_product_id = d.dw_product_id"""
    st = lambda t: [(f"st_{t}", staged_sql(t))]
    q["lookup_left_outer"] = W(st("employees")) + """
SELECT s.employeenumber, s.officecode, o.dw_office_id
FROM st_employees s LEFT JOIN prev_offices o ON s.officecode = o.officecode"""
    q["lookup_required"] = W(st("orders")) + """
SELECT s.ordernumber, s.customernumber, c.dw_customer_id
FROM st_orders s LEFT JOIN prev_customers c ON s.customernumber = c.src_customernumber
WHERE c.dw_customer_id IS NOT NULL"""
    q["anti_join_new_keys"] = W(st("customers")) + """
SELECT s.customernumber, s.customername
FROM st_customers s LEFT JOIN prev_customers d ON s.customernumber = d.src_customernumber
WHERE d.src_customernumber IS NULL"""
    q["anti_join_composite"] = W(st("orderdetails")) + """
SELECT s.ordernumber, s.productcode, s.quantityordered
FROM st_orderdetails s LEFT JOIN prev_orderdetails d
  ON s.ordernumber = d.src_ordernumber AND s.productcode = d.src_productcode
WHERE d.src_ordernumber IS NULL AND d.src_productcode IS NULL"""
    q["anti_join_month"] = W(monthly_ctes("customer")) + """
SELECT d.start_of_the_month_date, d.dw_customer_id FROM dm_customer d
LEFT JOIN pm_customer m ON m.start_of_the_month_date = d.start_of_the_month_date
  AND m.dw_customer_id = d.dw_customer_id
WHERE m.start_of_the_month_date IS NULL"""
    q["self_join_manager"] = W(st("employees")) + """
SELECT s.employeenumber, s.reportsto, r.dw_employee_id AS dw_reporting_employee_id
FROM st_employees s LEFT JOIN prev_employees r ON s.reportsto = r.employeenumber"""
    q["semi_join_changed"] = W(hist) + """
SELECT h.dw_customer_id, CAST(h.creditlimit AS DOUBLE) AS creditlimit, h.effective_from_date
FROM h_customer_history h WHERE h.dw_customer_id IN (SELECT dw_customer_id FROM x_customer_history)"""
    first = """(SELECT dw_customer_id, MIN(paymentdate) AS first_payment_date FROM cur_payments
        WHERE paymentdate IS NOT NULL GROUP BY dw_customer_id)"""
    q["first_payment_join"] = W() + f"""
SELECT p.dw_customer_id, p.checknumber, p.paymentdate, f.first_payment_date
FROM cur_payments p JOIN {first} f ON f.dw_customer_id = p.dw_customer_id"""
    q["agg_sum_product"] = W() + """
SELECT dw_order_id, CAST(SUM(quantityordered * priceeach) AS DOUBLE) AS order_amount,
  CAST(SUM(quantityordered) AS BIGINT) AS order_qty
FROM cur_orderdetails GROUP BY dw_order_id"""
    q["agg_count_distinct"] = W() + """
SELECT o.orderdate AS summary_date, o.dw_customer_id,
  COUNT(DISTINCT o.dw_order_id) AS order_count, COUNT(DISTINCT d.dw_product_id) AS products_items_qty
FROM cur_orders o JOIN cur_orderdetails d ON d.dw_order_id = o.dw_order_id
GROUP BY o.orderdate, o.dw_customer_id"""
    dc = daily_customer_ctes()
    daily_sql = finish(DAILY_CUSTOMER_MEASURES, "dw_customer_id", "dc_all")
    q["agg_max_flag"] = W(dc + [("dcs", daily_sql)]) + """
SELECT dw_customer_id, MAX(order_apd) AS order_apm, MAX(payment_apd) AS payment_apm,
  MAX(new_customer_apd) AS new_customer_apm
FROM dcs GROUP BY dw_customer_id"""
    q["agg_conditional_max"] = W() + f"""
SELECT p.paymentdate, p.dw_customer_id,
  MAX(CASE WHEN p.paymentdate = f.first_payment_date THEN 1 ELSE 0 END) AS new_customer_paid_apd
FROM cur_payments p JOIN {first} f ON f.dw_customer_id = p.dw_customer_id
GROUP BY p.paymentdate, p.dw_customer_id"""
    q["agg_group_by_month"] = W() + """
SELECT CAST(date_trunc('month', orderdate) AS DATE) AS start_of_the_month_date, dw_customer_id,
  COUNT(*) AS order_count
FROM cur_orders GROUP BY 1, 2"""
    q["group_by_distinct"] = W() + """
SELECT CAST(src_create_timestamp AS DATE) AS summary_date, dw_customer_id
FROM cur_customers GROUP BY 1, 2"""
    q["sorted_daily_output"] = W(dc) + "\n" + daily_sql + "\nORDER BY summary_date, dw_customer_id"
    q["union_all_branches"] = W(dc) + "\n" + branch_select(
        DAILY_CUSTOMER_MEASURES, "dc_all", "dw_customer_id")
    q["scalar_month_start"] = W() + """
SELECT dw_order_id, orderdate, CAST(date_trunc('month', orderdate) AS DATE) AS start_of_the_month_date
FROM cur_orders"""
    q["scalar_day_before"] = ctl + """
SELECT etl_batch_no, etl_batch_date, etl_batch_date - 1 AS effective_to_date FROM bc"""
    q["scalar_status_normalize"] = W() + """
SELECT dw_order_id, status, lower(trim(status)) AS status_normalized FROM cur_orders"""
    q["scalar_sticky_flag"] = W(monthly_ctes("customer")) + """
SELECT m.start_of_the_month_date, m.dw_customer_id, m.order_apm AS month_order_apm,
  d.order_apd AS day_order_apd,
  CASE WHEN m.order_apm = 1 THEN 1 ELSE d.order_apd END AS order_apm
FROM pm_customer m JOIN dm_customer d
  ON d.start_of_the_month_date = m.start_of_the_month_date AND d.dw_customer_id = m.dw_customer_id"""


_build_core = build


def build() -> dict[str, str]:  # noqa: F811
    q = _build_core()
    build_operators(q)
    return q


def build_extra(q: dict[str, str]) -> None:
    W = with_fixtures
    fc = daily_customer_ctes(EPOCH, "fc")
    fp = daily_product_ctes(EPOCH, "fp")
    # The backfill batch is dated at its cutoff, the epoch.
    q["daily_customer_summary_full"] = W(fc) + "\n" + finish(
        DAILY_CUSTOMER_MEASURES, "dw_customer_id", "fc_all", bdate=EPOCH)
    q["daily_product_summary_full"] = W(fp) + "\n" + finish(
        DAILY_PRODUCT_MEASURES, "dw_product_id", "fp_all", bdate=EPOCH)
    spec = SCD1_SPECS["customers"]
    cols = []
    for c in spec.columns:
        if c == "dw_customer_id":
            cols.append("row_number() OVER (ORDER BY customernumber) AS dw_customer_id")
        elif c == "src_customernumber":
            cols.append("customernumber AS src_customernumber")
        elif c == "src_create_timestamp":
            cols.append("create_timestamp AS src_create_timestamp")
        elif c == "src_update_timestamp":
            cols.append("update_timestamp AS src_update_timestamp")
        elif c in ("dw_create_timestamp", "dw_update_timestamp"):
            cols.append(f"{RUN_TS} AS {c}")
        elif c == "etl_batch_no":
            cols.append(f"{BNO} AS etl_batch_no")
        elif c == "etl_batch_date":
            cols.append(f"{BDATE} AS etl_batch_date")
        else:
            cols.append(c)
    staged_all = staged_sql("customers").replace(BDATE, EPOCH)
    q["upsert_first_load_customers"] = W([("fl", f"SELECT {', '.join(cols)} FROM ({staged_all}) s")]) + (
        f"\nSELECT {outcols(spec.columns)} FROM fl")
    hcols = ["dw_product_id", "msrp", "effective_from_date", "effective_to_date", "dw_active_record_ind",
             "dw_create_timestamp", "dw_update_timestamp", "create_etl_batch_no", "create_etl_batch_date",
             "update_etl_batch_no", "update_etl_batch_date"]
    q["scd2_first_load_product"] = W() + f"""
SELECT {outcols(hcols)} FROM (
  SELECT dw_product_id, msrp, {BDATE} AS effective_from_date, CAST(NULL AS DATE) AS effective_to_date,
    1 AS dw_active_record_ind, {RUN_TS} AS dw_create_timestamp, {RUN_TS} AS dw_update_timestamp,
    {BNO} AS create_etl_batch_no, {BDATE} AS create_etl_batch_date,
    CAST(NULL AS INTEGER) AS update_etl_batch_no, CAST(NULL AS DATE) AS update_etl_batch_date
  FROM cur_products) h"""
    q["agg_min_date"] = W() + """
SELECT dw_customer_id, MIN(paymentdate) AS first_payment_date FROM cur_payments
WHERE paymentdate IS NOT NULL GROUP BY dw_customer_id"""
    q["agg_max_lineage"] = W(daily_table_ctes("customer")) + """
SELECT CAST(date_trunc('month', summary_date) AS DATE) AS start_of_the_month_date,
  MAX(etl_batch_no) AS etl_batch_no, MAX(etl_batch_date) AS etl_batch_date,
  MAX(dw_update_timestamp) AS dw_update_timestamp
FROM daily_customer GROUP BY 1"""
    dp = daily_product_ctes()
    q["union_all_product_branches"] = W(dp) + "\n" + branch_select(
        DAILY_PRODUCT_MEASURES, "dp_all", "dw_product_id")


_build_ops = build


def build() -> dict[str, str]:  # noqa: F811
    q = _build_ops()
    build_extra(q)
    return q
