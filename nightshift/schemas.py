"""Table schemas and merge specifications (data, not code).

Column names and order follow the extract and insert lists of the
reference; the types are those inferred in SURVEY §1.3 (money is
DECIMAL(12,2), numeric keys are BIGINT, warehouse timestamps zone-less).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for the same results) ---------
# Order status words, compared after LOWER(TRIM(status)).
STATUS_CANCELLED = "cancelled"
STATUS_SHIPPED = "shipped"
# Batch log status codes: running, succeeded (the reference's default end
# status); ours adds failed.
LOG_RUNNING = "R"
LOG_SUCCEEDED = "S"
LOG_FAILED = "F"
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(12, 2)
# Sums of money keep two decimals and enough integer digits for any total.
MONEY_SUM = T.DecimalType(38, 2)
TS = T.TimestampNTZType()

AUDIT_TS = [("create_timestamp", TS), ("update_timestamp", TS)]


def _struct(cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols + AUDIT_TS])


S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()

# Source = stage schemas.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "offices": _struct(
        [
            ("officecode", S), ("city", S), ("phone", S), ("addressline1", S),
            ("addressline2", S), ("state", S), ("country", S), ("postalcode", S),
            ("territory", S),
        ]
    ),
    "employees": _struct(
        [
            ("employeenumber", L), ("lastname", S), ("firstname", S), ("extension", S),
            ("email", S), ("officecode", S), ("reportsto", L), ("jobtitle", S),
        ]
    ),
    "customers": _struct(
        [
            ("customernumber", L), ("customername", S), ("contactlastname", S),
            ("contactfirstname", S), ("phone", S), ("addressline1", S),
            ("addressline2", S), ("city", S), ("state", S), ("postalcode", S),
            ("country", S), ("salesrepemployeenumber", L), ("creditlimit", MONEY),
        ]
    ),
    "productlines": _struct(
        [("productline", S), ("textdescription", S), ("htmldescription", S), ("image", S)]
    ),
    "products": _struct(
        [
            ("productcode", S), ("productname", S), ("productline", S),
            ("productscale", S), ("productvendor", S), ("productdescription", S),
            ("quantityinstock", I), ("buyprice", MONEY), ("msrp", MONEY),
        ]
    ),
    "orders": _struct(
        [
            ("ordernumber", L), ("orderdate", D), ("requireddate", D), ("shippeddate", D),
            ("status", S), ("comments", S), ("customernumber", L), ("cancelleddate", D),
        ]
    ),
    "orderdetails": _struct(
        [
            ("ordernumber", L), ("productcode", S), ("quantityordered", I),
            ("priceeach", MONEY), ("orderlinenumber", I),
        ]
    ),
    "payments": _struct(
        [("customernumber", L), ("checknumber", S), ("paymentdate", D), ("amount", MONEY)]
    ),
}

SOURCE_TABLES = tuple(SOURCE_SCHEMAS)


@dataclass(frozen=True)
class Lookup:
    """An id taken from a parent warehouse table when a row is inserted.

    ``stage_col`` of the new row is matched with ``parent_key`` of the
    parent; ``parent_id`` is stored as ``target_col``.  ``required`` drops
    rows without a parent (LEFT JOIN + IS NOT NULL); otherwise the id stays
    NULL.  ``self_ref`` marks the reports-to lookup into the table itself,
    which sees the table as it was before this batch's inserts.
    """

    parent: str
    stage_col: str
    parent_key: str
    parent_id: str
    target_col: str
    required: bool
    self_ref: bool = False


@dataclass(frozen=True)
class Scd1Spec:
    """A type-1 table: update matched rows, insert new ones.

    ``keys`` are (stage column, warehouse column) pairs of the natural key;
    ``attrs`` the overwritten attributes as (stage column, warehouse
    column).  ``surrogate`` names the id column the table owns (None for
    link tables).  ``columns`` is the warehouse column order.
    """

    name: str
    keys: tuple[tuple[str, str], ...]
    attrs: tuple[tuple[str, str], ...]
    surrogate: str | None
    lookups: tuple[Lookup, ...] = ()
    columns: tuple[str, ...] = field(default=())

    @property
    def stage_keys(self) -> list[str]:
        return [s for s, _ in self.keys]

    @property
    def target_keys(self) -> list[str]:
        return [t for _, t in self.keys]


WAREHOUSE_AUDIT = (
    "src_create_timestamp",
    "src_update_timestamp",
    "dw_create_timestamp",
    "dw_update_timestamp",
    "etl_batch_no",
    "etl_batch_date",
)


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


def _spec(name, keys, attrs, surrogate, lookups=()) -> Scd1Spec:
    cols: list[str] = []
    if surrogate:
        cols.append(surrogate)
    cols += [t for _, t in keys]
    cols += [t for _, t in attrs]
    cols += [lk.target_col for lk in lookups if lk.target_col not in cols]
    cols += list(WAREHOUSE_AUDIT)
    return Scd1Spec(name, keys, attrs, surrogate, tuple(lookups), tuple(cols))


SCD1_SPECS: dict[str, Scd1Spec] = {
    "offices": _spec(
        "offices",
        _same("officecode"),
        _same("city", "phone", "addressline1", "addressline2", "state", "country",
              "postalcode", "territory"),
        "dw_office_id",
    ),
    "employees": _spec(
        "employees",
        _same("employeenumber"),
        _same("lastname", "firstname", "extension", "email", "officecode", "reportsto",
              "jobtitle"),
        "dw_employee_id",
        (
            Lookup("offices", "officecode", "officecode", "dw_office_id", "dw_office_id", False),
            Lookup("employees", "reportsto", "employeenumber", "dw_employee_id",
                   "dw_reporting_employee_id", False, self_ref=True),
        ),
    ),
    "customers": _spec(
        "customers",
        (("customernumber", "src_customernumber"),),
        _same("customername", "contactlastname", "contactfirstname", "phone",
              "addressline1", "addressline2", "city", "state", "postalcode", "country",
              "salesrepemployeenumber", "creditlimit"),
        "dw_customer_id",
    ),
    "productlines": _spec(
        "productlines",
        _same("productline"),
        _same("textdescription", "htmldescription", "image"),
        "dw_product_line_id",
    ),
    "products": _spec(
        "products",
        (("productcode", "src_productcode"),),
        _same("productname", "productline", "productscale", "productvendor",
              "productdescription", "quantityinstock", "buyprice", "msrp"),
        "dw_product_id",
        (Lookup("productlines", "productline", "productline", "dw_product_line_id",
                "dw_product_line_id", True),),
    ),
    "orders": _spec(
        "orders",
        (("ordernumber", "src_ordernumber"),),
        (("orderdate", "orderdate"), ("requireddate", "requireddate"),
         ("shippeddate", "shippeddate"), ("status", "status"), ("comments", "comments"),
         ("customernumber", "src_customernumber"), ("cancelleddate", "cancelleddate")),
        "dw_order_id",
        (Lookup("customers", "customernumber", "src_customernumber", "dw_customer_id",
                "dw_customer_id", True),),
    ),
    "orderdetails": _spec(
        "orderdetails",
        (("ordernumber", "src_ordernumber"), ("productcode", "src_productcode")),
        _same("quantityordered", "priceeach", "orderlinenumber"),
        None,
        (
            Lookup("orders", "ordernumber", "src_ordernumber", "dw_order_id", "dw_order_id", True),
            Lookup("products", "productcode", "src_productcode", "dw_product_id",
                   "dw_product_id", True),
        ),
    ),
    "payments": _spec(
        "payments",
        (("customernumber", "src_customernumber"), ("checknumber", "checknumber")),
        _same("paymentdate", "amount"),
        None,
        (Lookup("customers", "customernumber", "src_customernumber", "dw_customer_id",
                "dw_customer_id", True),),
    ),
}

# Load order: parents before children (lookups), dimensions before history.
SCD1_ORDER = ("offices", "employees", "customers", "productlines", "products",
              "orders", "orderdetails", "payments")


@dataclass(frozen=True)
class Scd2Spec:
    name: str
    dim: str
    id_col: str
    tracked: str


SCD2_SPECS = {
    "customer_history": Scd2Spec("customer_history", "customers", "dw_customer_id", "creditlimit"),
    "product_history": Scd2Spec("product_history", "products", "dw_product_id", "msrp"),
}

HISTORY_COLUMNS = (
    "effective_from_date", "effective_to_date", "dw_active_record_ind",
    "dw_create_timestamp", "dw_update_timestamp", "create_etl_batch_no",
    "create_etl_batch_date", "update_etl_batch_no", "update_etl_batch_date",
)

# Daily / monthly measures: (name, kind) with kind "sum" (added) or "flag"
# (0/1, combined with max; sticky in the monthly update).
DAILY_CUSTOMER_MEASURES = (
    ("order_count", "sum"), ("order_apd", "flag"), ("order_cost_amount", "sum"),
    ("cancelled_order_count", "sum"), ("cancelled_order_amount", "sum"),
    ("cancelled_order_apd", "flag"), ("shipped_order_count", "sum"),
    ("shipped_order_apd", "flag"), ("shipped_order_amount", "sum"),
    ("payment_apd", "flag"), ("payment_amount", "sum"),
    ("products_ordered_qty", "sum"), ("products_items_qty", "sum"),
    ("order_mrp_amount", "sum"), ("new_customer_apd", "flag"),
    ("new_customer_paid_apd", "flag"),
)

DAILY_PRODUCT_MEASURES = (
    ("customer_apd", "flag"), ("product_cost_amount", "sum"),
    ("product_mrp_amount", "sum"), ("cancelled_product_qty", "sum"),
    ("cancelled_cost_amount", "sum"), ("cancelled_mrp_amount", "sum"),
    ("cancelled_order_apd", "flag"),
)

# Column types of the facts: counts and quantities BIGINT, flags INT,
# amounts MONEY_SUM.
def measure_type(name: str) -> T.DataType:
    if name.endswith("_apd") or name.endswith("_apm"):
        return T.IntegerType()
    if name.endswith("_amount"):
        return MONEY_SUM
    return T.LongType()
