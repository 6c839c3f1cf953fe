"""The table specs written out: the oracle is built from them, so they are pinned here."""

from nightshift.schemas import DAILY_CUSTOMER_MEASURES, DAILY_PRODUCT_MEASURES, SCD1_SPECS, SCD2_SPECS

ATTRIBUTES = {
    "offices": "city phone addressline1 addressline2 state country postalcode territory",
    "employees": "lastname firstname extension email officecode reportsto jobtitle",
    "customers": "customername contactlastname contactfirstname phone addressline1 addressline2 city state "
                 "postalcode country salesrepemployeenumber creditlimit",
    "productlines": "textdescription htmldescription image",
    "products": "productname productline productscale productvendor productdescription quantityinstock buyprice msrp",
    "orders": "orderdate requireddate shippeddate status comments customernumber cancelleddate",
    "orderdetails": "quantityordered priceeach orderlinenumber",
    "payments": "paymentdate amount",
}
KEYS = {
    "offices": "officecode", "employees": "employeenumber", "customers": "customernumber", "productlines": "productline",
    "products": "productcode", "orders": "ordernumber", "orderdetails": "ordernumber productcode",
    "payments": "customernumber checknumber",
}
# (stage column, required)
LOOKUPS = {
    "employees": [("officecode", False), ("reportsto", False)],
    "products": [("productline", True)],
    "orders": [("customernumber", True)],
    "orderdetails": [("ordernumber", True), ("productcode", True)],
    "payments": [("customernumber", True)],
}
CUSTOMER_FLAGS = {"order_apd", "cancelled_order_apd", "shipped_order_apd", "payment_apd", "new_customer_apd", "new_customer_paid_apd"}
CUSTOMER_SUMS = {
    "order_count", "order_cost_amount", "cancelled_order_count", "cancelled_order_amount", "shipped_order_count",
    "shipped_order_amount", "payment_amount", "products_ordered_qty", "products_items_qty", "order_mrp_amount",
}
PRODUCT_FLAGS = {"customer_apd", "cancelled_order_apd"}
PRODUCT_SUMS = {"product_cost_amount", "product_mrp_amount", "cancelled_product_qty", "cancelled_cost_amount", "cancelled_mrp_amount"}


def test_type_1_specs():
    assert {t: [s for s, _ in spec.attrs] for t, spec in SCD1_SPECS.items()} == {t: a.split() for t, a in ATTRIBUTES.items()}
    assert {t: [s for s, _ in spec.keys] for t, spec in SCD1_SPECS.items()} == {t: k.split() for t, k in KEYS.items()}
    assert {t: [(x.stage_col, x.required) for x in spec.lookups] for t, spec in SCD1_SPECS.items() if spec.lookups} == LOOKUPS


def test_type_2_specs_and_measures():
    assert {n: (s.dim, s.id_col, s.tracked) for n, s in SCD2_SPECS.items()} == {
        "customer_history": ("customers", "dw_customer_id", "creditlimit"),
        "product_history": ("products", "dw_product_id", "msrp"),
    }
    for measures, flags, sums in ((DAILY_CUSTOMER_MEASURES, CUSTOMER_FLAGS, CUSTOMER_SUMS), (DAILY_PRODUCT_MEASURES, PRODUCT_FLAGS, PRODUCT_SUMS)):
        assert {n for n, kind in measures if kind == "flag"} == flags
        assert {n for n, kind in measures if kind == "sum"} == sums


def test_fixtures_can_fail(spark, sf):
    """The inputs hold the cases that tell the operators from simpler ones."""
    from nightshift.plans.queries import REGISTRY
    from nightshift.sources import adapters as A

    employees = A.source(spark, sf, "employees")
    assert employees.where("reportsto IS NULL").count() > 1
    assert employees.where(employees.officecode == A.UNKNOWN_OFFICE).count() > 0
    for name in ("customer_history", "product_history"):
        assert A.previous_history(spark, sf, name).where("dw_active_record_ind = 0").count() > 0
    assert REGISTRY["scd2_customer_history"](spark, sf).where("dw_active_record_ind = 0").count() > 0
