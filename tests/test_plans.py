"""Plan properties that matter at scale, checked on stored tables.

Parquet copies of the warehouse views stand in for the stored tables, so the
plans are those of production reads (pushed filters, column pruning).
"""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from nightshift.plans import daily, programs
from nightshift.sources import adapters as A


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    wh = {}
    for t in ("customers", "orders", "orderdetails", "products", "payments"):
        A.current(spark, sf, t).write.parquet(f"{root}/{t}")
        wh[t] = spark.read.parquet(f"{root}/{t}")
    A.previous(spark, sf, "customers").write.parquet(f"{root}/prev_customers")
    wh["prev_customers"] = spark.read.parquet(f"{root}/prev_customers")
    A.stage(spark, sf, "customers").write.parquet(f"{root}/stage_customers")
    wh["stage_customers"] = spark.read.parquet(f"{root}/stage_customers")
    return wh


def test_daily_cutoffs_reach_the_scans(stored):
    text = plan(daily.daily_customer_summary(stored, A.BATCH))
    assert "GreaterThanOrEqual(orderdate,2001-06-15)" in text
    assert "GreaterThanOrEqual(paymentdate,2001-06-15)" in text
    # The batch's order-id range is pushed to the order-line scan.
    assert "GreaterThanOrEqual(dw_order_id," in text and "LessThanOrEqual(dw_order_id," in text
    # Lines are joined with the (bounded) batch orders by broadcast: no sort-merge join.
    assert "SortMergeJoin" not in text
    # Only the needed columns of the line table are read.
    schemas = [line for line in text.splitlines()
               if line.startswith("ReadSchema:") and "quantityordered" in line]
    assert schemas and all(line.count(":") == 5 for line in schemas), schemas


def test_type1_merge_streams_the_target(stored):
    wh = {"customers": stored["prev_customers"]}
    text = plan(programs.upsert("customers", wh, stored["stage_customers"], A.BATCH))
    # The batch's changes are broadcast; the target is never shuffled or sorted.
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    assert "SortMergeJoin" not in text


def test_no_count_distinct_expand_in_one_pass_daily(stored):
    text = plan(daily.daily_customer_summary(stored, A.BATCH))
    assert "Expand" not in text
    ref = plan(daily.daily_customer_summary_by_branches(stored, A.BATCH))
    assert "Expand" in ref  # the branch form needs it for two COUNT DISTINCTs


def test_broadcast_is_bounded_by_measured_bytes(spark):
    from pyspark.sql import functions as F

    from nightshift.operators.joins import fits

    wide = spark.range(200_000).withColumn("text", F.repeat(F.lit("x"), 2_000))
    assert not fits(wide)  # 400 MB of text in few rows
    assert fits(wide.select("id"))
    assert not fits(wide.select("id"), max_rows=1_000)


def test_hot_customer_is_reduced_before_the_first_payment_join(spark, stored):
    """On the shuffle path a (date, customer) exchange above a partial aggregate feeds the join."""
    spark.conf.set("spark.nightshift.broadcastMaxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pay = stored["payments"]
        text = plan(daily.paid_days(pay, daily.first_payment(pay)))
    finally:
        spark.conf.unset("spark.nightshift.broadcastMaxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("(1) Scan")[0]
    join = next(i for i, x in enumerate(tree.split("\n")) if "SortMergeJoin" in x)
    below = tree.split("\n")[join + 1 :]
    assert sum("HashAggregate" in x for x in below) >= 4  # partial and final, days and first days
    assert not any("HashAggregate" in x for x in tree.split("\n")[:join])


def test_stage_deduplication_sorts_no_wide_rows(spark, stored):
    """Keys that occur twice are found in hash aggregations; whole rows are neither sorted nor shuffled."""
    from nightshift.operators.scd1 import latest_per_key

    stage = stored["stage_customers"]
    assert latest_per_key(stage, ["customernumber"]) is stage  # no key occurs twice
    twice = stage.unionByName(stage.limit(3).withColumn("update_timestamp", stage["update_timestamp"] + F.expr("INTERVAL 1 DAY")).withColumn("city", F.lit("new")))
    got = latest_per_key(twice, ["customernumber"])
    assert "SortAggregate" not in plan(got)
    assert got.count() == stage.count() and got.where("city = 'new'").count() == 3


def test_first_load_of_product_history_opens_every_product(spark, tmp_path):
    """I10 on ``empty_table``: one active version per product, nothing closed."""
    from nightshift.plans.queries import REGISTRY
    from nightshift.plans.tables import empty_table

    rows = [(7, "P7", "B", "T", 3, 100.5), (2, None, "B", None, 1, None)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(
        f"{tmp_path}/part.parquet")
    got = REGISTRY["scd2_first_load_product"](spark, str(tmp_path))
    assert sorted((r.dw_product_id, r.msrp, r.dw_active_record_ind, r.effective_to_date) for r in got.collect()) == [
        (3, None, 1, None), (8, 100.5, 1, None)]
    empty = empty_table(spark, "product_history")
    assert empty.isEmpty() and empty.columns == got.columns


def test_first_load_of_customers_inserts_every_customer(spark, tmp_path):
    """I3 into ``empty_table``: ids 1..n by customer number, creation before the batch included."""
    from nightshift.plans.queries import REGISTRY
    from nightshift.plans.tables import empty_table, table_schema

    rows = [(7, "C7", 3, 10.0, "SEG"), (2, "C2", 1, -5.0, "SEG"), (40, None, None, None, None)]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        f"{tmp_path}/customer.parquet")
    got = REGISTRY["upsert_first_load_customers"](spark, str(tmp_path))
    assert sorted((r.dw_customer_id, r.src_customernumber) for r in got.collect()) == [(1, 2), (2, 7), (3, 40)]
    empty = empty_table(spark, "customers")
    assert empty.isEmpty() and empty.columns == got.columns
    assert set(table_schema("customers").fieldNames()) - set(empty.columns) == {"id_range"}


def test_order_lines_are_dealt_once(spark, sf):
    """Sums of the line items and their joins with orders share the exchange by the order's id."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = A.fact_inputs(spark, sf)
        joined = wh["orders"].select("dw_order_id", "orderdate").join(wh["orderdetails"], "dw_order_id")
        text = plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("(1) Scan")[0]
    # One for the lines, one for each of the two readings of orders.
    assert sum("Exchange" in x for x in tree.split("\n")) == 3


def test_daily_table_is_stored_by_columns(spark, sf):
    """The monthly programs read only their columns of the daily history."""
    table = A.daily_table(spark, sf, "customer")
    text = plan(table.groupBy("summary_date").agg(F.max("etl_batch_no")))
    schemas = [x for x in text.splitlines() if x.startswith("ReadSchema:")]
    assert schemas == ["ReadSchema: struct<summary_date:date,etl_batch_no:int>"]


def test_lines_of_a_batch_are_cut_down_before_their_sums(spark, sf):
    """Only line items of the orders that a branch reads are dealt and summed."""
    wh = A.fact_inputs(spark, sf)
    for branch in (daily.product_ordered, daily.product_cancelled, daily.customer_shipped):
        tree = plan(branch(wh, A.BATCH)).split("(1) Scan")[0].split("\n")
        depth = {name: max(x.index(name) for x in tree if name in x) for name in ("LeftSemi", "HashAggregate", "Exchange hash", "Exchange") if any(name in x for x in tree)}
        assert depth["LeftSemi"] > depth["HashAggregate"]


def test_rows_of_a_task_stay_bounded(spark, monkeypatch):
    """The more rows, the more tasks; the daily facts are the same however their lines are dealt."""
    from nightshift.operators import joins
    from tests.test_programs import B, D, _wh

    few, many = (joins.dealt(spark.range(10), n, "id").rdd.getNumPartitions() for n in (10, 1_000 * joins.ROWS_A_TASK))
    assert few <= 8 and many == 1_001
    wh = _wh(spark, [(1, 7, D, D, None, "CANCELLED "), (2, 7, D, None, D, "shipped"), (3, 8, D, None, None, "x")],
             [(1, 1, 1, "1.00"), (1, 2, None, "2.00"), (2, 1, 3, "1.00"), (3, 9, 1, "4.00")],
             payments=[(7, D, "5.00")], customers=[(7, None)])
    spark.conf.set("spark.nightshift.broadcastMaxRows", "0")
    monkeypatch.setattr(joins, "ROWS_A_TASK", 1)
    try:
        for whole, branches in ((daily.daily_product_summary, daily.daily_product_summary_by_branches),
                                (daily.daily_customer_summary, daily.daily_customer_summary_by_branches)):
            a, b = whole(wh, B), branches(wh, B)
            assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.unset("spark.nightshift.broadcastMaxRows")
