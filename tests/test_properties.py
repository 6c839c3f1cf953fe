"""Properties of the merges on random small inputs."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from nightshift.batch import Batch
from nightshift.operators.scd1 import scd1_merge
from nightshift.operators.scd2 import scd2_merge
from nightshift.schemas import SCD1_SPECS, SCD2_SPECS, SOURCE_SCHEMAS

B = Batch(no=9, date=dt.date(2001, 6, 15), run_ts=dt.datetime(2001, 6, 16, 2))
T0 = dt.datetime(2001, 1, 1, 9)
PL = SCD1_SPECS["productlines"]
TARGET = ("dw_product_line_id bigint, productline string, textdescription string, "
          "htmldescription string, image string, src_create_timestamp timestamp_ntz, "
          "src_update_timestamp timestamp_ntz, dw_create_timestamp timestamp_ntz, "
          "dw_update_timestamp timestamp_ntz, etl_batch_no int, etl_batch_date date")
keys = st.sampled_from([f"L{i}" for i in range(12)])


@settings(max_examples=8, deadline=None)
@given(st.sets(keys, max_size=8), st.lists(st.tuples(keys, st.text("ab ", max_size=3)), max_size=8))
def test_scd1_one_row_per_key(spark, tkeys, staged):
    target = spark.createDataFrame(
        [(i + 1, k, "t", None, None, T0, T0, T0, T0, 1, dt.date(2001, 1, 1)) for i, k in enumerate(sorted(tkeys))],
        TARGET)
    stage = spark.createDataFrame(
        [(k, v, None, None, T0, dt.datetime(2001, 6, 15, 10, i)) for i, (k, v) in enumerate(staged)],
        SOURCE_SCHEMAS["productlines"])
    out = scd1_merge(target, stage, PL, B).collect()
    got_keys = [r["productline"] for r in out]
    assert sorted(got_keys) == sorted(set(tkeys) | {k for k, _ in staged})
    ids = [r["dw_product_line_id"] for r in out]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    staged_keys = {k for k, _ in staged}
    for r in out:
        assert (r["etl_batch_no"] == 9) == (r["productline"] in staged_keys)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(1, 10), st.one_of(st.none(), st.integers(0, 3)), max_size=8),
       st.dictionaries(st.integers(1, 10), st.one_of(st.none(), st.integers(0, 3)), max_size=8))
def test_scd2_at_most_one_active_and_matches_dim(spark, old, new):
    from decimal import Decimal

    spec = SCD2_SPECS["customer_history"]
    dec = lambda v: None if v is None else Decimal(v)
    hist = spark.createDataFrame(
        [(i, dec(v), dt.date(2000, 1, 1), None, 1, T0, T0, 1, dt.date(2000, 1, 1), None, None) for i, v in old.items()],
        "dw_customer_id bigint, creditlimit decimal(12,2), effective_from_date date, effective_to_date date, "
        "dw_active_record_ind int, dw_create_timestamp timestamp_ntz, dw_update_timestamp timestamp_ntz, "
        "create_etl_batch_no int, create_etl_batch_date date, update_etl_batch_no int, update_etl_batch_date date")
    dim = spark.createDataFrame([(i, dec(v)) for i, v in new.items()], "dw_customer_id bigint, creditlimit decimal(12,2)")
    out = scd2_merge(hist, dim, spec, B).collect()
    active = {}
    for r in out:
        if r["dw_active_record_ind"] == 1:
            assert r["dw_customer_id"] not in active
            active[r["dw_customer_id"]] = r["creditlimit"]
    for i, v in new.items():
        assert active[i] == dec(v)
    # Ids that left the dimension keep their active row (no deletes).
    for i in set(old) - set(new):
        assert active[i] == dec(old[i])
