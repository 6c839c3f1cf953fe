"""The stage load over a file stream: each landing batch exactly once."""

import datetime as dt

from pyspark.sql import functions as F

from nightshift.sources import adapters as A
from nightshift.sources import extract
from nightshift.streaming.landing import stage_stream


def test_landing_batches_picked_up_once(spark, sf, scratch):
    src = A.source(spark, sf, "customers")
    landing = f"{scratch}/landing"
    out = f"{scratch}/stage_customers"
    days = [dt.date(2001, 6, 1), dt.date(2001, 6, 15)]

    def sink(df, batch_id):
        df.write.mode("append").parquet(out)

    expected = 0
    for d in days:
        ex = extract.extract_incremental(src, "customers", d)
        expected += ex.count()
        extract.land(ex, extract.landing_path(spark, "customers", d, root=landing))
        q = stage_stream(spark, "customers", landing, f"{scratch}/ckpt", sink)
        q.awaitTermination()
    staged = spark.read.parquet(out)
    assert staged.count() == expected
    assert staged.select("etl_batch_date").distinct().count() == 2
    # Blanks became NULL on the way in.
    assert staged.where(F.trim("addressline2") == "").count() == 0
