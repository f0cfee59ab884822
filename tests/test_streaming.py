"""The streaming visit plan gives the batch plan's rows."""

import os
import shutil

from fundscope.plans import catalog
from fundscope.sources import standins
from fundscope.streaming import append_visits, visit_rows

from .conftest import SF_SMALL


def test_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "events_in")
    os.makedirs(src, exist_ok=True)
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), os.path.join(src, "part-0.parquet"))
    c = catalog.context(spark, SF_SMALL)
    events_schema = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).schema
    stream = spark.readStream.schema(events_schema).parquet(src)
    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    live = standins.activity_from_events(stream, orders)
    rows = visit_rows(live, c.crm, c.key, c.params)
    assert rows.isStreaming
    out, ckpt = os.path.join(scratch, "visits_out"), os.path.join(scratch, "visits_ckpt")
    q = append_visits(rows, out, ckpt)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(out)
    batch = c.activity_list.where("source = 'visits'")
    cols = sorted(batch.columns)
    assert got.count() == batch.count() > 0
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_stream_visit_counts_equal_batch_rollup(spark, scratch):
    from pyspark.sql import functions as F
    from fundscope.streaming import read_visit_counts, start_visit_counts, visit_counts
    src = os.path.join(scratch, "events_in_counts")
    os.makedirs(src, exist_ok=True)
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), os.path.join(src, "part-0.parquet"))
    c = catalog.context(spark, SF_SMALL)
    events_schema = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).schema
    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    live = standins.activity_from_events(spark.readStream.schema(events_schema).parquet(src), orders)
    out = os.path.join(scratch, "visit_counts")
    q = start_visit_counts(visit_counts(visit_rows(live, c.crm, c.key, c.params)), out,
                           os.path.join(scratch, "counts_ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r.visitor, r.comb_fy): r.visits for r in read_visit_counts(spark, out).collect()}
    batch = (c.activity_list.where("source = 'visits' AND contactor IS NOT NULL")
             .groupBy("visitor", "comb_fy").agg(F.count(F.lit(1)).alias("visits")))
    want = {(r.visitor, r.comb_fy): r.visits for r in batch.collect()}
    assert got == want and len(got) > 0
