"""Hot keys: a third (here: most) of the rows on one key."""

from pyspark.sql import functions as F

from fundscope.operators.relational import bridge_left_join
from fundscope.operators.credit import role_dollars

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_bridge_key_is_split(spark):
    left = spark.range(0, 200).select(F.col("id").alias("act"), (F.col("id") % 7).alias("x"))
    # activity 0 holds most of the bridge rows
    hot = spark.range(0, 20000).select(F.lit(0).cast("long").alias("k"), F.col("id").alias("v"))
    cold = spark.range(1, 150).select(F.col("id").alias("k"), F.col("id").alias("v"))
    bridge = hot.unionByName(cold).repartition(8)
    old = _with_conf(spark, SKEW_CONF)
    try:
        out = bridge_left_join(left, bridge, "act", "k", part_rows=1000)
        n = len(out.collect())
        per_task = (out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        scans = out._jdf.queryExecution().optimizedPlan().toString().count("AS act")
        expected = left.join(bridge, left.act == bridge.k, "left").count()
    finally:
        _restore(spark, old)
    assert n == expected == 20000 + 149 + 50
    assert per_task < 0.6 * n    # the hot bridge key was dealt to several tasks
    assert scans == 1            # the left side is read once


def test_hot_group_partial_aggregation(spark):
    rows = spark.range(0, 50000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 100).cast("string"))).alias("s"),
        F.when(F.col("id") % 2 == 0, F.lit("Lead Solicitor")).otherwise(F.lit("Secondary Solicitor")).alias("r"),
        F.lit(1).cast("decimal(18,2)").alias("amt"))
    out = role_dollars(rows, ["s"], "r", "amt")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # map-side combine before the exchange
    hot = out.where("s = 'hot'").collect()[0]
    assert hot.lead_dollars + hot.co_dollars == 16667
