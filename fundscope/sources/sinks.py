"""Session-level sinks: a view of this session, the checkpoint folder.  Datasets
that others read are written and published by :mod:`fundscope.sources.versions`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW``: re-evaluated at every read, like the
    original views."""
    df.createOrReplaceTempView(name)
    return df


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  A fallback (tests only) is set solely when the
    session has none; a cluster's own setting always wins."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback:
        spark.sparkContext.setCheckpointDir(fallback)
        return fallback
    return None
