"""Session settings for local runs (tests, bench).  On a cluster the
caller's session is used as it is."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

from .sources.sinks import checkpoint_dir


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName("fundscope")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # no Python call-site capture per column function: it costs
               # several driver round trips for every expression built
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "16g")
               # the driver keeps plans of past queries for the UI listeners;
               # a long benchmark session does not need hundreds of them
               .config("spark.sql.ui.retainedExecutions", "20")
               .config("spark.ui.retainedJobs", "100")
               .config("spark.ui.retainedStages", "200")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # tests only: a scratch checkpoint folder when the session names none
    checkpoint_dir(spark, fallback=os.path.join(scratch or tempfile.mkdtemp(prefix="fundscope-"), "ckpt"))
    return spark
