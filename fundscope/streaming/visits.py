"""Visits from a stream of activities (Structured Streaming).

The dashboards refresh weekly from a batch copy.  When activities arrive
as a stream, the same visit plan runs on each micro-batch: the new
activities are joined with the static CRM tables (stream-static joins: the
static side is re-read per batch, so dimension changes are picked up),
unpivoted by contactor and contact link, qualified by the same rules and
appended to the activity list, partitioned by fiscal year.

No state is kept between batches: every output row depends on one activity
and the current dimensions, so the query is append-only and restarts from
its checkpoint after a failure without duplicating rows (file sink).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import align_union
from ..params import Params
from ..plans import activity as A
from ..sources.standins import Crm


def visit_rows(activity_stream: DataFrame, crm: Crm, key: DataFrame, params: Params) -> DataFrame:
    """P5c on a streaming activity frame: rows of the activity list's
    ``visits`` branch, on its 31-column schema."""
    live = replace(crm, activity=activity_stream)
    id_type = crm.activity.schema["owner_id"].dataType
    return align_union([A.visits(live, key, params)], A.activity_list_schema(params, id_type))


def append_visits(rows: DataFrame, path: str, checkpoint: str,
                  trigger_seconds: int | None = None) -> StreamingQuery:
    """Append visit rows to Parquet under ``path`` partitioned by fiscal
    year; ``checkpoint`` must be a shared, reliable folder."""
    w = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("comb_fy"))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start(path)


def visit_counts(rows: DataFrame) -> DataFrame:
    """Running visit rows per visitor and fiscal year over the stream (the
    counts behind the scorecard's visit roll-up).  The state holds one
    count per (visitor, FY): officer x year sized, so no watermark is needed
    and no late row is dropped; partial counts are combined per micro-batch
    before the state store is updated."""
    from pyspark.sql import functions as F
    return (rows.where(F.col("contactor").isNotNull())
            .groupBy("visitor", "comb_fy").agg(F.count(F.lit(1)).alias("visits")))


def start_visit_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Publish the running counts under ``path``: each micro-batch carries
    the complete counts (officer x year sized) and is written to a folder of
    its own, ``path/counts/version=<batch>``, then marked in ``path/done``;
    readers take the highest marked version (:func:`read_visit_counts`), so
    they never see half of one.  A repeated batch replaces its own folder only.  Links that
    arrive after their activity was read are not counted: the links are a
    table read with each batch, and an activity is joined once."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        root = path.rstrip("/")
        batch.write.mode("overwrite").parquet(f"{root}/counts/version={batch_id}")
        batch.sparkSession.range(1).write.mode("overwrite").parquet(f"{root}/done/version={batch_id}")

    return (counts.writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint).start())


def read_visit_counts(spark, path: str) -> DataFrame:
    """The latest complete version of the published counts."""
    from pyspark.sql import functions as F
    root = path.rstrip("/")
    latest = spark.read.parquet(f"{root}/done").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/counts/version={latest}")
