"""Hourly correction as a Structured Streaming query.

The reference runs the correction every hour for every open ship date, with the
knowledge time set to the last completely synced hour.  Here the status-change
table's folder is a file stream: each micro-batch (new sync files) re-runs the
correction only for the ship dates its rows touch that are still open, and
replaces just those prediction partitions.  The batch logic is the same
``jobs.correct``; the stream adds incremental triggering and a checkpoint
(under the shared folder) so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazardline import jobs
from hazardline.params import RunParams
from hazardline.plans.dates import plan_correction_dates
from hazardline.session import shared_dir
from hazardline.sources import sinks
from hazardline.sources.tables import Sources


def touched_ship_dates(batch: DataFrame, src: Sources) -> DataFrame:
    """Ship dates of the deliveries a batch of status rows refers to."""
    ids = (batch.filter(F.col("object_type") == "deliveries")
           .select(F.col("object_id").alias("id")).distinct())
    return src.deliveries.join(ids, "id", "left_semi").select("ship_date").distinct()


def batch_knowledge_time(batch: DataFrame) -> str | None:
    """Last complete hour of the newest row in the batch (one value to the driver)."""
    t = batch.agg(F.max("created_at").alias("m")).first()["m"]
    if t is None:
        return None
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return t.replace(minute=0, second=0, microsecond=0).isoformat()


def hourly_correction_stream(spark: SparkSession, src: Sources, changes_path: str, survival_path: str,
                             prediction_path: str, params: RunParams | None = None,
                             checkpoint_location: str | None = None, available_now: bool = False,
                             interval: str = "1 hour") -> StreamingQuery:
    """Start the stream; ``src.event_logs`` must read the same folder as ``changes_path``.

    ``params.knowledge_time`` pins the KT (back-tests); by default each batch uses
    the last complete hour of its newest row.
    """
    params = params or RunParams()
    schema = spark.read.parquet(changes_path).schema
    stream = spark.readStream.schema(schema).parquet(changes_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        kt = params.knowledge_time or batch_knowledge_time(batch)
        if kt is None:
            return
        p = params.with_(knowledge_time=kt)
        targets = touched_ship_dates(batch, src).join(plan_correction_dates(src, p), "ship_date", "left_semi")
        final = jobs.correct(spark, src, p, curves=jobs.stored_curves(spark, survival_path), targets=targets)
        sinks.replace_partitions(sinks.prediction_rows(final), prediction_path)

    if checkpoint_location is None:
        # stable per output table, so a restarted driver resumes from the same offsets
        digest = hashlib.sha1(prediction_path.encode()).hexdigest()[:16]
        checkpoint_location = f"{shared_dir(spark).rstrip('/')}/hazardline/hourly-stream-ckpt/{digest}"
    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
