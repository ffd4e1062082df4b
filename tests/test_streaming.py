"""The streaming trigger produces the same predictions as the batch correction."""

from pyspark.sql import functions as F

from hazardline import jobs
from hazardline.catalog.registry import reference_params
from hazardline.session import scratch_path
from hazardline.sources import sinks
from hazardline.sources.fixtures import fixture_sources
from hazardline.sources.tables import Sources
from hazardline.streaming import hourly_correction_stream
from tests.conftest import SF001


def test_stream_matches_batch(spark):
    base = fixture_sources(spark, SF001)
    p = reference_params(min_records=5)
    changes = scratch_path(spark, "t-changes")
    base.event_logs.write.parquet(changes)
    src = Sources(**{**base.__dict__, "event_logs": spark.read.parquet(changes)})
    survival = scratch_path(spark, "t-survival")
    jobs.run_training_job(spark, src, p, survival)
    out = scratch_path(spark, "t-pred")
    q = hourly_correction_stream(spark, src, changes, survival, out, params=p, available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(out)
    want = sinks.prediction_rows(jobs.correct(spark, src, p, curves=jobs.stored_curves(spark, survival)))
    dates = got.select("ship_date").distinct()
    want = want.join(dates, "ship_date", "left_semi")
    assert got.count() > 0
    cols = want.columns
    assert got.select(cols).exceptAll(want).count() == 0 and want.exceptAll(got.select(cols)).count() == 0
    assert dates.count() == want.select("ship_date").distinct().count()
    assert got.filter(F.col("ship_date").isNull()).count() == 0
