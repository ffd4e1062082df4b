"""Job rules: default knowledge time, gates per date, emptied dates, real id 0."""

import datetime as dt

import pytest

from hazardline import RunParams, jobs
from hazardline.operators.training import training_set
from hazardline.session import scale_settings, scratch_path
from hazardline.sources import sinks
from hazardline.sources.tables import sync_times


def test_no_knowledge_time_and_no_sync_tables_raises(spark):
    class Src:
        sync_tables = ()
    with pytest.raises(ValueError, match="knowledge time"):
        jobs.run_correction_job(spark, Src(), RunParams(), "unused", "unused")


def test_default_knowledge_time_is_the_last_complete_hour(spark):
    t = spark.createDataFrame([(dt.datetime(2020, 1, 2, 3, 4),), (dt.datetime(2020, 1, 2, 5, 59),)], "at timestamp")

    class Src:
        sync_tables = sync_times({"a": t}, {"a": "at"})
    assert jobs.last_complete_hour(Src()).startswith("2020-01-02T05:00:00")
    Src.sync_tables = sync_times({"a": t.limit(0)}, {"a": "at"})
    with pytest.raises(ValueError, match="empty"):
        jobs.last_complete_hour(Src())


def test_gate_names_the_date_without_rows(spark):
    d = [dt.date(2020, 1, 1), dt.date(2020, 1, 2)]
    df = spark.createDataFrame([(d[0],)], "ship_date date")
    assert jobs.quality_gate(df, "curve set", d[:1]) is df
    with pytest.raises(jobs.QualityGateError, match="2020-01-02"):
        jobs.quality_gate(df, "curve set", d)


def test_requested_date_that_got_no_rows_loses_its_old_ones(spark):
    path = scratch_path(spark, "emptied")
    a, b, c = (dt.date(2020, 1, i) for i in (1, 2, 3))
    df = spark.createDataFrame([(1, a), (2, b), (3, c)], "x int, ship_date date")
    sinks.replace_partitions(df, path)
    sinks.replace_partitions(df.where("x = 1").selectExpr("x + 10 AS x", "ship_date"), path, [a, b])
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [3, 11]


def test_real_id_zero_stays_apart_from_the_rolled_up_zero(spark):
    life = spark.createDataFrame([(dt.date(2020, 1, 1), 5, True, 1, 7, 1, 0, 3)],
                                 "ship_date date, lifespan int, died_bool boolean, facility_id int, weekly_order_id long,"
                                 " user_tenure int, freight_id int, plan_id int")
    got = training_set(life).groupBy("grp").count().collect()
    assert sum(r["count"] for r in got) == 4 and max(r["count"] for r in got) == 2


def test_no_cap_on_shuffle_partitions():
    assert int(scale_settings(100 << 40, 4000)["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
