"""Sinks: partition replacement, strict CSV, constraints, quality gate."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardline import jobs
from hazardline.session import local_path, scratch_path
from hazardline.sources import sinks


def test_rerun_replaces_only_its_partition(spark):
    path = scratch_path(spark, "t-parts")
    base = spark.createDataFrame([("a", 1, 0.5, "2019-01-01"), ("b", 1, 0.5, "2019-01-02")],
                                 "grp string, timeline int, survival_rate double, ship_date string")
    base = base.withColumn("ship_date", F.col("ship_date").cast("date"))
    sinks.replace_partitions(base, path)
    rerun = base.filter(F.col("ship_date") == "2019-01-02").withColumn("survival_rate", F.lit(0.25))
    sinks.replace_partitions(rerun, path)
    got = {(r.grp, str(r.ship_date), r.survival_rate) for r in spark.read.parquet(path).collect()}
    assert got == {("a", "2019-01-01", 0.5), ("b", "2019-01-02", 0.25)}


def test_strict_csv_load(spark):
    path = local_path(scratch_path(spark, "t-csv"))
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as f:
        f.write('name,qty\n"a,b",1\n,2\n')
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("qty", T.IntegerType())])
    rows = sinks.load_csv_strict(spark, path, schema).collect()
    assert [(r.name, r.qty) for r in rows] == [("a,b", 1), (None, 2)]
    bad = local_path(scratch_path(spark, "t-csv-bad"))
    os.makedirs(bad)
    with open(f"{bad}/part.csv", "w") as f:
        f.write("name,qty\nx,notanumber\n")
    with pytest.raises(Exception):
        sinks.load_csv_strict(spark, bad, schema).collect()


def test_survival_constraints_fail_the_write(spark):
    df = spark.createDataFrame([("x" * 21, 0, 1.0, "2019-01-01")],
                               "grp string, timeline int, survival_rate double, ship_date string")
    with pytest.raises(Exception):
        sinks.survival_rows(df.withColumn("ship_date", F.col("ship_date").cast("date"))).collect()


def test_upsert_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    got = sorted((r.k, r.v) for r in sinks.upsert_by_key(old, new, ["k"]).collect())
    assert got == [(1, "a"), (2, "B"), (3, "C")]


def test_quality_gate_raises_on_empty(spark):
    with pytest.raises(ValueError):
        jobs.quality_gate(spark.range(0), "training set")
    assert jobs.quality_gate(spark.range(1), "x").count() == 1


def test_create_sink_table(spark):
    loc = scratch_path(spark, "t-table")
    name = "t_survival_" + uuid.uuid4().hex[:8]
    sinks.create_sink(spark, name, sinks.SURVIVAL_DDL, loc)
    sinks.create_sink(spark, name, sinks.SURVIVAL_DDL, loc)  # idempotent
    assert spark.table(name).columns == ["grp", "timeline", "survival_rate", "ship_date"]
