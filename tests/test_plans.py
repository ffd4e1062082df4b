"""Physical-plan properties of the two jobs (what `.explain` should show)."""

import re

import pytest

from hazardline import jobs
from hazardline.catalog.registry import reference_params
from hazardline.sources.fixtures import fixture_sources
from tests.conftest import SF001


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    src = fixture_sources(spark, SF001)
    p = reference_params(min_records=5)
    c = jobs.correction_plan(spark, src, p)
    return {"train": plan_text(jobs.train(spark, src, p)), "correct": plan_text(c.final),
            "actuals": plan_text(c.actuals)}


@pytest.mark.parametrize("name", ["train", "correct", "actuals"])
def test_no_nested_loop_cartesian_or_python(plans, name):
    t = plans[name]
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas", "ExistingRDD"):
        assert bad not in t, f"{name} plan contains {bad}"


def test_kt_predicates_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(created_at", plans["train"])


def test_nothing_read_from_a_table_is_broadcast_by_hint(spark):
    """With size-based broadcasts off, only literal relations are broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = fixture_sources(spark, SF001)
        lines = plan_text(jobs.train(spark, src, reference_params(min_records=5))).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = [len(re.match(r"[\s:+*|-]*", x)[0]) for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            below = i + 1
            while below < len(lines) and depth[below] > depth[i]:
                assert "FileScan" not in lines[below], x
                below += 1


def test_stored_packed_curves_are_listed_by_their_keys_and_pruned_to_the_targets(spark):
    from hazardline.session import scratch_path
    src = fixture_sources(spark, SF001)
    dates = ("2019-09-20", "2019-09-21")
    path = scratch_path(spark, "packed")
    jobs.run_training_job(spark, src, reference_params(min_records=5, ship_dates=dates), path, packed=True)
    final = jobs.correct(spark, src, reference_params(ship_dates=dates[:1]), jobs.stored_curves(spark, path))
    scans = [x for x in final._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "packed" in x]
    assert len(scans) == 3 and all("PartitionFilters: [ship_date" in x or "PartitionFilters: [isnotnull(ship_date" in x for x in scans)
    assert sum("rates" in x.split("ReadSchema")[1] for x in scans) == 1
    aggregates = [x for x in final._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x]
    assert not any("survival_rate" not in x and "timeline" in x for x in aggregates)
