"""The command: modes, arguments, gates, one commit for all dates, knowledge times in the commit's note."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardline import command, jobs
from hazardline.catalog.registry import reference_params
from hazardline.params import REFERENCE_KT
from hazardline.session import scratch_path
from hazardline.sources.fixtures import fixture_sources, fixture_tables
from hazardline.sources.store import SnapshotTable
from tests.conftest import SF001


@pytest.mark.parametrize("event", [{}, {"mode": None}, {"mode": "daily"}, {"mode": "hourly", "dates": []}])
def test_missing_or_unknown_mode_raises(spark, event):
    with pytest.raises(ValueError):
        command.run_event(spark, event, "unused", "unused", "unused")


def test_hourly_needs_a_prediction_table(spark):
    with pytest.raises(ValueError, match="prediction"):
        command.run_event(spark, {"mode": "hourly", "knowledge_time": REFERENCE_KT}, fixture_tables(spark, SF001), "unused")


def test_weekly_then_hourly(spark):
    base, dates = fixture_tables(spark, SF001), ["2019-09-20", "2019-09-21"]
    survival, prediction = scratch_path(spark, "t-survival"), scratch_path(spark, "t-prediction")
    common = {"ship_dates": dates, "knowledge_time": REFERENCE_KT}
    curves = command.run_event(spark, {"mode": "weekly", **common}, base, survival, min_records=5)
    assert {str(r[0]) for r in curves.select("ship_date").distinct().collect()} == set(dates)
    out = command.run_event(spark, {"mode": "hourly", **common}, base, survival, prediction)
    assert {str(r[0]) for r in out.select("ship_date").distinct().collect()} == set(dates)
    for path, mode in ((survival, "weekly"), (prediction, "hourly")):
        m = SnapshotTable(spark, path).manifest()
        assert m.version == 1 and m.note == {"mode": mode, "knowledge_time": REFERENCE_KT}
    # one date again, at another knowledge time: the other keeps its folder
    before = SnapshotTable(spark, prediction).manifest().folders
    command.run(spark, ["hourly", "--source", base, "--survival", survival, "--prediction", prediction, "--ship-dates", dates[1],
                        "--sync", f"{SF001}/events.parquet=ts"])
    m = SnapshotTable(spark, prediction).manifest()
    assert m.folders[dates[0]] == before[dates[0]] and m.folders[dates[1]] != before[dates[1]]
    assert m.note["knowledge_time"].endswith(":00:00+00:00") and m.note["knowledge_time"] > "2019-09-21"


def test_gates_name_the_dates_and_nothing_is_replaced(spark):
    src, survival = fixture_sources(spark, SF001), scratch_path(spark, "t-gated")
    jobs.run_training_job(spark, src, reference_params(min_records=5, ship_dates=("2019-09-20",)), survival)
    table = SnapshotTable(spark, survival)
    before = table.manifest()
    # 2018: no delivery is old enough to train on; 2019-09-20 would have got new curves
    with pytest.raises(jobs.QualityGateError, match="training set for 2018-01-05"):
        jobs.run_training_job(spark, src, reference_params(min_records=5, ship_dates=("2018-01-05", "2019-09-20")), survival)
    with pytest.raises(jobs.QualityGateError, match="curve set for 2019-09-20"):
        jobs.run_training_job(spark, src, reference_params(min_records=10**6, ship_dates=("2019-09-20",)), survival)
    assert table.manifest() == before and len(table._names("data")) == 1
    assert table.read().filter(F.col("ship_date") == dt.date(2019, 9, 20)).count() > 0


def test_packed_curves_give_the_same_predictions(spark):
    base, dates = fixture_tables(spark, SF001), ["2019-09-20", "2019-09-21"]
    common = {"ship_dates": dates, "knowledge_time": REFERENCE_KT}
    out = {}
    for packed in (False, True):
        survival, prediction = scratch_path(spark, "t-survival"), scratch_path(spark, "t-prediction")
        stored = command.run_event(spark, {"mode": "weekly", **common}, base, survival, packed=packed, min_records=5)
        assert ("rates" in stored.columns) == packed
        rows = command.run_event(spark, {"mode": "hourly", **common}, base, survival, prediction)
        out[packed] = sorted(map(str, rows.collect()))
    assert out[True] and out[True] == out[False]
    with pytest.raises(ValueError, match="other columns"):   # a table keeps its form
        command.run_event(spark, {"mode": "weekly", **common}, base, survival, min_records=5)
