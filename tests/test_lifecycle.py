"""Death time, finalization cut, and batch == date-by-date."""

import datetime as dt

from hazardline import jobs
from hazardline.operators.lifecycle import death_times
from hazardline.params import RunParams
from tests.handmade import d, skip, sources, ts

EV = "ship_date string, weekly_order_id long, event_time timestamp, order_is_alive boolean"


def deaths(spark, rows):
    df = spark.createDataFrame([("s", 1, ts(t), a) for t, a in rows], EV)
    return death_times(df).first().death_time


def test_dead_never_alive(spark):
    assert deaths(spark, [("2019-01-01 05:00", False), ("2019-01-01 07:00", False)]) == ts("2019-01-01 05:00")


def test_dead_alive_dead_dead(spark):
    rows = [("2019-01-01 01:00", False), ("2019-01-01 02:00", True), ("2019-01-01 03:00", False),
            ("2019-01-01 04:00", False)]
    assert deaths(spark, rows) == ts("2019-01-01 03:00")


def test_tie_dead_wins_and_alive_last(spark):
    assert deaths(spark, [("2019-01-01 01:00", True), ("2019-01-01 01:00", False)]) == ts("2019-01-01 01:00")
    assert deaths(spark, [("2019-01-01 01:00", False), ("2019-01-01 02:00", True)]) is None


def _one_order(spark, skip_at):
    # ship date Friday 2019-07-19, facility 2 (US/Eastern): finalization 2019-07-16 21:00Z
    orders = [(1, 10, 10, "O", d("2019-07-15"), ts("2019-07-10 10:00"))]
    dels = [(101, 1, d("2019-07-19"), 2, 1, 1, 6, True, ts("2019-07-10 10:00"))]
    logs = [(lambda r: r[:2] + (ts(skip_at),) + r[3:])(skip(101))]
    return sources(spark, orders, dels, logs)


def test_event_at_finalization_is_excluded(spark):
    p = RunParams(knowledge_time="2019-07-30T00:00:00+00:00", ship_dates=("2019-07-19",), min_records=1)
    src = _one_order(spark, "2019-07-16 21:00:00")
    life = jobs.training_plan(spark, src, p).lifespans.first()
    assert life.died_bool is False and life.lifespan == 6 * 24 + 11  # 07-10 10:00 -> 07-16 21:00
    src = _one_order(spark, "2019-07-16 20:59:59")
    life = jobs.training_plan(spark, src, p).lifespans.first()
    assert life.died_bool is True and life.lifespan == 6 * 24 + 10


def test_batch_equals_date_by_date(spark):
    from tests.conftest import SF001
    from hazardline.catalog.registry import reference_params
    from hazardline.sources.fixtures import fixture_sources
    src = fixture_sources(spark, SF001)
    p = reference_params(min_records=5)
    batch = jobs.train(spark, src, p)
    dates = sorted(r.ship_date.isoformat() for r in batch.select("ship_date").distinct().collect())
    assert len(dates) >= 2
    single = None
    for day in dates:
        c = jobs.train(spark, src, p.with_(ship_dates=(day,)))
        single = c if single is None else single.unionByName(c)
    assert batch.exceptAll(single).count() == 0 and single.exceptAll(batch).count() == 0
    assert dt.date.fromisoformat(dates[0]).year == 2019
