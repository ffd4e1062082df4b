"""The back-test of many runs in one job against one correction per run, on random histories and on the fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardline import jobs
from hazardline.operators.backtest import Runs, backtest_plan
from tests.conftest import SF001
from tests.handmade import sources
from tests.test_rules import KT, TARGETS, histories, params

TIMES = [KT, KT - dt.timedelta(days=6, hours=5), KT + dt.timedelta(days=3)]


@pytest.fixture(scope="module")
def src(spark):
    """Random histories in which every third delivery was recorded days after its order, so after some of its events."""
    orders, dels, logs = histories(3)
    born = {o[0]: o[5] for o in orders}
    late = [(*d[:-1], (born[d[1]] or KT) + dt.timedelta(days=d[0] % 5, hours=d[0] % 7)) if d[0] % 3 == 0 else d for d in dels]
    return sources(spark, orders, late, logs)


def rows(df):
    df = df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in df.dtypes])
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("strict", [False, True])
def test_each_run_equals_a_correction_of_its_own(spark, src, strict):
    now = KT + dt.timedelta(days=2)      # before the last KT: the clock bounds its grid
    curves = jobs.train(spark, src, params()).cache()
    p = params(strict_knowledge_time=strict).with_(now=now)
    # every date has another subset of the times
    pairs = [(d, t) for i, d in enumerate(TARGETS) for j, t in enumerate(TIMES) if (i + j) % 3]
    plan = backtest_plan(src, p, Runs.of(pairs), curves)
    got = {what: getattr(plan, what).cache() for what in (("cohorts", "actuals") if strict else ("cohorts", "final", "actuals"))}
    total = dict.fromkeys(got, 0)
    for t in TIMES:
        dates = tuple(str(d) for d, x in pairs if x == t)
        one = jobs.correction_plan(spark, src, p.with_(knowledge_time=t, ship_dates=dates), curves)
        for what, df in got.items():
            mine = rows(df.filter(F.col("knowledge_time") == F.lit(t)).drop("knowledge_time"))
            assert mine == rows(getattr(one, what)), (what, t)
            total[what] += len(mine)
    assert all(n > 50 for n in total.values()), total
    for what, df in got.items():
        assert df.count() == total[what]


def test_late_records_are_among_them(spark, src):
    """Some events lie before their delivery's creation, so the rows multiplied by runs are tested too."""
    from hazardline.functions.timefn import ceil_hour
    from hazardline.operators.backtest import run_events
    ev = run_events(src, params(), Runs.of([(d, t) for d in TARGETS for t in TIMES]))
    assert ev.filter(F.col("known_from") > ceil_hour("event_time")).count() > 5


def test_runs():
    r = Runs.of([("2019-09-20", "2019-09-17T16:00:00Z"), (dt.date(2019, 9, 20), "2019-09-17T16:00:00+00:00"), ("2019-09-21", "2019-09-17T17:00Z")])
    assert len(r.pairs) == 2 and len(r.times) == 2 and r.dates == [dt.date(2019, 9, 20), dt.date(2019, 9, 21)]


def test_no_run_is_refused(spark, src):
    with pytest.raises(ValueError, match="at least one"):
        jobs.backtest_correct(spark, src, params(), [])


def test_status_log_is_scanned_once_whatever_the_runs(spark):
    from hazardline.sources.fixtures import fixture_sources
    src = fixture_sources(spark, SF001)
    runs = Runs.of([(dt.date(2019, 9, 20) + dt.timedelta(days=i), dt.datetime(2019, 9, 10 + j)) for i in range(3) for j in range(5)])
    from hazardline.operators.backtest import run_actuals
    text = run_actuals(src, params(), runs)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet [object_type") == 1
