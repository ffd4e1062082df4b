"""Correction semantics: as-of grid equivalence, NULL flags, Q4 and Q8 cases."""

import datetime as dt

from pyspark.sql import functions as F

from hazardline.catalog.registry import reference_params
from hazardline.operators.actuals import actuals, actuals_bruteforce
from hazardline.operators.correction import corrected, final_prediction
from hazardline.params import RunParams
from hazardline.plans.dates import explicit_dates, plan_correction_dates
from hazardline.sources.fixtures import fixture_sources
from tests.conftest import SF001
from tests.handmade import at, d, skip, sources, ts, unskip


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_interval_form_equals_theta_join_on_fixture(spark):
    src = fixture_sources(spark, SF001)
    p = reference_params()
    t = plan_correction_dates(src, p)
    cols = ["ship_date", "checkpoint", "facility_id", "freight_id", "con", "cor", "coa", "orders"]
    assert same(actuals(src, p, t).select(cols), actuals_bruteforce(src, p, t).select(cols))


def _handmade(spark):
    orders = [(1, 10, 10, "O", d("2019-07-15"), ts("2019-07-10 10:30")),
              (2, 20, 20, "O", d("2019-07-15"), ts("2019-07-11 08:00")),
              (3, 30, 30, "O", d("2019-07-15"), ts("2019-07-12 09:00"))]
    dels = [(101, 1, d("2019-07-19"), 2, 1, 1, 6, True, ts("2019-07-10 10:30")),
            (102, 2, d("2019-07-19"), 2, 1, 1, 4, None, ts("2019-07-11 08:00")),      # NULL first flag
            (103, 3, d("2019-07-19"), 2, 2, 1, 9, False, ts("2019-07-12 09:00")),
            (203, 3, d("2019-07-26"), 3, 1, 2, 12, False, ts("2019-07-12 09:00"))]    # Q8: 2nd date
    logs = [at(skip(101), "2019-07-12 00:00"), at(unskip(101), "2019-07-12 00:00"),  # tie: dead wins
            at(unskip(101), "2019-07-13 05:15"),
            at(skip(102), "2019-07-14 02:00"), at(skip(103), "2019-07-13 00:00"), at(unskip(103), "2019-07-13 00:30")]
    return sources(spark, orders, dels, logs)


def test_interval_form_equals_theta_join_handmade(spark):
    src = _handmade(spark)
    p = RunParams(knowledge_time="2019-07-18T06:20:00+00:00")
    t = explicit_dates(spark, ["2019-07-19", "2019-07-26"])
    cols = ["ship_date", "checkpoint", "facility_id", "freight_id", "con", "cor", "coa", "orders"]
    a = actuals(src, p, t).select(cols)
    assert same(a, actuals_bruteforce(src, p, t).select(cols))
    # NULL first flag: in COA and ORDERS, in neither CON nor COR
    r = a.filter((F.col("checkpoint") == F.lit("2019-07-11 10:00:00").cast("timestamp"))
                 & (F.col("freight_id") == 1)).first()
    assert (r.con, r.cor, r.coa, r.orders) == (6, 0, 10, 2)
    # Q8: order 3's second delivery (facility 3) counts in ship date 07-19's actuals
    assert a.filter((F.col("ship_date") == "2019-07-19") & (F.col("facility_id") == 3)).count() > 0


def _frames(spark):
    fin = dt.datetime(2019, 7, 16, 21)
    rows, acts = [], []
    for h in range(-5, 81):
        cp = fin + dt.timedelta(hours=h)
        rows.append((d("2019-07-19"), cp, 2, 1, fin + dt.timedelta(days=3), fin, 10.0, 0.0, 10.0, 2.0))
        if h <= -2:
            acts.append((d("2019-07-19"), cp, 2, 1, 5, 3, 8, 2))
    pred = spark.createDataFrame(rows, "ship_date date, checkpoint timestamp, facility_id int, freight_id int, "
                                       "alignment_timestamp timestamp, finalization_timestamp timestamp, "
                                       "predicted_con double, predicted_cor double, predicted_coa double, "
                                       "predicted_orders double")
    act = spark.createDataFrame(acts, "ship_date date, checkpoint timestamp, facility_id int, freight_id int, "
                                      "con long, cor long, coa long, orders long")
    return fin, pred, act


def test_ratio_zero_prediction_and_freeze(spark):
    fin, pred, act = _frames(spark)
    out = {r.checkpoint: r for r in final_prediction(corrected(pred, act)).collect()}
    h = lambda n: fin + dt.timedelta(hours=n)
    # actual known: adjusted = actual; predicted COR 0 -> delta NULL, adjusted = actual
    assert out[h(-3)].adjusted_con == 5 and out[h(-3)].delta_cor is None and out[h(-3)].adjusted_cor == 3
    # after the last actual: predicted x last ratio (5/10)
    assert out[h(0)].adjusted_con == 5.0 and out[h(0)].delta_con == 0.5
    # frozen at the finalization value for 72 rows, then NULL
    assert out[h(72)].adjusted_con == 5.0
    assert out[h(73)].adjusted_con is None
    # COR: no prediction -> adjusted stays the (NULL) actual after actuals stop
    assert out[h(10)].adjusted_cor is None


def test_strict_knowledge_time_option(spark):
    """Q6: by default the correction's cohorts include orders created after KT (as the
    reference does); strict_knowledge_time drops them."""
    from hazardline.operators.facts import delivery_ordinals
    orders = [(1, 10, 10, "O", d("2019-07-15"), ts("2019-07-10 10:30")),
              (2, 20, 20, "O", d("2019-07-15"), ts("2019-07-17 08:00"))]   # created after KT
    dels = [(101, 1, d("2019-07-19"), 2, 1, 1, 6, True, ts("2019-07-10 10:30")),
            (102, 2, d("2019-07-19"), 2, 1, 1, 4, True, ts("2019-07-17 08:00"))]
    orders.append((3, 20, 20, "O", d("2019-07-08"), ts("2019-07-01 08:00")))  # makes sub 20 known at KT
    dels.append((103, 3, d("2019-07-12"), 2, 1, 1, 4, True, ts("2019-07-01 08:00")))
    src = sources(spark, orders, dels, [])
    t = explicit_dates(spark, ["2019-07-19"])
    loose = RunParams(knowledge_time="2019-07-16T00:00:00+00:00")
    assert {r.weekly_order_id for r in delivery_ordinals(src, loose, t).collect()} == {1, 2}
    strict = loose.with_(strict_knowledge_time=True)
    assert {r.weekly_order_id for r in delivery_ordinals(src, strict, t).collect()} == {1}
