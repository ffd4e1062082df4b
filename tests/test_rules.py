"""Both jobs on random histories with what the fixture never has, against the DuckDB definitions on the same rows:
several deliveries per order (one day, same weekday, other weekdays), real ids 0, repeated events, NULL creation times,
plans, freights, tenures and flags, facilities without a zone, JSON null and missing statuses, unknown dimensions."""

import datetime as dt
import random
import re

import duckdb
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazardline import jobs
from hazardline import oracle as O
from hazardline.params import RunParams
from hazardline.sources.tables import Sources, timezones_frame
from tests.handmade import DIM, DL, EL, FAC, OLD, WO

KT = dt.datetime(2019, 8, 20, 16)
TARGETS = [dt.date(2019, 8, 16), dt.date(2019, 8, 23), dt.date(2019, 8, 24), dt.date(2019, 7, 26)]
CHANGES = ['{"status":["open","skipped_open"]}', '{"status":["open","not_paid"]}', '{"status":["skipped_open","open"]}',
           '{"status":["open",null]}', '{"note":["a","b"]}', '{"status":["open"]}', '{}']


def histories(seed):
    rnd = random.Random(seed)
    orders, dels, logs = [], [], []
    for k in range(400):
        sub = rnd.choice([None, 0, 1, 2, 3, 1000 + k, 1000 + k, 1000 + k])
        day = dt.date(2019, 6, 28) + dt.timedelta(days=rnd.choice([0, 7, 14, 21, 28, 35, 42, 49, 56, 57, 15, 1]))
        born = dt.datetime.combine(day, dt.time(17)) - dt.timedelta(days=rnd.choice([2, 4, 6, 9, 20, 40]), minutes=rnd.randrange(600))
        if rnd.random() < 0.03:
            born = None
        start = day - dt.timedelta(days=day.weekday())
        orders.append((k, sub, sub, "O", start, born))
        n = rnd.choice([1, 1, 1, 1, 2, 3, 0])
        for j in range(n):
            ship = day + dt.timedelta(days=rnd.choice([0, 0, 7, 7, 14, 1]) * (j > 0))
            made = None if rnd.random() < 0.05 else (born or KT) + dt.timedelta(days=rnd.choice([0, 0, 0, 60]))
            did = 10 * k + j
            dels.append((did, k, ship, rnd.choice([1, 2, 3, 2, 4]), rnd.choice([1, 2, 0, None, 1, 1]), rnd.choice([1, 2, 0, 1, 3, 9]),
                         rnd.choice([4, 6, None]), rnd.choice([True, False, None]), made))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                at = (born or KT) + dt.timedelta(hours=rnd.choice([0, 1, 5, 24, 48, 100, 400]))
                row = (rnd.choice(["deliveries", "deliveries", "leads"]), did, at, rnd.choice(CHANGES))
                logs += [row] * rnd.choice([1, 1, 2])
    return orders, dels, logs


@pytest.fixture(scope="module", params=[1, 2])
def both(spark, request):
    """(sources, DuckDB connection) over the same rows."""
    orders, dels, logs = histories(request.param)
    plans = [(0, "p", OLD), (1, "p", OLD), (2, "p", None), (3, "p", dt.datetime(2030, 1, 1))]
    freights, facilities = [(i, "f", OLD) for i in (0, 1, 2)], [(i, "c", OLD) for i in (1, 2, 3, 4)]
    tables = {"weekly_orders": (orders, WO), "deliveries": (dels, DL), "event_logs": (logs, EL), "plans": (plans, DIM),
              "freights": (freights, DIM), "facilities": (facilities, FAC)}
    con = duckdb.connect()
    frames = {}
    for name, (rows, schema) in tables.items():
        frames[name] = spark.createDataFrame(rows, schema)
        types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "date": pa.date32(), "timestamp": pa.timestamp("us"), "boolean": pa.bool_()}
        table = pa.table({f.name: pa.array([r[i] for r in rows], types[f.dataType.simpleString()]) for i, f in enumerate(schema)})
        con.register(f"{name}_rows", table)
        con.execute(f"CREATE TABLE {name} AS FROM {name}_rows")
    con.execute("CREATE TABLE timezones AS SELECT * FROM (VALUES (1, 'US/Arizona'), (2, 'US/Eastern'), (3, 'US/Eastern')) AS t(facility_id, facility_timezone)")
    return Sources(**frames, timezones=timezones_frame(spark)), con


def params(**kw):
    return RunParams(knowledge_time=KT, now=KT, ship_dates=tuple(map(str, TARGETS)), training_weeks=4, min_records=3, **kw)


PARAMS = O.params_cte(kt=f"TIMESTAMP '{KT}'", weeks=4, min_records=3)
DATES = ", ".join(f"(DATE '{d}')" for d in TARGETS)


def expected(con, ctes, body, key):
    sql = "WITH " + ",\n".join([PARAMS, f"{key} AS (SELECT * FROM (VALUES {DATES}) AS t(target))", *ctes]) + "\n" + body
    return con.sql(sql).df()


def same(got: pd.DataFrame, want: pd.DataFrame):
    assert sorted(got.columns) == sorted(want.columns)

    def text(v):
        if pd.isna(v):
            return ""
        if isinstance(v, (dt.date, dt.datetime)):
            return pd.Timestamp(v).isoformat()
        return f"{float(v):.7g}" if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "if" else str(v)
    rows = [sorted(tuple(map(text, r)) for r in x[sorted(x.columns)].itertuples(index=False)) for x in (got, want)]
    assert rows[0] == rows[1]
    return len(rows[0])


@pytest.mark.parametrize("what, columns, body", [
    ("deaths", "ship_date, weekly_order_id, death_time", "SELECT target AS ship_date, weekly_order_id, death_time FROM tw_death"),
    ("facts", "ship_date, weekly_order_id, delivery_id, user_tenure, source_date, finalization_timestamp",
     "SELECT target AS ship_date, weekly_order_id, delivery_id, user_tenure, source_date, finalization_timestamp FROM tw_deliveries"),
    ("lifespans", "ship_date, weekly_order_id, facility_id, freight_id, plan_id, user_tenure, lifespan, died_bool",
     "SELECT target AS ship_date, weekly_order_id, facility_id, freight_id, plan_id, user_tenure, lifespan, died_bool FROM tw_life"),
    ("training", "ship_date, lifespan, died_bool, grp, weight", "SELECT target AS ship_date, lifespan, died_bool, grp, weight FROM tw_rows"),
    ("curves", "ship_date, grp, timeline, survival_rate", "SELECT target AS ship_date, grp, timeline, survival_rate FROM km_curve"),
])
def test_training(spark, both, what, columns, body):
    src, con = both
    plan = jobs.training_plan(spark, src, params())
    cols = [c.strip() for c in columns.split(",")]
    got = getattr(plan, what).select(*[F.col(c).cast("timestamp_ntz") if c.endswith(("time", "timestamp")) else F.col(c) for c in cols])
    want = expected(con, O.TRAINING_CTES, body, "tw_targets")
    if what == "curves":   # a real id 0 and the rolled-up 0 share a key: both sides have the rows of both under it
        want = want.drop_duplicates()
        got = got.distinct()
    assert same(got.toPandas(), want) > 50


def test_orders_with_several_deliveries_are_among_them(spark, both):
    src, _ = both
    lives = jobs.training_plan(spark, src, params()).lives
    assert lives.filter("target IS NOT NULL").count() > 20 and lives.filter("target IS NULL").count() > 20


def test_actuals_and_cohorts(spark, both):
    src, con = both
    plan = jobs.correction_plan(spark, src, params())
    ctes = [O.CORRECTION_CTES[0], *O.TRAINING_CTES, *O.CORRECTION_CTES[1:]]
    got = plan.actuals.select("ship_date", F.col("checkpoint").cast("timestamp_ntz").alias("checkpoint"), "facility_id", "freight_id", "coa", "orders")
    want = expected(con, ctes, "SELECT ship_date, checkpoint, facility_id, freight_id, coa, orders FROM cr_actuals", "cr_targets")
    assert same(got.toPandas(), want) > 50
    got = plan.cohorts.select("ship_date", F.col("birth_hour").cast("timestamp_ntz").alias("birth_hour"), "facility_id", "freight_id", "plan_id", "tenure", "number_of_meals", "is_first_for_subscription", "orders", "grp")
    want = expected(con, ctes, "SELECT ship_date, birth_hour, facility_id, freight_id, plan_id, tenure, number_of_meals, is_first_for_subscription, orders, grp FROM cr_cohorts", "cr_targets")
    assert same(got.toPandas(), want) > 50


def test_one_scan_of_the_log_and_no_shuffled_dates(spark):
    """The executed training plan reads event_logs once, and no fact is exchanged on (ship_date, facility_id)."""
    from hazardline.sources.fixtures import fixture_sources
    from tests.conftest import SF001
    src = fixture_sources(spark, SF001)
    df = jobs.train(spark, src, params(), None)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[object_type[^\n]*", text)) == 1
    assert not re.search(r"hashpartitioning\((ship_date|source_date)#\d+, facility_id", text)
    assert re.search(r"hashpartitioning\(weekly_order_id", text)
