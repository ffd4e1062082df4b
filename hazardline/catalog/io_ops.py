"""Source/sink keys: each writes under the shared checkpoint folder and reads back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardline import command, jobs
from hazardline import oracle as O
from hazardline.catalog.registry import correction, present, query, setup, training
from hazardline.operators.lifecycle import order_state_snapshot
from hazardline.oracle_fixtures import with_fixtures
from hazardline.params import REFERENCE_KT, instant_lit
from hazardline.session import ensure_utc, scratch_path
from hazardline.sources import sinks
from hazardline.sources.fixtures import fixture_tables
from hazardline.sources.store import SnapshotTable

KM_SQL = O.training_sql(
    "SELECT target AS ship_date, grp, timeline, round(survival_rate, 9) AS survival_rate FROM km_curve")
FINAL_SQL = O.correction_sql("SELECT " + O.rounded(O.FINAL_COLUMNS) + " FROM cr_final")


def _curves_readback(df):
    return present(df.select("ship_date", "grp", "timeline",
                             F.col("survival_rate").cast("double").alias("survival_rate")))


def _decimals_to_double(df):
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


@query("create_sink", KM_SQL)
def q_create_sink(spark, sf_dir):
    """Create the typed survival table if absent (twice: the second time nothing happens), store the curves, read
    the table back."""
    _, _, t = training(spark, sf_dir)
    table = SnapshotTable(spark, scratch_path(spark, "survival_table"))
    table.create(sinks.SURVIVAL_SCHEMA, "ship_date")
    table.create(sinks.SURVIVAL_SCHEMA, "ship_date")
    table.replace(sinks.survival_rows(t.curves))
    return _curves_readback(table.read())


@query("decimal_store", O.training_sql(
    "SELECT target AS ship_date, grp, timeline, "
    "CAST(round(CAST(survival_rate AS DECIMAL(17,15)), 9) AS DOUBLE) AS survival_rate FROM km_curve"))
def q_decimal_store(spark, sf_dir):
    """rates rounded into DECIMAL(17,15) as stored."""
    c = sinks.survival_rows(training(spark, sf_dir)[2].curves)
    return c.select("ship_date", "grp", "timeline",
                    F.round("survival_rate", 9).cast("double").alias("survival_rate"))


@query("replace_partition", KM_SQL)
def q_replace_partition(spark, sf_dir):
    """Store every date, then the even days of the month again in one commit; the other dates keep their
    files and no date has its rows twice."""
    c = sinks.survival_rows(training(spark, sf_dir)[2].curves)
    table = SnapshotTable(spark, scratch_path(spark, "survival_parts"))
    table.create(sinks.SURVIVAL_SCHEMA, "ship_date")
    table.replace(c)
    table.replace(table.read().filter("day(ship_date) % 2 = 0"))
    return _curves_readback(table.read())


@query("parquet_export", KM_SQL)
def q_parquet_export(spark, sf_dir):
    c = sinks.survival_rows(training(spark, sf_dir)[2].curves)
    path = scratch_path(spark, "survival_export")
    sinks.export_parquet(c, path)
    return _curves_readback(spark.read.parquet(path))


def _command(spark, sf_dir, mode, survival, *more):
    """The command as a user submits it, over the fixture tables."""
    sync = [f"{sf_dir.rstrip('/')}/{t}.parquet={c}" for t, c in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    return command.run(spark, [mode, "--source", fixture_tables(spark, sf_dir), "--survival", survival, "--sync", *sync, *more])


@query("job_train", KM_SQL)
def q_job_train(spark, sf_dir):
    """D15 training job by its command: plan -> curves -> gates -> one commit."""
    ensure_utc(spark)
    return _curves_readback(_command(spark, sf_dir, "weekly", scratch_path(spark, "job_train"), "--knowledge-time", REFERENCE_KT))


@query("job_correct", FINAL_SQL)
def q_job_correct(spark, sf_dir):
    """D15 correction job by its command, after the training of its dates: curves come from the stored survival table."""
    src, p = setup(spark, sf_dir)
    curve_path = scratch_path(spark, "job_curves")
    dates = [str(d) for d in jobs.requested_dates(jobs.target_dates(spark, src, p, "correct"))]
    _command(spark, sf_dir, "weekly", curve_path, "--knowledge-time", REFERENCE_KT, "--ship-dates", *dates)
    out = _command(spark, sf_dir, "hourly", curve_path, "--knowledge-time", REFERENCE_KT,
                   "--prediction", scratch_path(spark, "job_predictions"))
    return present(_decimals_to_double(out).select(*O.FINAL_COLUMNS))


@query("job_correct_default_time", O.correction_sql(
    "SELECT " + O.rounded(O.FINAL_COLUMNS) + " FROM cr_final",
    targets_cte="cr_targets AS (SELECT DISTINCT ship_date AS target FROM deliveries WHERE ship_date BETWEEN DATE '2019-09-09' AND DATE '2019-09-15')",
    kt="(SELECT date_trunc('hour', max(synced)) FROM sync_times)"))
def q_job_correct_default_time(spark, sf_dir):
    """D15 without a knowledge time, for a week of explicit dates: training takes now, the correction the last complete synced hour
    (all of the fixture is known at either)."""
    ensure_utc(spark)
    curve_path = scratch_path(spark, "job_curves")
    dates = ["--ship-dates", *[f"2019-09-{d:02d}" for d in range(9, 16)]]
    _command(spark, sf_dir, "weekly", curve_path, *dates)
    out = _command(spark, sf_dir, "hourly", curve_path, *dates, "--prediction", scratch_path(spark, "job_predictions"))
    return present(_decimals_to_double(out).select(*O.FINAL_COLUMNS))


@query("csv_write", O.training_sql(
    "SELECT target AS ship_date, lifespan, died_bool, grp, CAST(weight AS BIGINT) AS weight FROM tw_rows"))
def q_csv_write(spark, sf_dir):
    """The training set as CSV with a header (NULL group keys as empty fields), read back."""
    t = training(spark, sf_dir)[2].training
    path = scratch_path(spark, "training_csv")
    sinks.write_csv(t, path)
    schema = T.StructType([T.StructField("ship_date", T.DateType()), T.StructField("lifespan", T.LongType()),
                           T.StructField("died_bool", T.BooleanType()), T.StructField("grp", T.StringType()),
                           T.StructField("weight", T.LongType())])
    return sinks.load_csv_strict(spark, path, schema)


@query("csv_bulk_load", FINAL_SQL)
def q_csv_bulk_load(spark, sf_dir):
    """Predictions through CSV and a strict, positional, typed load."""
    final = correction(spark, sf_dir)[2].final
    path = scratch_path(spark, "prediction_csv")
    sinks.write_csv(sinks.prediction_rows(final), path)
    loaded = sinks.load_csv_strict(spark, path, sinks.PREDICTION_SCHEMA)
    return present(_decimals_to_double(loaded))


UPSERT_SQL = with_fixtures(O.params_cte(), """ev AS (
    SELECT wo.id AS weekly_order_id, wo.created_at AS event_time, TRUE AS order_is_alive, wo.created_at AS known_at
    FROM weekly_orders wo
    UNION ALL
    SELECT d.weekly_order_id, el.created_at, """ + O.status_alive("el.change_set") + """, el.created_at
    FROM event_logs el JOIN deliveries d ON el.object_type = 'deliveries' AND el.object_id = d.id
    WHERE """ + O.status_present("el.change_set") + """
)""", """snap_old AS (
    SELECT weekly_order_id, max(event_time) AS state_time,
           arg_max(order_is_alive, (event_time, NOT order_is_alive)) AS order_is_alive
    FROM ev, params WHERE known_at <= params.kt - INTERVAL 7 DAY
      AND weekly_order_id IN (SELECT id FROM weekly_orders, params WHERE created_at <= params.kt - INTERVAL 7 DAY)
    GROUP BY 1
)""", """snap_new AS (
    SELECT weekly_order_id, max(event_time) AS state_time,
           arg_max(order_is_alive, (event_time, NOT order_is_alive)) AS order_is_alive
    FROM ev, params WHERE known_at <= params.kt
      AND weekly_order_id IN (SELECT id FROM weekly_orders, params WHERE created_at <= params.kt)
    GROUP BY 1
)""", body="""
    SELECT n.* FROM snap_new n, params WHERE n.state_time > params.kt - INTERVAL 7 DAY
    UNION ALL
    SELECT o.* FROM snap_old o WHERE o.weekly_order_id NOT IN (
        SELECT n.weekly_order_id FROM snap_new n, params WHERE n.state_time > params.kt - INTERVAL 7 DAY)""")


@query("upsert_by_key", UPSERT_SQL)
def q_upsert_by_key(spark, sf_dir):
    """Order states stored a week before KT in a table bucketed by order id, then the states that changed since
    upserted into it (incoming rows win); the stored table is read back."""
    src, p = setup(spark, sf_dir)
    week_before = instant_lit(p.kt - dt.timedelta(days=7))
    old = order_state_snapshot(src, week_before)
    table = SnapshotTable(spark, scratch_path(spark, "order_states"))
    table.create(old.schema, keys=["weekly_order_id"], buckets=16)
    table.upsert(old)
    table.upsert(order_state_snapshot(src, p.kt_col()).filter(F.col("state_time") > week_before))
    return present(table.read())
