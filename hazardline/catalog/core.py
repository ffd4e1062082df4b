"""Headline keys: the two jobs' main outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardline import jobs
from hazardline import oracle as O
from hazardline.catalog.registry import correction, present, query, setup, training
from hazardline.session import scratch_path


@query("training_set", O.training_sql(
    "SELECT target AS ship_date, lifespan, died_bool, grp, CAST(weight AS BIGINT) AS weight FROM tw_rows"))
def q_training_set(spark, sf_dir):
    return training(spark, sf_dir)[2].training


@query("kaplan_meier", O.training_sql(
    "SELECT target AS ship_date, grp, timeline, round(survival_rate, 9) AS survival_rate FROM km_curve"))
def q_kaplan_meier(spark, sf_dir):
    return present(training(spark, sf_dir)[2].curves)


@query("actuals", O.correction_sql(
    "SELECT ship_date, checkpoint, facility_id, freight_id, con, cor, coa, orders FROM cr_actuals"))
def q_actuals(spark, sf_dir):
    return present(correction(spark, sf_dir)[2].actuals)


@query("predicted", O.correction_sql(
    "SELECT ship_date, checkpoint, facility_id, freight_id, alignment_timestamp, finalization_timestamp, "
    + O.rounded(("predicted_con", "predicted_cor", "predicted_coa", "predicted_orders")) + " FROM cr_predicted"))
def q_predicted(spark, sf_dir):
    return present(correction(spark, sf_dir)[2].predicted)


@query("corrected", O.correction_sql(
    "SELECT ship_date, checkpoint, facility_id, freight_id, con, cor, coa, orders, "
    + O.rounded(("predicted_con", "predicted_cor", "predicted_coa", "predicted_orders", "delta_con",
                 "adjusted_con", "delta_cor", "adjusted_cor", "delta_coa", "adjusted_coa")) + " FROM cr_corrected"))
def q_corrected(spark, sf_dir):
    c = correction(spark, sf_dir)[2].corrected
    return present(c.drop("alignment_timestamp", "finalization_timestamp"))


@query("final_prediction", O.correction_sql("SELECT " + O.rounded(O.FINAL_COLUMNS) + " FROM cr_final"))
def q_final_prediction(spark, sf_dir):
    return present(correction(spark, sf_dir)[2].final)


# Back-test with explicit ship dates = every ship date present in the data.
@query("backtest", O.training_sql(
    "SELECT target AS ship_date, grp, timeline, round(survival_rate, 9) AS survival_rate FROM km_curve",
    targets_cte="tw_targets AS (SELECT DISTINCT ship_date AS target FROM deliveries)"))
def q_backtest(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    targets = src.deliveries.select("ship_date").distinct()
    return present(jobs.train(spark, src, p, targets))


@query("group_quality_counts", O.training_sql("""
    SELECT target AS ship_date, CAST(count(*) AS BIGINT) AS groups,
           CAST(sum(CASE WHEN records >= 100 THEN 1 ELSE 0 END) AS BIGINT) AS kept,
           CAST(sum(CASE WHEN records < 100 THEN 1 ELSE 0 END) AS BIGINT) AS excluded
    FROM (SELECT target, grp, count(*) AS records FROM tw_rows WHERE grp IS NOT NULL GROUP BY 1, 2) g
    GROUP BY 1"""))
def q_group_quality_counts(spark, sf_dir):
    from hazardline.operators.training import group_quality_counts
    _, p, t = training(spark, sf_dir)
    return group_quality_counts(t.training, p.min_records)


@query("quality_gate", O.training_sql(
    "SELECT target AS ship_date, grp, timeline, round(survival_rate, 9) AS survival_rate FROM km_curve "
    "WHERE target IN (SELECT target FROM tw_rows)"))
def q_quality_gate(spark, sf_dir):
    """The curves, once it is known that every planned date has training rows and curves; both are told by the job
    that writes the curves.  A date without raises."""
    src, p, _ = training(spark, sf_dir)
    return present(jobs.run_training_job(spark, src, p, scratch_path(spark, "gated")).select(
        "ship_date", "grp", "timeline", F.col("survival_rate").cast("double").alias("survival_rate")))
