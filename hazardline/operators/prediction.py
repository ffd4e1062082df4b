"""D9 birth cohorts, D10 expected survivors by checkpoint.

The curve choice is made once per cohort group: its own curve when one was
trained, else the facility-wide (freight 0) curve, else the group drops out
(SURVEY Q15).  Every stored curve has all timeline points, so this equals the
reference's per-timeline COALESCE of two left joins.  Cohorts are reduced to
linear weights (orders x meals per first/recurring) before they meet the
curves.  A curve travels as one row with its rates in an array; what is
multiplied by the timeline is already joined and is summed up in the same task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.keys import fallback_group_key, group_key
from hazardline.functions.timefn import add_hours
from hazardline.operators.survival import curve_keys, pack

COHORT_KEYS = ("ship_date", "birth_hour", "facility_id", "freight_id", "plan_id", "tenure",
               "is_first_for_subscription", "alignment_timestamp", "finalization_timestamp",
               "number_of_meals")


def birth_cohorts(ordinals: DataFrame) -> DataFrame:
    """D9 / A4 distinct orders per cohort (birth hour x group x first flag x meals)."""
    return (ordinals.groupBy(*COHORT_KEYS)
            .agg(F.count_distinct("weekly_order_id").alias("orders"))
            .withColumn("grp", group_key("facility_id", "freight_id", "plan_id", "tenure")))


def cohort_weights(cohorts: DataFrame, run_keys=()) -> DataFrame:
    """Collapse the first flag and meal count into the four linear weights of A8."""
    first = F.col("is_first_for_subscription")
    om = F.col("orders") * F.col("number_of_meals")
    return (cohorts.filter(F.col("grp").isNotNull())
            .groupBy(*run_keys, "ship_date", "birth_hour", "facility_id", "freight_id", "plan_id", "tenure",
                     "alignment_timestamp", "finalization_timestamp")
            .agg(F.sum(F.when(first, om).otherwise(F.lit(0))).alias("w_con"),
                 F.sum(F.when(~first, om).otherwise(F.lit(0))).alias("w_cor"),
                 F.sum(om).alias("w_coa"),
                 F.sum("orders").alias("w_orders")))


def choose_curves(weights: DataFrame, curves: DataFrame, by=("ship_date",)) -> DataFrame:
    """``curve_grp``, the curve each cohort group uses (own, else freight-0 fallback, else dropped); ``by`` tells sets of
    curves apart.  Which curves exist is read off the keys of packed curves, without their rates."""
    avail = curve_keys(curves, by)
    own = avail.select(*by, "grp", F.col("grp").alias("own_grp"))
    fb = avail.select(*by, F.col("grp").alias("fallback_grp"), F.col("grp").alias("fb_grp"))
    x = (weights.withColumn("grp", group_key("facility_id", "freight_id", "plan_id", "tenure"))
         .withColumn("fallback_grp", fallback_group_key("facility_id", "plan_id", "tenure")))
    x = x.join(own, [*by, "grp"], "left").join(fb, [*by, "fallback_grp"], "left")
    return (x.withColumn("curve_grp", F.coalesce(F.col("own_grp"), F.col("fb_grp")))
            .filter(F.col("curve_grp").isNotNull())
            .drop("own_grp", "fb_grp"))


def with_rates(chosen: DataFrame, curves: DataFrame, by=("ship_date",)) -> DataFrame:
    """Cohorts with the ``rates`` of their ``curve_grp``; each curve meets them as one row."""
    return chosen.join(pack(curves, by).select(*by, F.col("grp").alias("curve_grp"), "rates"), [*by, "curve_grp"])


def rates_until(bound) -> Column:
    """(timeline, survival_rate) of the points t with birth_hour + t hours <= ``bound``: later ones are never generated."""
    hours = F.floor((F.unix_seconds(F.col(bound)) - F.unix_seconds("birth_hour")) / 3600) + 1
    n = F.greatest(F.lit(0), F.least(F.size("rates"), hours)).cast("int")
    return F.posexplode(F.slice("rates", F.lit(1), n)).alias("timeline", "survival_rate")


def predicted(cohorts: DataFrame, curves: DataFrame, run_keys=()) -> DataFrame:
    """D10 -> (ship_date, checkpoint, facility_id, freight_id, alignment, finalization, 4 predictions).

    checkpoint = birth_hour + (t + 1)h while the bound uses birth_hour + t (SURVEY Q3, kept).  Curves that have the
    ``run_keys`` too are each run's own; others serve all runs for their ship date.
    """
    by = ["ship_date", *[k for k in run_keys if k in curves.columns]]
    x = with_rates(choose_curves(cohort_weights(cohorts, run_keys), curves, by), curves, by)
    j = (x.select("*", rates_until("alignment_timestamp"))
         .filter(F.col("survival_rate").isNotNull())
         .withColumn("checkpoint", add_hours("birth_hour", F.col("timeline") + 1)))
    r = F.col("survival_rate")
    return (j.groupBy(*run_keys, "ship_date", "alignment_timestamp", "finalization_timestamp", "checkpoint",
                      "facility_id", "freight_id")
            .agg(F.sum(F.col("w_con") * r).alias("predicted_con"),
                 F.sum(F.col("w_cor") * r).alias("predicted_cor"),
                 F.sum(F.col("w_coa") * r).alias("predicted_coa"),
                 F.sum(F.col("w_orders") * r).alias("predicted_orders")))
