"""D5 training set at four grouping levels (A5 + A6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.functions.keys import group_key, tenure_training
from hazardline.operators.lifecycle import per_target
from hazardline.params import LEVELS
from hazardline.plans.dates import Calendar


def _levels():
    frt, plan = F.col("freight_id"), F.col("plan_id")
    return F.array(*[
        F.struct(F.lit(level).alias("level"), (frt if kf else F.lit(0)).cast("int").alias("frt_k"),
                 (plan if kp else F.lit(0)).cast("int").alias("plan_k"))
        for level, (kf, kp) in enumerate(LEVELS)])


def training_set(lifespans: DataFrame) -> DataFrame:
    """Distinct orders per (ship_date, lifespan, died, grp) at the four levels.

    One Generate replaces the reference's four scans + UNION ALL (what a
    GROUPING SETS Expand does); the rolled-up part is the literal 0, so a NULL
    key part still yields a NULL key (dropped later) exactly as in the reference.
    """
    x = lifespans.select("ship_date", "lifespan", "died_bool", "facility_id", "weekly_order_id",
                         tenure_training("user_tenure").alias("tenure"), F.inline(_levels()))
    x = x.withColumn("grp", group_key("facility_id", "frt_k", "plan_k", "tenure"))
    # by level too: a real id 0 must not fall together with the rolled-up 0
    return (x.groupBy("ship_date", "lifespan", "died_bool", "grp", "level")
            .agg(F.count_distinct("weekly_order_id").alias("weight")).drop("level"))


def training_counts(lives: DataFrame, calendar: Calendar) -> DataFrame:
    """D5 of lifespans whose rows are not multiplied by targets and levels yet.

    ``first_0`` .. ``first_3`` of a row say whether it is the one that counts its order in its cell at a level, so distinct orders
    are plain sums.  They are summed at the finest level per source date before anything is multiplied: what is multiplied by
    targets and levels, and shuffled once more, are cells, whose number is bounded by dates x lifespans x groups.  That shuffle
    is on the curve's key, so the estimator after it needs no other.
    """
    cells = (lives.select("*", tenure_training("user_tenure").alias("tenure"))
             .groupBy("target", "source_date", "lifespan", "died_bool", "facility_id", "freight_id", "plan_id", "tenure")
             .agg(*[F.sum(F.col(f"first_{i}").cast("long")).alias(f"n_{i}") for i in range(len(LEVELS))]))
    counts = F.array(*[F.col(f"n_{i}") for i in range(len(LEVELS))])
    # few bytes, but each row becomes many: keep the tasks that AQE would merge by size
    cells = cells.repartition(int(lives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = per_target(cells, calendar).select("ship_date", "lifespan", "died_bool", "facility_id", "tenure",
                                           counts.alias("n"), F.inline(_levels()))
    x = x.select("ship_date", "lifespan", "died_bool", group_key("facility_id", "frt_k", "plan_k", "tenure").alias("grp"), "level",
                 F.col("n")[F.col("level")].alias("n")).filter(F.col("n") > 0)
    return (x.repartition("ship_date", "grp").groupBy("ship_date", "lifespan", "died_bool", "grp", "level")
            .agg(F.sum("n").alias("weight")).drop("level"))


def group_quality_counts(training: DataFrame, min_records: int) -> DataFrame:
    """A10 per target: groups seen, kept (>= min_records records) and excluded."""
    per = training.filter(F.col("grp").isNotNull()).groupBy("ship_date", "grp").agg(
        F.count(F.lit(1)).alias("records"))
    return per.groupBy("ship_date").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.when(F.col("records") >= min_records, 1).otherwise(0)).cast("long").alias("kept"),
        F.sum(F.when(F.col("records") < min_records, 1).otherwise(0)).cast("long").alias("excluded"),
    )
