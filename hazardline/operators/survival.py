"""A11 / D6 weighted Kaplan-Meier curves, as long rows or as one row per curve.

Per (ship_date, grp), with lifespans t and weights w:
  d_t = sum w*died, m_t = sum w, n_t = sum_{s>=t} m_s (censored at t are at risk),
  S(t) = prod_{s<=t} (1 - d_s/n_s), S = 1 before the first observed time,
then expanded to the integer timeline 0..horizon-1.  Built from one aggregate
and windows over <= horizon+1 rows per curve (lifespans beyond the horizon
are merged into one at-risk bucket), so no window holds an unbounded group.
A running PRODUCT, never exp(sum(ln)): ln(0) would be NULL and the curve
would not reach 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardline.params import HORIZON_HOURS, MIN_RECORDS


def kaplan_meier(training: DataFrame, min_records: int = MIN_RECORDS, horizon: int = HORIZON_HOURS,
                 keys=("ship_date", "grp")) -> DataFrame:
    """The curves as rows (keys, timeline, survival_rate)."""
    y = _segments(training, min_records, horizon, list(keys))
    return y.select(*keys, F.explode(F.sequence(F.col("g.lo"), F.col("g.hi"))).alias("timeline"),
                    F.col("g.v").alias("survival_rate")).withColumn("timeline", F.col("timeline").cast("int"))


def packed_kaplan_meier(training: DataFrame, min_records: int = MIN_RECORDS, horizon: int = HORIZON_HOURS,
                        keys=("ship_date", "grp")) -> DataFrame:
    """The same curves as one row each: (keys, rates), ``rates[t]`` being the rate at timeline t.

    The segments of a curve (at most horizon + 2) are already on one partition, so packing them needs no exchange."""
    runs = F.array_sort(F.collect_list("g"))
    return (_segments(training, min_records, horizon, list(keys)).groupBy(*keys)
            .agg(F.flatten(F.transform(runs, lambda g: F.array_repeat(g["v"], (g["hi"] - g["lo"] + 1).cast("int")))).alias("rates")))


def _segments(training: DataFrame, min_records: int, horizon: int, keys: list[str]) -> DataFrame:
    """(keys, g): the stretches ``g.lo`` .. ``g.hi`` of the timeline on which a curve has the rate ``g.v``."""
    t = F.least(F.col("lifespan"), F.lit(horizon)).alias("t")
    pts = (training.filter(F.col("grp").isNotNull())  # P13
           .groupBy(*keys, t)
           .agg(F.sum(F.when(F.col("died_bool"), F.col("weight")).otherwise(0)).alias("d"),
                F.sum("weight").alias("m"),
                F.count(F.lit(1)).alias("recs")))
    # One ordering (t ascending) for every window: the group's record count (whole frame),
    # the at-risk weight n_t = total - sum_{s<t} m_s (a frame to the end would start anew at every
    # row), the next point, then the running product -- one shuffle, one sort.
    up = Window.partitionBy(*keys).orderBy("t")
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = (pts.select("*", F.sum("recs").over(whole).alias("records"), (F.sum("m").over(whole) - F.sum("m").over(run) + F.col("m")).alias("n"),
                    F.lead("t").over(up).alias("nxt"), (F.row_number().over(up) == 1).alias("first"))
         .filter(F.col("records") >= min_records)  # P12: whole groups kept or dropped
         .withColumn("s", F.product(F.lit(1.0) - F.col("d") / F.col("n")).over(run)))
    last = F.lit(horizon - 1)
    segs = F.array(
        # points before the first observed lifespan: S = 1
        F.when(F.col("first") & (F.col("t") > 0),
               F.struct(F.lit(0).alias("lo"), F.least(F.col("t") - 1, last).alias("hi"),
                        F.lit(1.0).alias("v"))),
        F.struct(F.greatest(F.col("t"), F.lit(0)).alias("lo"),
                 F.least(F.coalesce(F.col("nxt") - 1, last), last).alias("hi"),
                 F.col("s").alias("v")),
    )
    return x.select(*keys, F.explode(F.filter(segs, lambda z: z.isNotNull() & (z["lo"] <= z["hi"]))).alias("g"))


def pack(curves: DataFrame, by=("ship_date",)) -> DataFrame:
    """Curves as one row per (``by``, grp) with ``rates``; rows that are packed already stay as they are.

    A timeline point that a curve lacks is NULL in its rates; two rates for one point fail."""
    if "rates" in curves.columns:
        return curves
    point = F.struct("timeline", "survival_rate")
    last, points = F.col("last"), F.col("points")
    x = curves.groupBy(*by, "grp").agg(F.max("timeline").alias("last"), F.array_sort(F.collect_list(point)).alias("points"))
    dense = (F.size("points") == last + 1) & (F.array_min(points["timeline"]) == 0) \
        & (F.size(F.array_distinct(points["timeline"])) == F.size("points"))
    rates = F.when(dense, points["survival_rate"]).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda t: F.element_at(F.map_from_entries(points), t)))
    return x.select(*by, "grp", rates.alias("rates"))


def curve_keys(curves: DataFrame, by=("ship_date",)) -> DataFrame:
    """(``by``, grp) of every curve, once each and without an aggregate: one row of a long curve is at timeline 0."""
    rows = curves if "rates" in curves.columns else curves.filter(F.col("timeline") == 0)
    return rows.select(*by, "grp")


def unpack(packed: DataFrame, by=("ship_date",)) -> DataFrame:
    """Rows (``by``, grp, timeline, survival_rate) of packed curves."""
    return (packed.select(*by, "grp", F.posexplode("rates").alias("timeline", "survival_rate"))
            .filter(F.col("survival_rate").isNotNull()))
