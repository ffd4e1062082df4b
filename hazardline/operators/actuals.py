"""D8 live-order actuals at each hourly checkpoint (J6 + W1 + A3).

The reference joins every event to every later checkpoint (a nested-loop theta
join) and ranks.  Here the work is O(events):

1. bucket each event at the first checkpoint that sees it, clipped to the grid
   [ship_date - 649h, min(ship_date, floor(min(KT, now)))], and keep per
   (ship_date, order, bucket) the state of the latest event (dead wins a tie);
2. per order, ``lead`` gives the bucket where the state next changes (<= 650 rows
   per order and date, so the window is bounded);
3. an alive span emits +1 at its start and -1 where it ends; joined to the
   order's deliveries these become signed measure deltas, summed per
   (ship_date, facility, freight, hour) with map-side combine;
4. a running sum over <= 650 change points per (ship_date, facility, freight)
   gives the live totals, expanded to the hours they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardline.functions.timefn import add_hours, ceil_hour, hour_seq, trunc_hour
from hazardline.operators.lifecycle import order_events
from hazardline.params import RunParams
from hazardline.sources.tables import Sources

MEASURES = ("con", "cor", "coa")


def correction_events(src: Sources, p: RunParams, targets: DataFrame, dates=None) -> DataFrame:
    """D2 for the correction: events of the deliveries shipping on each target date (``dates``: the same as literals,
    which bound the scan)."""
    dl = src.deliveries.filter(F.col("created_at") <= p.kt_col())
    if dates:
        dl = dl.filter(F.col("ship_date").isin(list(dates)))
    dl = (dl.join(targets.select("ship_date"), "ship_date")
          .select("ship_date", F.col("id").alias("delivery_id"), "weekly_order_id"))
    return order_events(src, p, dl)


def grid_bounds(p: RunParams):
    """(first checkpoint, last checkpoint) of each ship date's grid."""
    midnight = F.col("ship_date").cast("timestamp")
    lo = add_hours(midnight, -(p.horizon - 1))
    hi = F.least(midnight, trunc_hour(F.least(p.kt_col(), p.now_col())))
    return lo, hi


def delivery_measures(src: Sources) -> DataFrame:
    """Per delivery: the values A3 sums (NULL-aware, as SUM(IFF(...)) is)."""
    first, meals = F.col("is_first_for_subscription"), F.col("number_of_meals")
    return src.deliveries.select(
        "weekly_order_id", "facility_id", "freight_id",
        F.when(first, meals).otherwise(F.lit(0)).alias("con"),
        F.when(~first, meals).otherwise(F.lit(0)).alias("cor"),
        meals.alias("coa"),
    )


def alive_spans(events: DataFrame, p: RunParams) -> DataFrame:
    """(ship_date, order, start, end_exclusive|NULL) for every alive stretch on the grid."""
    lo, hi = grid_bounds(p)
    b = (events.withColumn("bucket", F.greatest(ceil_hour("event_time"), lo))
         .filter(F.col("bucket") <= hi)
         .groupBy("ship_date", "weekly_order_id", "bucket")
         .agg(F.max(F.struct(F.col("event_time"), (~F.col("order_is_alive")).alias("dead"))).alias("last")))
    w = Window.partitionBy("ship_date", "weekly_order_id").orderBy("bucket")
    return (b.withColumn("next_bucket", F.lead("bucket").over(w))
            .filter(~F.col("last.dead"))
            .select("ship_date", "weekly_order_id", F.col("bucket").alias("start"),
                    F.col("next_bucket").alias("stop")))


def actuals(src: Sources, p: RunParams, targets: DataFrame, dates=None) -> DataFrame:
    """(ship_date, checkpoint, facility_id, freight_id, con, cor, coa, orders)."""
    spans = alive_spans(correction_events(src, p, targets, dates), p)
    return live_totals(cell_deltas(spans, src), grid_bounds(p)[1])


DELTAS = ["d_orders"] + [f"d_{m}" for m in MEASURES] + [f"d_{m}_n" for m in MEASURES]


def cell_deltas(spans: DataFrame, src: Sources, run_keys=()) -> DataFrame:
    """What changes in each (ship_date, facility, freight) at each hour: rows are bounded by cells x hours, not by orders."""
    edges = F.array(
        F.struct(F.col("start").alias("hour"), F.lit(1).alias("sign")),
        F.when(F.col("stop").isNotNull(), F.struct(F.col("stop").alias("hour"), F.lit(-1).alias("sign"))),
    )
    d = spans.select(*run_keys, "ship_date", "weekly_order_id",
                     F.explode(F.filter(edges, lambda z: z.isNotNull())).alias("e"))
    # SURVEY Q8: all deliveries of the order count, whatever their ship date.
    d = d.join(delivery_measures(src), "weekly_order_id")
    sign = F.col("e.sign")
    aggs = [F.sum(sign).alias("d_orders")]
    for m in MEASURES:
        aggs += [F.sum(sign * F.coalesce(F.col(m), F.lit(0))).alias(f"d_{m}"),
                 F.sum(F.when(F.col(m).isNotNull(), sign).otherwise(0)).alias(f"d_{m}_n")]
    return d.groupBy(*run_keys, "ship_date", "facility_id", "freight_id", F.col("e.hour").alias("hour")).agg(*aggs)


def live_totals(per_hour: DataFrame, hi, run_keys=()) -> DataFrame:
    """The live totals of each cell at each checkpoint up to ``hi``, from its changes."""
    w = Window.partitionBy(*run_keys, "ship_date", "facility_id", "freight_id").orderBy("hour")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    x = per_hour.select(*run_keys, "ship_date", "facility_id", "freight_id", "hour", hi.alias("hi"),
                        F.lead("hour").over(w).alias("next_hour"),
                        *[F.sum(c).over(run).alias(c[2:]) for c in DELTAS])
    x = x.filter(F.col("orders") > 0).withColumn("upto", F.coalesce(add_hours("next_hour", -1), F.col("hi")))
    return x.select(*run_keys, "ship_date", "facility_id", "freight_id",
                    F.explode(hour_seq("hour", "upto")).alias("checkpoint"),
                    *[F.when(F.col(f"{m}_n") > 0, F.col(m)).cast("long").alias(m) for m in MEASURES],
                    F.col("orders").cast("long").alias("orders"))


def actuals_bruteforce(src: Sources, p: RunParams, targets: DataFrame) -> DataFrame:
    """The reference's formulation (every event x every later checkpoint, rank 1).

    For tests on small fixtures only: it is a theta join of size events x 650.
    """
    ev = correction_events(src, p, targets).distinct()
    lo, hi = grid_bounds(p)
    grid = targets.select("ship_date", F.explode(hour_seq(lo, hi)).alias("checkpoint")).withColumnRenamed(
        "ship_date", "g_date")
    j = ev.join(grid, (F.col("ship_date") == F.col("g_date")) & (F.col("event_time") <= F.col("checkpoint")))
    j = j.drop("g_date")
    w = Window.partitionBy("ship_date", "checkpoint", "weekly_order_id").orderBy(
        F.col("event_time").desc(), F.col("order_is_alive").asc())
    r = j.withColumn("recency", F.row_number().over(w)).filter((F.col("recency") == 1) & F.col("order_is_alive"))
    r = r.join(delivery_measures(src), "weekly_order_id")
    return r.groupBy("ship_date", "checkpoint", "facility_id", "freight_id").agg(
        *[F.sum(m).cast("long").alias(m) for m in MEASURES], F.count(F.lit(1)).alias("orders"))
