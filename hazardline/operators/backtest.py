"""D14 the correction back-tested for many (ship date, knowledge time) runs in one job.

The knowledge time (KT) is a column of the requested runs, and every as-of filter compares with it.  Orders are read and
shuffled once, however many KTs a date has; runs are multiplied where rows are already cells:

* Actuals.  The state of an order at a checkpoint does not depend on the KT as long as the checkpoint lies before it, so the
  changes of each (ship date, facility, freight, hour) are summed once and each run takes those up to its own last
  checkpoint.  The exception is an order of which something was recorded later than it happened (an event earlier than the
  creation of its order or delivery): only such an order's rows are multiplied by the runs.
* Cohorts.  A KT changes an order's tenure only if its subscription's first start became known late.  The runs of a
  delivery with one tenure are kept together as an array through the count of orders and multiplied after it.
* First starts.  One row per subscription, with the earliest start per KT by which its orders were known.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardline.functions.keys import group_key, tenure_correction
from hazardline.functions.timefn import add_hours, ceil_hour, diff_weeks, trunc_hour
from hazardline.operators.actuals import DELTAS, cell_deltas, live_totals
from hazardline.operators.correction import corrected, final_prediction
from hazardline.operators.facts import zone_calendar
from hazardline.operators.hot import join_one_per_key
from hazardline.operators.lifecycle import status_log
from hazardline.operators.prediction import COHORT_KEYS, predicted
from hazardline.params import RunParams, instant_lit, resolve_instant
from hazardline.sources.tables import Sources, literal_table

RUN = ("knowledge_time",)


@dataclass(frozen=True)
class Runs:
    """The requested (ship date, KT) pairs, as literals: bounded by the request (dates x KTs), not by data."""

    pairs: tuple[tuple[dt.date, dt.datetime], ...]

    @classmethod
    def of(cls, pairs: Iterable) -> "Runs":
        """From (ship date or its text, KT or its text) pairs; a pair named twice is one run."""
        day = lambda x: x if isinstance(x, dt.date) and not isinstance(x, dt.datetime) else dt.date.fromisoformat(str(x))
        return cls(tuple(sorted({(day(d), resolve_instant(t)) for d, t in pairs})))

    @property
    def dates(self) -> list[dt.date]:
        return sorted({d for d, _ in self.pairs})

    @property
    def times(self) -> list[dt.datetime]:
        return sorted({t for _, t in self.pairs})

    def by_date(self, spark: SparkSession) -> DataFrame:
        """(ship_date, kts): the KTs of each date, ascending."""
        of = {d: [t for x, t in self.pairs if x == d] for d in self.dates}
        return literal_table(spark, {"ship_date": (pa.date32(), list(of)),
                                     "kts": (pa.list_(pa.timestamp("us", "UTC")), list(of.values()))})

    def first_after(self, t: Column) -> Column:
        """The earliest of all KTs that is not before ``t`` (null: none)."""
        return F.array_min(F.filter(F.array(*[instant_lit(x) for x in self.times]), lambda k: k >= t))


@dataclass
class BacktestPlan:
    cohorts: DataFrame
    actuals: DataFrame
    predicted: DataFrame
    corrected: DataFrame
    final: DataFrame


def _last_checkpoint(p: RunParams, kt: Column) -> Column:
    return F.least(F.col("ship_date").cast("timestamp"), trunc_hour(F.least(kt, p.now_col())))


def run_events(src: Sources, p: RunParams, runs: Runs) -> DataFrame:
    """D2 of all runs: (ship_date, weekly_order_id, event_time, order_is_alive, known_from), each event once (or as often as its
    order has status changes); ``known_from`` is when the order and the delivery that tell of it were both recorded."""
    last = instant_lit(runs.times[-1])
    dl = (src.deliveries.filter((F.col("created_at") <= last) & F.col("ship_date").isin(runs.dates))
          .select("ship_date", F.col("id").alias("delivery_id"), "weekly_order_id", F.col("created_at").alias("delivered_from")))
    wo = (src.weekly_orders.filter(F.col("created_at") <= last)
          .select(F.col("id").alias("weekly_order_id"), F.col("created_at").alias("birth_time")))
    x = dl.join(status_log(src, last), "delivery_id", "left").join(wo, "weekly_order_id")
    both = F.array(F.struct(F.col("birth_time").alias("event_time"), F.lit(True).alias("order_is_alive")),
                   F.when(F.col("event_time").isNotNull(), F.struct("event_time", "order_is_alive")))
    return x.select("ship_date", "weekly_order_id", F.greatest("delivered_from", "birth_time").alias("known_from"),
                    F.inline(F.filter(both, lambda e: e.isNotNull())))


def run_actuals(src: Sources, p: RunParams, runs: Runs) -> DataFrame:
    """D8 of all runs: (knowledge_time, ship_date, checkpoint, facility_id, freight_id, con, cor, coa, orders)."""
    spark = src.deliveries.sparkSession
    by_date = F.broadcast(runs.by_date(spark))
    lo = add_hours(F.col("ship_date").cast("timestamp"), -(p.horizon - 1))
    order = Window.partitionBy("weekly_order_id", "ship_date")
    ev = (run_events(src, p, runs).withColumn("bucket", F.greatest(ceil_hour("event_time"), lo))
          .withColumn("late", F.max(F.col("known_from") > F.col("bucket")).over(order)))
    # an order that was recorded as it happened has no KT yet; the others' events count from the KT on that knows them
    kts = F.filter("kts", lambda k: k >= F.col("known_from"))
    ev = (ev.join(by_date, "ship_date")
          .withColumn("knowledge_time", F.explode(F.when(F.col("late"), kts).otherwise(F.array(F.lit(None).cast("timestamp")))))
          .withColumn("hi", _last_checkpoint(p, F.coalesce(F.col("knowledge_time"), F.element_at("kts", -1))))
          .filter(F.col("bucket") <= F.col("hi")))
    last = (ev.groupBy("weekly_order_id", "ship_date", *RUN, "bucket")
            .agg(F.max(F.struct(F.col("event_time"), (~F.col("order_is_alive")).alias("dead"))).alias("last")))
    w = Window.partitionBy("weekly_order_id", "ship_date", *RUN).orderBy("bucket")
    spans = (last.withColumn("next_bucket", F.lead("bucket").over(w)).filter(~F.col("last.dead"))
             .select(*RUN, "ship_date", "weekly_order_id", F.col("bucket").alias("start"), F.col("next_bucket").alias("stop")))
    cells = cell_deltas(spans, src, RUN).join(by_date, "ship_date")
    own = F.when(F.col("knowledge_time").isNotNull(), F.array("knowledge_time")).otherwise(F.col("kts"))
    cells = (cells.withColumn("knowledge_time", F.explode(own)).drop("kts")
             .filter(F.col("hour") <= _last_checkpoint(p, F.col("knowledge_time")))
             .groupBy(*RUN, "ship_date", "facility_id", "freight_id", "hour").agg(*[F.sum(c).alias(c) for c in DELTAS]))
    return live_totals(cells, _last_checkpoint(p, F.col("knowledge_time")), RUN)


def run_cohorts(src: Sources, p: RunParams, runs: Runs) -> DataFrame:
    """D9 of all runs: distinct orders per (knowledge_time, cohort).  As in a single run, only the first start
    of a subscription is taken as known at the KT unless ``strict_knowledge_time``."""
    spark = src.deliveries.sparkSession
    slot = runs.first_after(F.col("created_at"))
    per_slot = (src.weekly_orders.filter(F.col("created_at") <= instant_lit(runs.times[-1]))
                .groupBy("subscription_id", slot.alias("known_at"))
                .agg(F.min("start_date").cast("date").alias("start"), F.count(F.lit(1)).alias("n")))
    starts = per_slot.groupBy("subscription_id").agg(   # at most one entry per KT of the request
        F.collect_list(F.struct("known_at", "start")).alias("starts"), F.sum("n").alias("_orders"))
    dl = src.deliveries.filter(F.col("ship_date").isin(runs.dates)).select(
        "ship_date", "weekly_order_id", "facility_id", "freight_id", "plan_id", "number_of_meals", "is_first_for_subscription",
        F.col("created_at").alias("_delivered"))
    wo = src.weekly_orders.select(F.col("id").alias("weekly_order_id"), "subscription_id", "start_date", F.col("created_at").alias("birth_time"))
    x = dl.join(zone_calendar(src, runs.dates), ["ship_date", "facility_id"]).join(wo, "weekly_order_id")
    x = join_one_per_key(x, starts, "subscription_id", "_orders", F.col("weekly_order_id")).join(F.broadcast(runs.by_date(spark)), "ship_date")

    def known(k):
        return F.filter("starts", lambda s: s["known_at"] <= k)

    def tenure(k):
        first = F.array_min(F.transform(known(k), lambda s: s["start"]))
        return tenure_correction(F.lit(1) + diff_weeks(first, F.col("start_date")))
    kts = F.filter("kts", lambda k: F.size(known(k)) > 0)
    if p.strict_knowledge_time:
        kts = F.filter(kts, lambda k: F.coalesce((F.col("_delivered") <= k) & (F.col("birth_time") <= k), F.lit(False)))
    x = x.withColumn("of", F.transform(kts, lambda k: F.struct(k.alias("k"), tenure(k).alias("t"))))
    x = x.withColumn("tenure", F.explode(F.array_distinct(F.transform("of", lambda o: o["t"]))))
    x = x.withColumn("kts", F.transform(F.filter("of", lambda o: o["t"].eqNullSafe(F.col("tenure"))), lambda o: o["k"]))
    x = x.withColumn("birth_hour", trunc_hour("birth_time"))
    if p.strict_knowledge_time:   # two deliveries of an order may then belong to different runs: its orders are counted run by run
        x = x.withColumn("kts", F.explode(F.transform("kts", lambda k: F.array(k))))
    # the deliveries of an order share its subscription and start, hence the tenure of each run: arrays never overlap in an order
    counted = x.groupBy("kts", *COHORT_KEYS).agg(F.count_distinct("weekly_order_id").alias("n"))
    return (counted.withColumn("knowledge_time", F.explode("kts")).groupBy(*RUN, *COHORT_KEYS).agg(F.sum("n").alias("orders"))
            .withColumn("grp", group_key("facility_id", "freight_id", "plan_id", "tenure")))


def backtest_plan(src: Sources, p: RunParams, runs: Runs, curves: DataFrame) -> BacktestPlan:
    """The correction of every run.  ``curves``: (ship_date, grp, timeline, survival_rate), as the weekly job stored them; with a
    column ``knowledge_time`` besides, each run's own.  Of ``p`` the KT and the dates do not matter."""
    if not runs.pairs:
        raise ValueError("a back-test needs at least one (ship date, knowledge time)")
    cohorts, act = run_cohorts(src, p, runs), run_actuals(src, p, runs)
    pred = predicted(cohorts, curves.filter(F.col("ship_date").isin(runs.dates)), RUN)
    corr = corrected(pred, act, RUN)
    return BacktestPlan(cohorts, act, pred, corr, final_prediction(corr, p.freeze_rows, RUN))
