"""D2-D4 order life cycle: alive/dead events, death time, lifespan.

The training side (:func:`training_lives`) takes one exchange on the order for
everything that an order's history tells; :func:`death_times` is the rule itself,
for any frame of events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardline.functions.keys import alive_flag, change_set_variant
from hazardline.functions.timefn import diff_hours
from hazardline.operators.facts import known_dimensions, known_or_null, user_tenure, with_first_start, with_zone_times, zone_calendar
from hazardline.params import LEVELS, RunParams
from hazardline.plans.dates import Calendar
from hazardline.sources.tables import Sources


def status_log(src: Sources, as_of) -> DataFrame:
    """Status-change rows on deliveries known at ``as_of`` (run parameters: their KT) -> (delivery_id, event_time, order_is_alive).

    J4: the literal and semi-structured predicates filter event_logs before the join.
    """
    as_of = as_of.kt_col() if isinstance(as_of, RunParams) else as_of
    v = (src.event_logs
         .filter((F.col("object_type") == "deliveries") & (F.col("created_at") <= as_of))
         .select("object_id", "created_at", change_set_variant(src.event_logs).alias("v")))  # parsed once
    return (v.filter(F.try_variant_get("v", "$.status", "variant").isNotNull())
            .select(F.col("object_id").alias("delivery_id"), F.col("created_at").alias("event_time"),
                    alive_flag(F.try_variant_get("v", "$.status[1]", "string")).alias("order_is_alive")))


def order_events(src: Sources, p: RunParams, scope: DataFrame) -> DataFrame:
    """D2 events per (ship_date, order): creation (alive) plus status changes.

    ``scope`` holds (ship_date, delivery_id, weekly_order_id) for the deliveries
    whose events count toward each target date.  Orders and deliveries must be
    known at KT.  UNION semantics (dedup) are irrelevant to the min/max
    aggregates downstream, so the plain union avoids a distinct shuffle.
    """
    kt = p.kt_col()
    wo = (src.weekly_orders.filter(F.col("created_at") <= kt)
          .select(F.col("id").alias("weekly_order_id"), F.col("created_at").alias("birth_time")))
    sc = scope.join(wo, "weekly_order_id")
    created = sc.select("ship_date", "weekly_order_id", F.col("birth_time").alias("event_time"),
                        F.lit(True).alias("order_is_alive"))
    changed = sc.join(status_log(src, p), "delivery_id").select(
        "ship_date", "weekly_order_id", "event_time", "order_is_alive")
    return created.unionByName(changed)


def union_distinct_events(events: DataFrame) -> DataFrame:
    """U1 exact UNION: (ship_date, order, time, alive) de-duplicated."""
    return events.distinct()


def finalization_cut(src: Sources, p: RunParams, orders: DataFrame | None = None) -> DataFrame:
    """Per order: latest finalization over its deliveries known at KT in a zoned facility.

    An event is kept when ANY delivery's own cut keeps it (SURVEY Q9), i.e. when
    it is earlier than the latest cut.  ``orders`` (any frame with
    ``weekly_order_id``) restricts the work to the orders in scope; each of them
    still sees all of its deliveries, whatever their ship date.
    """
    dl = (src.deliveries.filter(F.col("created_at") <= p.kt_col())
          .select("weekly_order_id", "ship_date", "facility_id"))
    if orders is not None:
        dl = dl.join(orders.select("weekly_order_id"), "weekly_order_id", "left_semi")
    return (with_zone_times(dl, src).groupBy("weekly_order_id")
            .agg(F.max("finalization_timestamp").alias("cut")))


def death_times(events: DataFrame, keys=("ship_date", "weekly_order_id")) -> DataFrame:
    """D3 per key: start of the final dead streak, if the latest event is dead.

    last_alive = max alive time; latest event by (time, dead last); when dead,
    death = min dead time >= last_alive (peers at last_alive count, as the
    reference's RANGE frame includes them).  Every key with >= 1 event is returned.
    """
    keys = list(keys)
    t, alive = F.col("event_time"), F.col("order_is_alive")
    summary = events.groupBy(*keys).agg(
        F.max(F.when(alive, t)).alias("last_alive"),
        F.max(F.struct(t.alias("t"), (~alive).alias("dead"))).alias("latest"),
    )
    dying = summary.filter(F.col("latest.dead")).select(*keys, "last_alive")
    death = (events.filter(~alive).join(dying, keys)
             .filter(F.col("last_alive").isNull() | (t >= F.col("last_alive")))
             .groupBy(*keys).agg(F.min(t).alias("death_time")))
    return summary.select(*keys).join(death, keys, "left")


def training_lives(src: Sources, p: RunParams, calendar: Calendar) -> DataFrame:
    """D1 + D3 for all deliveries in any training window, each once: facts, events and death time in one pass.

    Deliveries meet their status changes in one join on the delivery, and everything else happens in one exchange on the
    order: the latest finalization over all its deliveries (the cut), its birth, its last alive event and the first
    dead one from there on, which is the death time if there is one (dead wins a tie, so then the latest event is dead).

    An order with one delivery in the windows has one death time, whatever the target: its row has no ``target`` yet and
    is multiplied after the counts.  Of an order with several, the events that count depend on which of its dates a target's
    window has: only these rows are multiplied here, and have their ``target``.

    Rows: one per delivery (and target), for orders with at least one event before the cut.
    """
    kt, spark = p.kt_col(), src.deliveries.sparkSession
    dl = (src.deliveries.filter(known_or_null("created_at", kt))
          .select(F.col("id").alias("delivery_id"), "weekly_order_id", "ship_date", "facility_id", "freight_id", "plan_id",
                  F.coalesce(F.col("created_at") <= kt, F.lit(False)).alias("known"), calendar.has("ship_date").alias("in_scope")))
    span = src.deliveries.agg(F.min("ship_date"), F.max("ship_date")).first()
    days = [span[0] + dt.timedelta(days=i) for i in range((span[1] - span[0]).days + 1)] if span[0] else []
    dl = dl.join(zone_calendar(src, days), ["ship_date", "facility_id"], "left")
    log = status_log(src, p).withColumnRenamed("delivery_id", "_delivery")
    x = dl.join(log, (F.col("delivery_id") == F.col("_delivery")) & F.col("in_scope") & F.col("known"), "left").drop("_delivery")

    order = Window.partitionBy("weekly_order_id")
    mine = F.when(F.col("in_scope"), F.col("delivery_id"))
    x = (x.withColumns({"cut": F.max(F.when(F.col("known"), F.col("finalization_timestamp"))).over(order),
                        "several": F.min(mine).over(order) != F.max(mine).over(order)})
         .filter(F.col("in_scope")))
    wo = (src.weekly_orders.filter(F.col("created_at") <= kt)
          .select(F.col("id").alias("weekly_order_id"), "subscription_id", F.col("created_at").alias("birth_time"), "start_date"))
    x = x.join(wo, "weekly_order_id").withColumnRenamed("ship_date", "source_date")
    x = x.join(F.broadcast(calendar.targets_of(spark)), "source_date")
    none = F.array(F.lit(None).cast("date"))
    x = x.withColumn("target", F.explode(F.when(F.col("several"), F.col("targets")).otherwise(none))).drop("targets")

    life = Window.partitionBy("weekly_order_id", "target")
    t, alive, kept = F.col("event_time"), F.col("order_is_alive"), F.col("event_time") < F.col("cut")
    born = F.when(F.col("birth_time") < F.col("cut"), F.col("birth_time"))
    x = x.withColumns({"last_alive": F.greatest(F.max(F.when(kept & alive, t)).over(life), born),
                       "has_event": F.max("known").over(life) & (born.isNotNull() | F.coalesce(F.max(kept).over(life), F.lit(False)))})
    dead = kept & ~alive & (F.col("last_alive").isNull() | (t >= F.col("last_alive")))
    per_delivery = Window.partitionBy("weekly_order_id", "target", "delivery_id").orderBy("event_time")
    return (x.withColumns({"death_time": F.min(F.when(dead, t)).over(life), "_row": F.row_number().over(per_delivery)})
            .filter((F.col("_row") == 1) & F.col("has_event"))
            .select("weekly_order_id", "target", "source_date", "delivery_id", "facility_id", "freight_id", "plan_id", "facility_timezone",
                    "finalization_timestamp", "birth_time", "subscription_id", "start_date", "death_time"))


def per_target(rows: DataFrame, calendar: Calendar) -> DataFrame:
    """Rows without a ``target`` once for each target whose window has their source date; the target as ship_date."""
    y = rows.join(F.broadcast(calendar.targets_of(rows.sparkSession)), "source_date")
    return y.withColumn("ship_date", F.explode(F.when(F.col("target").isNotNull(), F.array("target")).otherwise(F.col("targets")))) \
        .drop("target", "targets")


def training_deaths(lives: DataFrame, calendar: Calendar) -> DataFrame:
    """D3 as a table: (ship_date, weekly_order_id, death_time) for every target."""
    return per_target(lives, calendar).select("ship_date", "weekly_order_id", "death_time").distinct()


def lifespans(lives: DataFrame, src: Sources, p: RunParams) -> DataFrame:
    """D4 lifespan in hour boundaries to death, else censored at the delivery's own finalization, with the tenure;
    rows still without a target as in :func:`training_lives`.

    ``first_<level>``: whether a row counts its order in its cell (lifespan, died, group) at that grouping level; of several
    deliveries of an order in one cell, the one with the smallest id does.
    """
    x = known_dimensions(lives.filter(F.col("facility_timezone").isNotNull()), src, p)
    x = x.withColumn("lifespan", diff_hours("birth_time", F.coalesce("death_time", "finalization_timestamp")))

    def first(freight, plan):
        cell = ["weekly_order_id", "target", "lifespan", "facility_id", *["freight_id"] * freight, *["plan_id"] * plan]
        return F.row_number().over(Window.partitionBy(*cell).orderBy("delivery_id")) == 1
    x = x.withColumns({f"first_{i}": first(*level) for i, level in enumerate(LEVELS)})
    x = with_first_start(x, src, p)
    return x.select(
        "target", "source_date", "weekly_order_id", "facility_id", "freight_id", "plan_id", user_tenure().alias("user_tenure"),
        "lifespan", F.col("death_time").isNotNull().alias("died_bool"),
        "birth_time", "death_time", "finalization_timestamp", *[f"first_{i}" for i in range(len(LEVELS))],
    )


def order_state_snapshot(src: Sources, as_of) -> DataFrame:
    """Per order: the state of its latest event known at ``as_of`` (dead wins a tie).

    Incremental consumers upsert these rows by order id (S14).
    """
    wo = (src.weekly_orders.filter(F.col("created_at") <= as_of)
          .select(F.col("id").alias("weekly_order_id"), F.col("created_at").alias("event_time"),
                  F.lit(True).alias("order_is_alive")))
    dl = src.deliveries.select(F.col("id").alias("delivery_id"), "weekly_order_id")
    logs = status_log(src, as_of)
    ev = wo.unionByName(logs.join(dl, "delivery_id").drop("delivery_id").join(
        wo.select("weekly_order_id"), "weekly_order_id", "left_semi"))
    last = ev.groupBy("weekly_order_id").agg(
        F.max(F.struct(F.col("event_time").alias("t"), (~F.col("order_is_alive")).alias("dead"))).alias("m"))
    return last.select("weekly_order_id", F.col("m.t").alias("state_time"), (~F.col("m.dead")).alias("order_is_alive"))
