"""D1 order facts: tenure, zone-aware alignment/finalization, birth time.

Joins: subscription -> order -> delivery (inner), then the dimension tables
as semi-joins (their attributes are not used downstream) and the literal zone
map as a broadcast.  Catalyst pushes the KT predicates into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.functions.keys import tenure_correction
from hazardline.functions.timefn import alignment_ts, diff_weeks, finalization_ts, trunc_hour
from hazardline.operators.hot import join_one_per_key
from hazardline.params import RunParams
from hazardline.plans.dates import Calendar
from hazardline.sources.tables import Sources


def known_or_null(c, kt):
    """P2 (KT >= created_at OR created_at IS NULL)."""
    return (F.col(c) <= kt) | F.col(c).isNull()


def first_order_dates(src: Sources, p: RunParams) -> DataFrame:
    """A1 first start date per subscription among orders known at KT."""
    return (src.weekly_orders.filter(F.col("created_at") <= p.kt_col())
            .groupBy("subscription_id")
            .agg(F.min("start_date").cast("date").alias("first_start_date")))


def with_first_start(rows: DataFrame, src: Sources, p: RunParams) -> DataFrame:
    """J1 ``rows`` of orders with the first start date of their subscription, whatever share of them one subscription holds."""
    side = (src.weekly_orders.filter(F.col("created_at") <= p.kt_col())
            .groupBy("subscription_id")
            .agg(F.min("start_date").cast("date").alias("first_start_date"), F.count(F.lit(1)).alias("_orders")))
    return join_one_per_key(rows, side, "subscription_id", "_orders", F.col("weekly_order_id"))


def zone_times(pairs: DataFrame, src: Sources) -> DataFrame:
    """(ship_date, facility_id) -> zone, alignment and finalization instants.

    Zone conversion is per-row costly, and both instants depend only on the
    ship date and the facility's zone, so they are computed on the distinct
    pairs (bounded by calendar x facilities) rather than on every delivery.
    """
    return (pairs.select("ship_date", "facility_id").distinct()
            .join(src.zone_of_facility(), "facility_id")
            .withColumn("alignment_timestamp", alignment_ts("ship_date", "facility_timezone"))
            .withColumn("finalization_timestamp", finalization_ts("ship_date", "facility_timezone")))


def with_zone_times(df: DataFrame, src: Sources) -> DataFrame:
    """Inner join to the zone map (facilities without a zone drop out) + alignment/finalization.

    The pair table is tiny; AQE turns this join into a broadcast once it has
    measured it, so the large side is not shuffled.
    """
    return df.join(zone_times(df, src), ["ship_date", "facility_id"])


def zone_calendar(src: Sources, dates) -> DataFrame:
    """(ship_date, facility_id) -> zone, alignment and finalization for literal ``dates``: dates x zones rows, made
    from literals, so the broadcast is bounded by the calendar and the large side of the join stays where it is."""
    days = F.array(*[F.lit(d) for d in dates]) if dates else F.array().cast("array<date>")
    return F.broadcast(src.timezones.select("*", F.explode(days).alias("ship_date"))
                       .withColumn("alignment_timestamp", alignment_ts("ship_date", "facility_timezone"))
                       .withColumn("finalization_timestamp", finalization_ts("ship_date", "facility_timezone")))


def training_facts(src: Sources, p: RunParams, calendar: Calendar) -> DataFrame:
    """MASTER_DATASET for every (target ship date, delivery in its training window): the facts of each delivery once,
    multiplied by the targets last."""
    kt = p.kt_col()
    dl = (src.deliveries.filter(known_or_null("created_at", kt)).filter(calendar.has("ship_date"))
          .select(F.col("id").alias("delivery_id"), "weekly_order_id", "ship_date", "facility_id", "freight_id", "plan_id"))
    dl = dl.join(zone_calendar(src, calendar.source_dates), ["ship_date", "facility_id"])
    wo = (src.weekly_orders.filter(known_or_null("created_at", kt))
          .select(F.col("id").alias("weekly_order_id"), "subscription_id",
                  F.col("created_at").alias("birth_time"), "start_date"))
    x = (with_first_start(known_dimensions(dl, src, p).join(wo, "weekly_order_id"), src, p)
         .withColumnRenamed("ship_date", "source_date")
         .join(F.broadcast(calendar.windows(dl.sparkSession)), "source_date"))
    return x.select(
        "ship_date", "weekly_order_id", "delivery_id", "birth_time", user_tenure().alias("user_tenure"),
        "facility_id", "freight_id", "plan_id", "facility_timezone",
        "alignment_timestamp", "finalization_timestamp", "source_date",
    )


def known_dimensions(df: DataFrame, src: Sources, p: RunParams) -> DataFrame:
    """Rows whose plan, freight and facility are known at KT."""
    for c, t in (("plan_id", src.plans), ("freight_id", src.freights), ("facility_id", src.facilities)):
        ids = t.filter(known_or_null("created_at", p.kt_col())).select(F.col("id").alias("_id"))
        df = df.join(ids, F.col(c) == F.col("_id"), "left_semi")
    return df


def user_tenure():
    return F.lit(1) + diff_weeks("first_start_date", "start_date")


def delivery_ordinals(src: Sources, p: RunParams, dates) -> DataFrame:
    """DELIVERY_ORDINALS: deliveries shipping on each of the target ``dates`` (correction side).

    Faithful to the reference (SURVEY Q6): orders/deliveries are not KT-filtered
    here unless ``strict_knowledge_time``; only the first-order date is.
    """
    kt = p.kt_col()
    dl = src.deliveries
    wo = src.weekly_orders
    if isinstance(dates, DataFrame):
        dates = [r[0] for r in dates.select("ship_date").distinct().collect()]
    if p.strict_knowledge_time:
        dl = dl.filter(F.col("created_at") <= kt)
        wo = wo.filter(F.col("created_at") <= kt)
    dl = dl.filter(F.col("ship_date").isin(list(dates)) if dates else F.lit(False)).select(
        "ship_date", "weekly_order_id", "facility_id", "freight_id", "plan_id",
        "number_of_meals", "is_first_for_subscription")
    wo = wo.select(F.col("id").alias("weekly_order_id"), "subscription_id", "start_date",
                   F.col("created_at").alias("birth_time"))
    dl = dl.join(zone_calendar(src, dates), ["ship_date", "facility_id"])
    x = with_first_start(dl.join(wo, "weekly_order_id"), src, p)
    return x.select(
        "ship_date", "weekly_order_id", "facility_id", "freight_id", "plan_id",
        "number_of_meals", "is_first_for_subscription", tenure_correction(user_tenure()).alias("tenure"),
        "alignment_timestamp", "finalization_timestamp",
        trunc_hour("birth_time").alias("birth_hour"),
    )
