"""Scalar functions, filters, simple joins/aggregates and SQL-API keys over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from hazardline import oracle as O
from hazardline.catalog.registry import present, query, setup
from hazardline.functions import keys as K
from hazardline.functions import timefn as T
from hazardline.operators.facts import first_order_dates, known_or_null, with_zone_times
from hazardline.operators.lifecycle import status_log
from hazardline.oracle_fixtures import with_fixtures

P = O.params_cte()


def fx(body: str) -> str:
    return with_fixtures(P, body=body)


FO = """fo AS (SELECT subscription_id, CAST(min(start_date) AS DATE) AS first_start_date
          FROM weekly_orders, params WHERE created_at <= params.kt GROUP BY 1)"""


def fxo(body: str) -> str:
    return with_fixtures(P, FO, body=body)


@query("add_hours", fx("SELECT id, CAST(ship_date AS TIMESTAMP) + INTERVAL 17 HOUR AS local_cutoff FROM deliveries"))
def q_add_hours(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return present(src.deliveries.select("id", T.add_hours("ship_date", 17).alias("local_cutoff")))


@query("add_days", fx("SELECT id, CAST(ship_date - 3 AS DATE) AS finalization_date FROM deliveries"))
def q_add_days(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return src.deliveries.select("id", T.add_days("ship_date", -3).alias("finalization_date"))


@query("add_weeks", fx("SELECT DISTINCT ship_date, CAST(ship_date + 7 * 13 AS DATE) AS plus_weeks FROM deliveries"))
def q_add_weeks(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return src.deliveries.select("ship_date").distinct().select(
        "ship_date", T.add_weeks("ship_date", p.training_weeks).alias("plus_weeks"))


@query("diff_hours", fx("SELECT d.id, " + O.hour_diff("wo.created_at", "CAST(d.ship_date AS TIMESTAMP)")
                        + " AS hours_to_ship FROM deliveries d JOIN weekly_orders wo ON wo.id = d.weekly_order_id"))
def q_diff_hours(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    wo = src.weekly_orders.select(F.col("id").alias("weekly_order_id"), F.col("created_at").alias("birth"))
    return src.deliveries.join(wo, "weekly_order_id").select(
        "id", T.diff_hours("birth", T.date_to_timestamp("ship_date")).alias("hours_to_ship"))


@query("diff_weeks", fxo("SELECT wo.id AS weekly_order_id, " + O.week_diff("fo.first_start_date", "wo.start_date")
                         + " AS weeks FROM weekly_orders wo JOIN fo ON fo.subscription_id = wo.subscription_id"))
def q_diff_weeks(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    x = src.weekly_orders.join(first_order_dates(src, p), "subscription_id")
    return x.select(F.col("id").alias("weekly_order_id"),
                    T.diff_weeks("first_start_date", "start_date").cast("long").alias("weeks"))


@query("trunc_hour", fx("SELECT id, date_trunc('hour', created_at) AS birth_hour FROM weekly_orders"))
def q_trunc_hour(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return present(src.weekly_orders.select("id", T.trunc_hour("created_at").alias("birth_hour")))


@query("day_of_week", fx("SELECT DISTINCT ship_date, CAST(dayofweek(ship_date) AS INTEGER) AS dow FROM deliveries"))
def q_day_of_week(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return src.deliveries.select("ship_date").distinct().select("ship_date", T.day_of_week("ship_date").alias("dow"))


@query("local_to_instant", fx(
    "SELECT d.id, " + O.zone_instant("CAST(d.ship_date AS TIMESTAMP) + INTERVAL 17 HOUR", "tz.facility_timezone")
    + " AS alignment_timestamp, "
    + O.zone_instant("CAST(d.ship_date - 3 AS TIMESTAMP) + INTERVAL 17 HOUR", "tz.facility_timezone")
    + " AS finalization_timestamp FROM deliveries d JOIN timezones tz ON tz.facility_id = d.facility_id"))
def q_local_to_instant(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    x = with_zone_times(src.deliveries, src)
    return present(x.select("id", "alignment_timestamp", "finalization_timestamp"))


@query("to_date", fx("SELECT id, CAST(created_at AS DATE) AS created_date FROM weekly_orders"))
def q_to_date(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return src.weekly_orders.select("id", F.to_date("created_at").alias("created_date"))


@query("parse_timestamp", fx(
    "SELECT id, timezone('UTC', CAST(strftime(created_at - INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%S') || '-04:00' "
    "AS TIMESTAMPTZ)) AS parsed FROM weekly_orders"))
def q_parse_timestamp(spark, sf_dir):
    """ISO text with an offset (here the Eastern summer wall clock) -> instant."""
    src, _ = setup(spark, sf_dir)
    text = F.concat(F.date_format(F.col("created_at") - F.expr("INTERVAL 4 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit("-04:00"))
    return present(src.weekly_orders.select("id", T.parse_timestamp(text).alias("parsed")))


@query("date_to_timestamp", fx("SELECT DISTINCT ship_date, CAST(ship_date AS TIMESTAMP) AS midnight FROM deliveries"))
def q_date_to_timestamp(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return present(src.deliveries.select("ship_date").distinct().select(
        "ship_date", T.date_to_timestamp("ship_date").alias("midnight")))


@query("date_to_text", fx("SELECT DISTINCT CAST(ship_date AS VARCHAR) AS ship_date_text FROM deliveries"))
def q_date_to_text(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return src.deliveries.select(T.date_to_text("ship_date").alias("ship_date_text")).distinct()


@query("distinct_dates", fx("SELECT DISTINCT ship_date FROM deliveries"))
def q_distinct_dates(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return src.deliveries.select("ship_date").distinct()


TENURE_RAW = "1 + " + O.week_diff("fo.first_start_date", "wo.start_date")
ORD_JOIN = ("FROM deliveries d JOIN weekly_orders wo ON wo.id = d.weekly_order_id "
            "JOIN fo ON fo.subscription_id = wo.subscription_id")


def _tenured(src, p):
    wo = src.weekly_orders.select(F.col("id").alias("weekly_order_id"), "subscription_id", "start_date")
    x = src.deliveries.join(wo, "weekly_order_id").join(first_order_dates(src, p), "subscription_id")
    return x.withColumn("raw_tenure", F.lit(1) + T.diff_weeks("first_start_date", "start_date"))


@query("tenure_least", fxo(f"SELECT d.id, CASE WHEN ({TENURE_RAW}) IS NULL THEN NULL "
                           f"ELSE least({TENURE_RAW}, 4) END AS tenure {ORD_JOIN}"))
def q_tenure_least(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _tenured(src, p).select("id", K.tenure_correction("raw_tenure").cast("long").alias("tenure"))


@query("tenure_iff", fxo(f"SELECT d.id, CASE WHEN ({TENURE_RAW}) <= 3 THEN ({TENURE_RAW}) ELSE 4 END AS tenure "
                         f"{ORD_JOIN}"))
def q_tenure_iff(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return _tenured(src, p).select("id", K.tenure_training("raw_tenure").cast("long").alias("tenure"))


@query("group_key", fxo(f"SELECT d.id, d.facility_id || '-' || d.freight_id || '-' || d.plan_id || '-' || "
                        f"least({TENURE_RAW}, 4) AS grp {ORD_JOIN}"))
def q_group_key(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    x = _tenured(src, p)
    return x.select("id", K.group_key("facility_id", "freight_id", "plan_id",
                                      K.tenure_correction("raw_tenure")).alias("grp"))


@query("group_key_fallback", fxo(f"SELECT d.id, d.facility_id || '-' || '0' || '-' || d.plan_id || '-' || "
                                 f"least({TENURE_RAW}, 4) AS fallback_grp {ORD_JOIN}"))
def q_group_key_fallback(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    x = _tenured(src, p)
    return x.select("id", K.fallback_group_key("facility_id", "plan_id",
                                               K.tenure_correction("raw_tenure")).alias("fallback_grp"))


@query("json_path", fx("SELECT object_type, object_id, created_at, "
                       "json_extract_string(change_set, '$.status[1]') AS new_status FROM event_logs"))
def q_json_path(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    v = K.change_set_variant(src.event_logs)
    return present(src.event_logs.select("object_type", "object_id", "created_at",
                                         K.status_new(v).alias("new_status")))


@query("json_present", fx("SELECT object_type, object_id, created_at, " + O.status_present("change_set")
                          + " AS has_status FROM event_logs"))
def q_json_present(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    v = K.change_set_variant(src.event_logs)
    return present(src.event_logs.select("object_type", "object_id", "created_at",
                                         K.status_present(v).alias("has_status")))


@query("status_alive", fx("SELECT object_id, created_at, " + O.status_alive("change_set") + " AS order_is_alive "
                          "FROM event_logs WHERE " + O.status_present("change_set")))
def q_status_alive(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    e = src.event_logs.select("object_id", "created_at", K.change_set_variant(src.event_logs).alias("v"))
    e = e.filter(K.status_present("v"))
    return present(e.select("object_id", "created_at", K.alive_flag(K.status_new("v")).alias("order_is_alive")))


@query("conditional_iff", fx("SELECT id, CASE WHEN is_first_for_subscription THEN number_of_meals ELSE 0 END "
                             "AS con_meals, CASE WHEN NOT is_first_for_subscription THEN number_of_meals ELSE 0 END "
                             "AS cor_meals FROM deliveries"))
def q_conditional_iff(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    first = F.col("is_first_for_subscription")
    return src.deliveries.select("id", K.iff(first, "number_of_meals", 0).alias("con_meals"),
                                 K.iff(~first, "number_of_meals", 0).alias("cor_meals"))


@query("asof_filter", fx("SELECT ship_date, CAST(count(*) AS BIGINT) AS known_deliveries FROM deliveries, params "
                         "WHERE created_at <= params.kt GROUP BY 1"))
def q_asof_filter(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return (src.deliveries.filter(F.col("created_at") <= p.kt_col()).groupBy("ship_date")
            .agg(F.count(F.lit(1)).alias("known_deliveries")))


@query("asof_filter_nullsafe", fx("""
    SELECT 'plans' AS table_name, id FROM plans, params WHERE params.kt >= created_at OR created_at IS NULL
    UNION ALL SELECT 'freights', id FROM freights, params WHERE params.kt >= created_at OR created_at IS NULL
    UNION ALL SELECT 'facilities', id FROM facilities, params WHERE params.kt >= created_at OR created_at IS NULL"""))
def q_asof_filter_nullsafe(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    kt = p.kt_col()
    parts = [t.filter(known_or_null("created_at", kt)).select(F.lit(n).alias("table_name"), "id")
             for n, t in (("plans", src.plans), ("freights", src.freights), ("facilities", src.facilities))]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("same_weekday", fx("SELECT ship_date, CAST(count(*) AS BIGINT) AS deliveries FROM deliveries "
                          "WHERE dayofweek(ship_date) = dayofweek(DATE '2019-09-20') GROUP BY 1"))
def q_same_weekday(spark, sf_dir):
    from hazardline.plans.dates import same_weekday
    src, _ = setup(spark, sf_dir)
    return (src.deliveries.filter(same_weekday(F.col("ship_date"), F.lit("2019-09-20").cast("date")))
            .groupBy("ship_date").agg(F.count(F.lit(1)).alias("deliveries")))


@query("first_order_date", fx("SELECT subscription_id, CAST(min(start_date) AS DATE) AS first_start_date "
                              "FROM weekly_orders, params WHERE created_at <= params.kt GROUP BY 1"))
def q_first_order_date(spark, sf_dir):
    src, p = setup(spark, sf_dir)
    return first_order_dates(src, p)


@query("global_max", fx("""
    SELECT 'weekly_orders' AS table_name, max(created_at) AS max_created_at FROM weekly_orders
    UNION ALL SELECT 'deliveries', max(created_at) FROM deliveries
    UNION ALL SELECT 'event_logs', max(created_at) FROM event_logs"""))
def q_global_max(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    parts = [t.agg(F.max("created_at").alias("max_created_at")).select(F.lit(n).alias("table_name"),
                                                                          "max_created_at")
             for n, t in (("weekly_orders", src.weekly_orders), ("deliveries", src.deliveries),
                          ("event_logs", src.event_logs))]
    return present(reduce(lambda a, b: a.unionByName(b), parts))


@query("inner_chain", fxo("SELECT d.id AS delivery_id, wo.id AS weekly_order_id, wo.subscription_id, "
                          "fo.first_start_date, wo.start_date FROM fo "
                          "JOIN weekly_orders wo ON fo.subscription_id = wo.subscription_id "
                          "JOIN deliveries d ON d.weekly_order_id = wo.id"))
def q_inner_chain(spark, sf_dir):
    """J1 subscription -> order -> delivery (sort-merge joins; AQE splits a hot subscription)."""
    src, p = setup(spark, sf_dir)
    wo = src.weekly_orders.select(F.col("id").alias("weekly_order_id"), "subscription_id", "start_date")
    x = first_order_dates(src, p).join(wo, "subscription_id").join(
        src.deliveries.select(F.col("id").alias("delivery_id"), "weekly_order_id"), "weekly_order_id")
    return x.select("delivery_id", "weekly_order_id", "subscription_id", "first_start_date", "start_date")


@query("star_join", fx("""
    SELECT fa.display_name AS facility, tz.facility_timezone, fr.name AS freight, pl.name AS plan,
           CAST(count(*) AS BIGINT) AS deliveries
    FROM deliveries d JOIN plans pl ON pl.id = d.plan_id JOIN freights fr ON fr.id = d.freight_id
    JOIN facilities fa ON fa.id = d.facility_id JOIN timezones tz ON tz.facility_id = fa.id
    GROUP BY 1, 2, 3, 4"""))
def q_star_join(spark, sf_dir):
    """The fact table joined to its small dimensions; AQE broadcasts them at run time
    once their measured size is under the threshold, the literal zone map always."""
    src, _ = setup(spark, sf_dir)
    d = (src.deliveries
         .join(src.plans.select(F.col("id").alias("plan_id"), F.col("name").alias("plan")), "plan_id")
         .join(src.freights.select(F.col("id").alias("freight_id"), F.col("name").alias("freight")), "freight_id")
         .join(src.facilities.select(F.col("id").alias("facility_id"), F.col("display_name").alias("facility")),
               "facility_id")
         .join(src.zone_of_facility(), "facility_id"))
    return d.groupBy("facility", "facility_timezone", "freight", "plan").agg(F.count(F.lit(1)).alias("deliveries"))


@query("inline_timezones", fx("""
    SELECT d.facility_id, tz.facility_timezone, CAST(count(*) AS BIGINT) AS deliveries
    FROM deliveries d JOIN timezones tz ON tz.facility_id = d.facility_id GROUP BY 1, 2"""))
def q_inline_timezones(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return (src.deliveries.join(src.zone_of_facility(), "facility_id")
            .groupBy("facility_id", "facility_timezone").agg(F.count(F.lit(1)).alias("deliveries")))


@query("event_log_join", fx("SELECT d.id AS delivery_id, d.weekly_order_id, d.ship_date, el.created_at AS event_time, "
                            + O.status_alive("el.change_set") + " AS order_is_alive "
                            "FROM deliveries d JOIN event_logs el ON el.object_type = 'deliveries' "
                            "AND el.object_id = d.id AND " + O.status_present("el.change_set")
                            + ", params WHERE el.created_at <= params.kt"))
def q_event_log_join(spark, sf_dir):
    """Literal + semi-structured predicates filter event_logs, then one equi-join."""
    src, p = setup(spark, sf_dir)
    d = src.deliveries.select(F.col("id").alias("delivery_id"), "weekly_order_id", "ship_date")
    return present(d.join(status_log(src, p), "delivery_id"))


@query("anti_delete", fx("""
    SELECT ship_date, CAST(count(*) AS BIGINT) AS untouched FROM deliveries d
    WHERE NOT EXISTS (SELECT 1 FROM event_logs el WHERE el.object_type = 'deliveries' AND el.object_id = d.id
                      AND """ + O.status_present("el.change_set") + """)
    GROUP BY 1"""))
def q_anti_delete(spark, sf_dir):
    """J13 DELETE ... USING as a left anti join: deliveries without any status change."""
    src, p = setup(spark, sf_dir)
    v = K.change_set_variant(src.event_logs)
    changed = (src.event_logs.filter((F.col("object_type") == "deliveries") & K.status_present(v))
               .select(F.col("object_id").alias("id")))
    return (src.deliveries.join(changed, "id", "left_anti").groupBy("ship_date")
            .agg(F.count(F.lit(1)).alias("untouched")))


@query("scan_sources", fx("""
    SELECT 'weekly_orders' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM weekly_orders
    UNION ALL SELECT 'deliveries', count(*) FROM deliveries
    UNION ALL SELECT 'event_logs', count(*) FROM event_logs
    UNION ALL SELECT 'plans', count(*) FROM plans
    UNION ALL SELECT 'freights', count(*) FROM freights
    UNION ALL SELECT 'facilities', count(*) FROM facilities"""))
def q_scan_sources(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    parts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, t in (("weekly_orders", src.weekly_orders), ("deliveries", src.deliveries),
                          ("event_logs", src.event_logs), ("plans", src.plans), ("freights", src.freights),
                          ("facilities", src.facilities))]
    return reduce(lambda a, b: a.unionByName(b), parts)


def sync_union(src):
    """U3 UNION ALL of each synced table's newest time (each side aggregates first)."""
    names = ("events", "orders", "lineitem", "signups")
    parts = [t.agg(F.max("_synced").alias("synced")).select(F.lit(n).alias("source"), "synced")
             for n, t in zip(names, src.sync_tables)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("union_all_sync", fx("""
    SELECT 'events' AS source, max(ts) AS synced FROM events
    UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
    UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
    UNION ALL SELECT 'signups', max(ts) FROM events WHERE event_type = 'signup'"""))
def q_union_all_sync(spark, sf_dir):
    src, _ = setup(spark, sf_dir)
    return present(sync_union(src))


@query("latest_sync_time", fx("SELECT max(synced) AS latest_sync_time FROM sync_times"))
def q_latest_sync_time(spark, sf_dir):
    """Max of the per-table maxima."""
    src, _ = setup(spark, sf_dir)
    return present(sync_union(src).agg(F.max("synced").alias("latest_sync_time")))


@query("last_complete_hour", fx("SELECT date_trunc('hour', max(synced)) AS knowledge_time FROM sync_times"))
def q_last_complete_hour(spark, sf_dir):
    """The correction's default knowledge time."""
    src, _ = setup(spark, sf_dir)
    return present(sync_union(src).agg(T.trunc_hour(F.max("synced")).alias("knowledge_time")))


@query("knowledge_time_resolve", fx("SELECT TIMESTAMP '2019-09-17 16:00:00' AS knowledge_time, "
                                    "CAST(count(*) AS BIGINT) AS orders_known FROM weekly_orders, params "
                                    "WHERE created_at <= params.kt"))
def q_knowledge_time_resolve(spark, sf_dir):
    """The KT argument is resolved once on the driver ('CURRENT_TIMESTAMP' -> now), then a literal."""
    src, p = setup(spark, sf_dir)
    kt = p.kt_col()
    return present(src.weekly_orders.filter(F.col("created_at") <= kt)
                   .agg(F.count(F.lit(1)).alias("orders_known")).select(kt.alias("knowledge_time"), "orders_known"))


@query("param_binding", fx("SELECT ship_date, CAST(count(*) AS BIGINT) AS known FROM deliveries, params "
                           "WHERE created_at <= params.kt AND ship_date >= DATE '2019-03-30' + 7 * 13 GROUP BY 1"))
def q_param_binding(spark, sf_dir):
    """S3: run parameters bound as named SQL parameters (no text substitution)."""
    src, p = setup(spark, sf_dir)
    return spark.sql(
        "SELECT ship_date, count(*) AS known FROM {d} "
        "WHERE created_at <= CAST(:kt AS TIMESTAMP) AND ship_date >= date_add(DATE'2019-03-30', 7 * :weeks) "
        "GROUP BY ship_date",
        args={"kt": p.kt.strftime("%Y-%m-%d %H:%M:%S+00:00"), "weeks": p.training_weeks},
        d=src.deliveries)


@query("sql_query_frame", with_fixtures(P, O.CORR_TARGETS, body=
       "SELECT CAST(target AS VARCHAR) AS ship_date FROM cr_targets"))
def q_sql_query_frame(spark, sf_dir):
    """A SQL query over DataFrames -> DataFrame (the correction plan in SQL form)."""
    src, p = setup(spark, sf_dir)
    return spark.sql(
        "SELECT DISTINCT CAST(ship_date AS STRING) AS ship_date FROM {d} "
        "WHERE created_at <= CAST(:kt AS TIMESTAMP) AND date_sub(ship_date, 3) >= to_date(CAST(:kt AS TIMESTAMP))",
        args={"kt": p.kt.strftime("%Y-%m-%d %H:%M:%S+00:00")}, d=src.deliveries)


@query("cte_pipeline", fx("""
    SELECT ship_date, CAST(max(meals) AS BIGINT) AS largest_facility, CAST(sum(meals) AS BIGINT) AS meals
    FROM (SELECT ship_date, facility_id, sum(number_of_meals) AS meals FROM deliveries, params
          WHERE created_at <= kt GROUP BY ALL) GROUP BY ALL"""))
def q_cte_pipeline(spark, sf_dir):
    """Named subqueries (WITH) in Spark SQL over a DataFrame argument."""
    src, p = setup(spark, sf_dir)
    return spark.sql("""
        WITH seen AS (SELECT ship_date, facility_id, number_of_meals FROM {d} WHERE created_at <= CAST(:kt AS TIMESTAMP)),
             per_facility AS (SELECT ship_date, facility_id, sum(number_of_meals) AS meals FROM seen GROUP BY ALL)
        SELECT ship_date, max(meals) AS largest_facility, sum(meals) AS meals FROM per_facility GROUP BY ship_date""",
                     args={"kt": p.kt.strftime("%Y-%m-%d %H:%M:%S+00:00")}, d=src.deliveries)
