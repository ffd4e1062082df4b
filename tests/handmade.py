"""Small hand-written source tables for unit cases (schemas as in FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from hazardline.sources.tables import Sources, timezones_frame

WO = T.StructType([T.StructField("id", T.LongType()), T.StructField("subscription_id", T.LongType()),
                   T.StructField("user_id", T.LongType()), T.StructField("status", T.StringType()),
                   T.StructField("start_date", T.DateType()), T.StructField("created_at", T.TimestampType())])
DL = T.StructType([T.StructField("id", T.LongType()), T.StructField("weekly_order_id", T.LongType()),
                   T.StructField("ship_date", T.DateType()), T.StructField("facility_id", T.IntegerType()),
                   T.StructField("freight_id", T.IntegerType()), T.StructField("plan_id", T.IntegerType()),
                   T.StructField("number_of_meals", T.IntegerType()),
                   T.StructField("is_first_for_subscription", T.BooleanType()),
                   T.StructField("created_at", T.TimestampType())])
EL = T.StructType([T.StructField("object_type", T.StringType()), T.StructField("object_id", T.LongType()),
                   T.StructField("created_at", T.TimestampType()), T.StructField("change_set", T.StringType())])
DIM = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                    T.StructField("created_at", T.TimestampType())])
FAC = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("display_name", T.StringType()),
                    T.StructField("created_at", T.TimestampType())])

OLD = dt.datetime(2015, 1, 1)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def sources(spark, orders, deliveries, logs) -> Sources:
    return Sources(
        weekly_orders=spark.createDataFrame(orders, WO),
        deliveries=spark.createDataFrame(deliveries, DL),
        event_logs=spark.createDataFrame(logs, EL),
        plans=spark.createDataFrame([(i, f"plan {i}", OLD) for i in (1, 2, 3)], DIM),
        freights=spark.createDataFrame([(i, f"freight {i}", OLD) for i in (1, 2)], DIM),
        facilities=spark.createDataFrame([(i, f"facility {i}", OLD) for i in (1, 2, 3)], FAC),
        timezones=timezones_frame(spark),
    )


def skip(oid):
    return ("deliveries", oid, None, '{"status":["open","skipped_open"]}')


def unskip(oid):
    return ("deliveries", oid, None, '{"status":["skipped_open","open"]}')


def at(row, when):
    return row[:2] + (ts(when),) + row[3:]
