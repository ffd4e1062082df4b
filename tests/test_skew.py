"""A hot subscription (most of all orders): its rows are dealt to many tasks, and splitting does not change results."""

import datetime as dt

from hazardline import jobs
from hazardline.operators.facts import first_order_dates
from hazardline.params import RunParams
from tests.handmade import at, d, skip, sources


def _hot_sources(spark):
    orders, dels, logs = [], [], []
    for i in range(60):
        sub = 7 if i % 4 else 100 + i          # subscription 7 holds three quarters of the orders
        sd = dt.date(2019, 7, 5) + dt.timedelta(days=7 * (i % 6))
        created = dt.datetime.combine(sd, dt.time(9)) - dt.timedelta(days=5, minutes=i)
        orders.append((i, sub, sub, "O", sd - dt.timedelta(days=sd.weekday()), created))
        dels.append((1000 + i, i, sd, 2, 1 + i % 2, 1 + i % 2, 4, i % 4 == 0, created))
        if i % 3 == 0:
            logs.append(at(skip(1000 + i), (created + dt.timedelta(hours=20 + i)).isoformat()))
    return sources(spark, orders, dels, logs)


def _collect(df):
    return sorted(tuple(r) for r in df.collect())


def test_skew_split_keeps_results(spark):
    src = _hot_sources(spark)
    p = RunParams(knowledge_time="2019-08-12T00:00:00+00:00", ship_dates=("2019-08-09",), min_records=1)
    confs = {"spark.sql.adaptive.skewJoin.enabled": "true",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        split = (_collect(first_order_dates(src, p)), _collect(jobs.training_plan(spark, src, p).training))
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        plain = (_collect(first_order_dates(src, p)), _collect(jobs.training_plan(spark, src, p).training))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert split == plain
    firsts = dict(split[0])
    assert firsts[7] == d("2019-07-01")
    assert len(split[1]) > 0


def test_hot_subscription_is_dealt_to_many_tasks(spark):
    """Three quarters of the rows have one key; after the join no task has more than a small part of them."""
    from pyspark.sql import functions as F
    from hazardline.operators.hot import join_one_per_key
    rows = spark.range(20000).select(F.col("id"), F.when(F.col("id") % 4 != 0, F.lit(7)).when(F.col("id") % 8 == 0, F.col("id")).alias("k"))
    side = rows.where("k IS NOT NULL").groupBy("k").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        joined = join_one_per_key(rows, side, "k", "n", F.col("id"), share=100)
        assert sorted(joined.columns) == ["id", "k", "least"]
        per_task = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        plain = rows.join(side.drop("n"), "k")
        assert sorted(map(tuple, joined.select("id", "k", "least").collect())) == sorted(map(tuple, plain.select("id", "k", "least").collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(per_task) == 17500 and len(per_task) > 24 and max(per_task) < 17500 / 8


def test_hot_join_of_nothing(spark):
    from pyspark.sql import functions as F
    from hazardline.operators.hot import join_one_per_key
    side = spark.createDataFrame([], "k long, v long, n long")
    assert join_one_per_key(spark.range(3).withColumnRenamed("id", "k"), side, "k", "n", F.col("k")).count() == 0


def test_a_null_key_may_be_hot_too(spark):
    from pyspark.sql import functions as F
    from hazardline.operators.hot import join_one_per_key
    rows = spark.range(1000).select("id", F.when(F.col("id") >= 900, F.col("id") % 5).alias("k"))
    side = rows.groupBy("k").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    joined = join_one_per_key(rows, side, "k", "n", F.col("id"), share=100)
    assert sorted(r.id for r in joined.collect()) == list(range(900, 1000))
