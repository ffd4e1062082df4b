"""Hand cases for time, key and status semantics (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from hazardline.functions import keys as K
from hazardline.functions import timefn as T


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_diff_hours_counts_boundaries(spark):
    e = T.diff_hours(F.lit("2019-01-01 00:59:00").cast("timestamp"), F.lit("2019-01-01 01:01:00").cast("timestamp"))
    assert one(spark, e) == 1


def test_diff_weeks_monday_boundary(spark):
    e = T.diff_weeks(F.lit("2019-01-06").cast("date"), F.lit("2019-01-07").cast("date"))
    assert one(spark, e) == 1
    assert one(spark, T.diff_weeks(F.lit("2019-01-07").cast("date"), F.lit("2019-01-13").cast("date"))) == 0


def test_local_cutoffs(spark):
    import datetime as dt
    jan = one(spark, T.alignment_ts(F.lit("2019-01-15").cast("date"), F.lit("US/Eastern")).cast("timestamp_ntz"))
    jul = one(spark, T.alignment_ts(F.lit("2019-07-15").cast("date"), F.lit("US/Eastern")).cast("timestamp_ntz"))
    az = one(spark, T.alignment_ts(F.lit("2019-07-15").cast("date"), F.lit("US/Arizona")).cast("timestamp_ntz"))
    assert jan == dt.datetime(2019, 1, 15, 22) and jul == dt.datetime(2019, 7, 15, 21)
    assert az == dt.datetime(2019, 7, 16, 0)
    fin = one(spark, T.finalization_ts(F.lit("2019-07-15").cast("date"), F.lit("US/Eastern")).cast("timestamp_ntz"))
    assert fin == dt.datetime(2019, 7, 12, 21)


def test_tenure_null_rules(spark):
    null = F.lit(None).cast("int")
    assert one(spark, K.tenure_training(null)) == 4
    assert one(spark, K.tenure_correction(null)) is None
    assert one(spark, K.tenure_correction(F.lit(9))) == 4
    assert one(spark, K.tenure_training(F.lit(2))) == 2


def test_group_key_null_part(spark):
    assert one(spark, K.group_key(F.lit(1), F.lit(None).cast("int"), F.lit(2), F.lit(3))) is None
    assert one(spark, K.group_key(F.lit(1), F.lit(2), F.lit(3), F.lit(4))) == "1-2-3-4"
    assert one(spark, K.fallback_group_key(F.lit(1), F.lit(3), F.lit(4))) == "1-0-3-4"


def test_status_json_edge_cases(spark):
    rows = spark.createDataFrame(
        [('{"status":null}',), ('{"status":"skipped_open"}',), ('{"status":["open","skipped_open"]}',),
         ('{"note":["a","b"]}',), ("not json",)], "change_set string")
    v = K.change_set_variant(rows)
    got = rows.select(K.status_present(v).alias("p"), K.alive_flag(K.status_new(v)).alias("a")).collect()
    assert [(r.p, r.a) for r in got] == [(True, True), (True, True), (True, False), (False, True), (False, True)]


def test_safe_ratio_and_iff(spark):
    assert one(spark, K.safe_ratio(F.lit(3), F.lit(0))) is None
    assert one(spark, K.iff(F.lit(None).cast("boolean"), F.lit(1), F.lit(2))) == 2
