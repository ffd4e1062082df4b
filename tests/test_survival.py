"""Kaplan-Meier: textbook case (product-limit formula) and invariants."""

import pytest

from hazardline.operators.survival import kaplan_meier, pack, packed_kaplan_meier, unpack

SCHEMA = "ship_date string, grp string, lifespan long, died_bool boolean, weight long"


def curve(spark, rows, min_records=1):
    df = spark.createDataFrame([("d", "g") + r for r in rows], SCHEMA)
    out = kaplan_meier(df, min_records=min_records).orderBy("timeline").collect()
    return [r.survival_rate for r in out]


def test_textbook_weighted_case(spark):
    s = curve(spark, [(1, True, 1), (2, True, 2), (2, False, 1), (3, False, 1), (4, True, 1), (700, False, 1)])
    assert len(s) == 650
    assert s[0] == 1.0
    assert s[1] == pytest.approx(6 / 7)
    assert s[2] == pytest.approx(4 / 7) and s[3] == pytest.approx(4 / 7)
    assert all(x == pytest.approx(2 / 7) for x in s[4:])


def test_all_die_reaches_zero(spark):
    s = curve(spark, [(0, True, 2), (5, True, 1)])
    assert s[0] == pytest.approx(1 / 3) and s[4] == pytest.approx(1 / 3)
    assert all(x == 0.0 for x in s[5:])


def test_invariants_and_min_records(spark):
    rows = [(t, t % 3 == 0, 1 + t % 2) for t in range(0, 600, 7)]
    s = curve(spark, rows)
    assert all(0.0 <= x <= 1.0 for x in s)
    assert all(a >= b for a, b in zip(s, s[1:]))
    assert curve(spark, rows, min_records=len(rows) + 1) == []


def test_null_group_dropped(spark):
    df = spark.createDataFrame([("d", None, 1, True, 1), ("d", "g", 1, True, 1)], SCHEMA)
    assert kaplan_meier(df, min_records=1).select("grp").distinct().collect()[0].grp == "g"


def same(a, b):
    cols = ["ship_date", "grp", "timeline", "survival_rate"]
    return sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_packed_curves_are_the_long_ones(spark):
    rows = [("d", g, t, t % 2 == 0, 1 + t % 3) for g in ("a", "b") for t in (0, 1, 3, 9, 649, 650, 700)]
    rows += [("e", "a", 5, True, 1), ("e", "c", -2, False, 1), ("e", "c", 8, True, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    long, packed = kaplan_meier(df, min_records=1), packed_kaplan_meier(df, min_records=1)
    assert packed.count() == 4 and {len(r.rates) for r in packed.collect()} == {650}
    assert same(unpack(packed), long) and same(unpack(pack(long)), long)


def test_packing_keeps_gaps_and_refuses_two_rates_for_a_point(spark):
    schema = "ship_date string, grp string, timeline int, survival_rate double"
    df = spark.createDataFrame([("d", "a", 1, 0.9), ("d", "a", 4, 0.5), ("d", "b", 0, 1.0)], schema)
    assert same(unpack(pack(df)), df)
    assert pack(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|uplicate map key"):
        pack(spark.createDataFrame([("d", "a", 0, 0.9), ("d", "a", 0, 0.5)], schema)).collect()
