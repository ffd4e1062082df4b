"""The wide export in sets of columns."""

import datetime as dt

import pytest

from hazardline.operators.survival import kaplan_meier
from hazardline.session import scratch_path
from hazardline.sources import wide
from tests.test_survival import SCHEMA, same

LONG = "ship_date date, grp string, timeline int, survival_rate double"
D = dt.date(2019, 9, 20)


def test_sets_hold_every_group_once_and_read_back(spark):
    rows = [(d, f"g{g}", t, True, 1) for d in ("d", "e") for g in range(7) if (d, g) != ("e", 3) for t in (1, 3, 9)]
    curves = kaplan_meier(spark.createDataFrame(rows, SCHEMA), min_records=1)
    path = scratch_path(spark, "wide")
    assert wide.export_wide(curves, path, width=3) == 3
    assert same(wide.read_long(spark, path), curves)
    side = wide.read_wide(spark, path)
    assert sorted(side.columns) == ["g0", "g1", "g2", "g3", "g4", "g5", "g6", "ship_date", "timeline"]
    assert side.count() == 2 * 650 and side.filter("ship_date = 'e' AND g3 IS NOT NULL").count() == 0
    two = wide.read_wide(spark, path, ["g6", "g1"])
    assert two.columns == ["ship_date", "timeline", "g1", "g6"] and two.count() == 1300
    assert not any(f"set={1:05d}" in f for f in two.inputFiles())
    with pytest.raises(KeyError):
        wide.read_wide(spark, path, ["g7"])


@pytest.mark.parametrize("n", [2, 4])
def test_width_that_divides_the_groups(spark, n):
    curves = spark.createDataFrame([(D, f"{i}-0-1.5", 0, 1.0) for i in range(n)], LONG)
    path = scratch_path(spark, "wide")
    assert wide.export_wide(curves, path, width=2) == n // 2
    assert same(wide.read_long(spark, path), curves)


def test_no_curves_and_no_group(spark):
    for rows in ([], [(D, None, 0, 1.0)]):
        path = scratch_path(spark, "wide")
        assert wide.export_wide(spark.createDataFrame(rows, LONG), path) == 1
        assert wide.read_wide(spark, path).columns == ["ship_date", "timeline"]
        assert wide.read_long(spark, path).count() == 0


def test_an_export_that_was_killed_is_none(spark, monkeypatch):
    curves = spark.createDataFrame([(D, f"g{i}", 0, 1.0) for i in range(4)], LONG)
    path = scratch_path(spark, "wide")
    real, calls = wide.unpack, []

    def dies(x):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(x)
    monkeypatch.setattr(wide, "unpack", dies)
    with pytest.raises(RuntimeError):
        wide.export_wide(curves, path, width=2)
    with pytest.raises(FileNotFoundError):
        wide.read_wide(spark, path)
    with pytest.raises(FileExistsError):
        wide.export_wide(curves, path)
