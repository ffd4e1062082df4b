"""Processing plans and training windows, all as DataFrames of dates.

Dates are never collected to drive a loop: every target ship date of a request
is a key column of one Spark job.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardline.functions.timefn import add_days, add_weeks
from hazardline.params import EVENT_HISTORY_START, FINALIZATION_DAYS, RunParams
from hazardline.sources.tables import Sources, literal_table

__all__ = [
    "plan_training_dates", "plan_correction_dates", "explicit_dates", "target_dates",
    "same_weekday", "training_windows", "topk_dates", "Calendar", "literal_dates",
]


def _known_deliveries(src: Sources, p: RunParams) -> DataFrame:
    """P1 deliveries created at or before the knowledge time (NULL creation excluded)."""
    return src.deliveries.filter(F.col("created_at") <= p.kt_col())


def first_open_date(p: RunParams):
    """Earliest ship date whose finalization day is not before the KT date; on this side of the comparison, so that the bound
    on ship_date reaches the scan."""
    return add_days(F.to_date(p.kt_col()), FINALIZATION_DAYS)


def plan_training_dates(src: Sources, p: RunParams) -> DataFrame:
    """Known deliveries, finalization on/after the KT date, not before the history floor."""
    floor = add_weeks(F.lit(EVENT_HISTORY_START).cast("date"), p.training_weeks)
    return (
        _known_deliveries(src, p)
        .filter(F.col("ship_date") >= first_open_date(p))
        .filter(F.col("ship_date") >= floor)
        .select("ship_date").distinct()
    )


def plan_correction_dates(src: Sources, p: RunParams) -> DataFrame:
    """As P3 without the floor (the reference orders these descending)."""
    return (
        _known_deliveries(src, p)
        .filter(F.col("ship_date") >= first_open_date(p))
        .select("ship_date").distinct()
    )


def explicit_dates(spark: SparkSession, dates) -> DataFrame:
    """Ship dates given by the request (a handful of literals)."""
    from hazardline.sources.tables import literal_rows
    return literal_rows(spark, [(str(d),) for d in dates], ("ship_date",)).select(
        F.col("ship_date").cast("date").alias("ship_date")).distinct()


def target_dates(spark: SparkSession, src: Sources, p: RunParams, mode: str) -> DataFrame:
    if p.ship_dates:
        return explicit_dates(spark, p.ship_dates)
    return plan_training_dates(src, p) if mode == "train" else plan_correction_dates(src, p)


def same_weekday(a, b):
    """P5 DATE_PART('DOW', a) = DATE_PART('DOW', b)."""
    return F.dayofweek(a) == F.dayofweek(b)


def training_windows(src: Sources, p: RunParams, targets: DataFrame) -> DataFrame:
    """P6 for all targets at once -> (ship_date = target, source_date).

    Per target: the latest ``training_weeks`` distinct delivered dates on the same
    weekday, finalized by the KT date, not after the target and already shipped
    at KT.  Both sides are distinct dates (bounded by the calendar, not by data
    volume); the per-target top-N is ``row_number`` (planned as a window group limit).
    """
    kt = p.kt_col()
    cand = (
        _known_deliveries(src, p)
        .filter(F.col("ship_date") <= F.to_date(kt))  # already shipped at KT, hence finalized
        .select(F.col("ship_date").alias("source_date")).distinct()
    )
    t = targets.select(F.col("ship_date"))
    pairs = t.join(cand, same_weekday(t.ship_date, cand.source_date) & (cand.source_date <= t.ship_date))
    w = Window.partitionBy("ship_date").orderBy(F.col("source_date").desc())
    return (pairs.withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= p.training_weeks).drop("rn"))


def topk_dates(dates: DataFrame, n: int) -> DataFrame:
    """L2 single-target form: distinct dates, latest n."""
    return dates.distinct().orderBy(F.col(dates.columns[0]).desc()).limit(n)


def literal_dates(spark: SparkSession, dates: list[dt.date], name: str = "ship_date") -> DataFrame:
    return literal_table(spark, {name: (pa.date32(), dates)})


@dataclass(frozen=True)
class Calendar:
    """The training windows of a request as literals: bounded by the calendar, not by data.

    They come to the driver once (targets x training weeks pairs), so that fact scans get date bounds, and the
    fan-out to targets can wait until after the counts.
    """

    pairs: tuple[tuple[dt.date, dt.date], ...]          # (target, source date)

    @classmethod
    def of(cls, windows: DataFrame) -> "Calendar":
        return cls(tuple(sorted((r[0], r[1]) for r in windows.select("ship_date", "source_date").collect())))

    @property
    def source_dates(self) -> list[dt.date]:
        return sorted({s for _, s in self.pairs})

    def windows(self, spark: SparkSession) -> DataFrame:
        """(ship_date, source_date)"""
        return literal_table(spark, {"ship_date": (pa.date32(), [t for t, _ in self.pairs]),
                                     "source_date": (pa.date32(), [s for _, s in self.pairs])})

    def targets_of(self, spark: SparkSession) -> DataFrame:
        """(source_date, targets): the target dates whose window has the source date."""
        by = {s: [t for t, x in self.pairs if x == s] for s in self.source_dates}
        return literal_table(spark, {"source_date": (pa.date32(), list(by)), "targets": (pa.list_(pa.date32()), list(by.values()))})

    def has(self, c: str) -> Column:
        return F.col(c).isin(self.source_dates) if self.pairs else F.lit(False)
