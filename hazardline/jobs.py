"""The training and correction jobs as lazy DataFrame pipelines.

All target ship dates of a request run in ONE Spark job keyed by ship_date
(the reference loops over dates with a time budget).  Only the requested dates, the
folder names of what was written and one sync time come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazardline.operators.facts import training_facts
from hazardline.operators.lifecycle import lifespans, per_target, training_deaths, training_lives
from hazardline.operators.survival import kaplan_meier, packed_kaplan_meier
from hazardline.operators.training import training_counts
from hazardline.params import RunParams
from hazardline.plans.dates import Calendar, literal_dates, target_dates, training_windows
from hazardline.session import ensure_utc
from hazardline.sources import sinks
from hazardline.sources.store import SnapshotTable
from hazardline.sources.tables import Sources


@dataclass
class TrainingPlan:
    src: Sources
    p: RunParams
    targets: DataFrame
    calendar: Calendar
    lives: DataFrame
    training: DataFrame
    curves: DataFrame
    packed: DataFrame

    # The intermediate tables per target date, which the training itself never builds:

    @property
    def windows(self) -> DataFrame:
        return self.calendar.windows(self.targets.sparkSession)

    @property
    def facts(self) -> DataFrame:
        return training_facts(self.src, self.p, self.calendar)

    @property
    def deaths(self) -> DataFrame:
        return training_deaths(training_lives(self.src, self.p, self.calendar), self.calendar)

    @property
    def lifespans(self) -> DataFrame:
        return per_target(self.lives, self.calendar)


def training_plan(spark: SparkSession, src: Sources, p: RunParams, targets: DataFrame | None = None,
                  observe: Observation | None = None) -> TrainingPlan:
    """The training of all target dates.  The windows are worked out at once and come to the driver (pairs of dates);
    all else is lazy.  ``observe`` is told the dates that got training rows by whichever job computes the curves."""
    ensure_utc(spark)
    targets = targets if targets is not None else target_dates(spark, src, p, "train")
    calendar = Calendar.of(training_windows(src, p, targets))
    lives = lifespans(training_lives(src, p, calendar), src, p)
    ts = training_counts(lives, calendar)
    if observe is not None:
        ts = ts.observe(observe, F.collect_set(F.col("ship_date").cast("string")).alias("dates"))
    return TrainingPlan(src, p, targets, calendar, lives, ts, kaplan_meier(ts, p.min_records, p.horizon),
                        packed_kaplan_meier(ts, p.min_records, p.horizon))


def train(spark: SparkSession, src: Sources, p: RunParams, targets: DataFrame | None = None) -> DataFrame:
    """Curves (ship_date, grp, timeline, survival_rate) for every target date."""
    return training_plan(spark, src, p, targets).curves


class QualityGateError(ValueError):
    """Nothing to train on / nothing to store."""


def quality_gate(df: DataFrame, what: str, dates=None) -> DataFrame:
    """Fail when ``df`` is empty, or has no row for one of ``dates``; ``df`` should be a stored table."""
    if dates is None:
        if df.limit(1).count() == 0:
            raise QualityGateError(f"empty {what}")
        return df
    have = {r[0] for r in df.select("ship_date").distinct().collect()}
    if missing := sorted(str(x) for x in set(dates) - have):
        raise QualityGateError(f"empty {what} for {', '.join(missing)}")
    return df


def requested_dates(targets: DataFrame) -> list:
    """The ship dates of a request (calendar-bounded)."""
    return sorted(r[0] for r in targets.select("ship_date").distinct().collect())


@dataclass
class CorrectionPlan:
    targets: DataFrame
    ordinals: DataFrame
    cohorts: DataFrame
    actuals: DataFrame
    predicted: DataFrame
    corrected: DataFrame
    final: DataFrame
    curves: DataFrame


def correction_plan(spark: SparkSession, src: Sources, p: RunParams, curves: DataFrame | None = None,
                    targets: DataFrame | None = None) -> CorrectionPlan:
    """The correction for every target date; ``curves`` (long or packed) default to training the same dates."""
    from hazardline.operators.actuals import actuals
    from hazardline.operators.correction import corrected, final_prediction
    from hazardline.operators.facts import delivery_ordinals
    from hazardline.operators.prediction import birth_cohorts, predicted
    ensure_utc(spark)
    dates = requested_dates(targets if targets is not None else target_dates(spark, src, p, "correct"))
    targets = literal_dates(spark, dates)
    if curves is None:
        curves = training_plan(spark, src, p, targets).packed
    elif dates:
        curves = curves.filter(F.col("ship_date").isin(dates))  # the other dates' folders are not read
    ordinals = delivery_ordinals(src, p, dates)
    cohorts = birth_cohorts(ordinals)
    act = actuals(src, p, targets, dates)
    pred = predicted(cohorts, curves)
    corr = corrected(pred, act)
    return CorrectionPlan(targets, ordinals, cohorts, act, pred, corr, final_prediction(corr, p.freeze_rows),
                          curves)


def correct(spark: SparkSession, src: Sources, p: RunParams, curves: DataFrame | None = None,
            targets: DataFrame | None = None) -> DataFrame:
    """The 20 prediction columns for every target date."""
    return correction_plan(spark, src, p, curves, targets).final


def backtest_correct(spark: SparkSession, src: Sources, p: RunParams, runs, curves: DataFrame | None = None) -> DataFrame:
    """D14 the correction for every (ship date, knowledge time) of ``runs`` in one job: ``knowledge_time`` and the 20 columns.

    ``curves`` default to those that the weekly job would have had at the earliest knowledge time, so no run sees ahead.
    """
    from hazardline.operators.backtest import Runs, backtest_plan
    ensure_utc(spark)
    runs = Runs.of(runs)
    if curves is None and runs.pairs:
        curves = training_plan(spark, src, p.with_(knowledge_time=runs.times[0]), literal_dates(spark, runs.dates)).packed
    return backtest_plan(src, p, runs, curves).final


def run_training_job(spark: SparkSession, src: Sources, p: RunParams, survival_path: str, packed: bool = False) -> DataFrame:
    """D15 weekly training end to end: plan -> curves -> gates -> replace the curves of all requested dates in one commit.

    ``packed`` stores one row per curve (grp, rates, ship_date) instead of one per timeline point: the hourly job then reads a
    row where it read 650, and the list of curves without their rates.

    The curves are computed once, into data folders that no reader sees yet; the gates look at what that one job wrote
    and observed, so they cost no further job.  A requested date without training rows or without curves fails the job
    and nothing is replaced.  Returns the stored table.
    """
    table = SnapshotTable(spark, survival_path)
    table.create(sinks.PACKED_SCHEMA if packed else sinks.SURVIVAL_SCHEMA, "ship_date")
    seen = Observation()
    plan = training_plan(spark, src, p, observe=seen)
    dates = requested_dates(plan.targets)
    staged = table.stage(sinks.packed_rows(plan.packed) if packed else sinks.survival_rows(plan.curves))
    # with no curve at all the observed node may have been optimised away
    trained = set(seen.get["dates"]) if staged.values else set()
    try:
        gate_dates("training set", dates, trained if staged.values or not dates else None)
        gate_dates("curve set", dates, staged.values)
    except QualityGateError:
        table.discard(staged)
        raise
    table.publish(staged, dates, note={"mode": "weekly", "knowledge_time": p.kt.isoformat()})
    return table.read()


def gate_dates(what: str, dates, have) -> None:
    """Every requested date must be among ``have`` (None: not known, nothing is tested)."""
    if have is not None and (missing := sorted({str(d) for d in dates} - {str(d) for d in have})):
        raise QualityGateError(f"empty {what} for {', '.join(missing)}")


def stored_curves(spark: SparkSession, survival_path: str) -> DataFrame:
    """Curves as the correction reads them back from the survival table (rates in double), long or packed as they are stored; a
    plain parquet folder will do."""
    table = SnapshotTable(spark, survival_path)
    rows = table.read() if table.exists() else spark.read.parquet(survival_path)
    if "rates" in rows.columns:
        return rows.select("ship_date", "grp", F.col("rates").cast("array<double>").alias("rates"))
    return rows.select("ship_date", "grp", "timeline", F.col("survival_rate").cast("double").alias("survival_rate"))


def run_correction_job(spark: SparkSession, src: Sources, p: RunParams, survival_path: str,
                       prediction_path: str) -> DataFrame:
    """D15 hourly correction end to end: KT defaults to the last complete synced hour (S8/S9), the curves come from the
    survival table, the predictions of all requested ship dates are replaced in one commit.  Returns the stored table.

    Without a KT the sources must name their sync tables; "now" has to be asked for ("CURRENT_TIMESTAMP").
    """
    if p.knowledge_time is None:
        if not src.sync_tables:
            raise ValueError("no knowledge time: give one, or sources with sync_tables")
        p = p.with_(knowledge_time=last_complete_hour(src))
    table = SnapshotTable(spark, prediction_path)
    table.create(sinks.PREDICTION_SCHEMA, "ship_date")
    targets = target_dates(spark, src, p, "correct")
    final = correct(spark, src, p, curves=stored_curves(spark, survival_path), targets=targets)
    table.replace(sinks.prediction_rows(final), requested_dates(targets),
                  note={"mode": "hourly", "knowledge_time": p.kt.isoformat()})
    return table.read()


def latest_sync_time(src: Sources):
    """Newest sync time over the synced tables (each side aggregates before the union);
    one row comes back to the driver."""
    parts = [t.agg(F.max("_synced").alias("synced")) for t in src.sync_tables]
    return reduce(lambda a, b: a.unionByName(b), parts).agg(F.max("synced").alias("m")).first()["m"]


def synced_hour(src: Sources) -> DataFrame:
    """S9 one row: the hour that the newest sync time lies in.  Once anything of an hour has arrived, all before that hour has."""
    newest = [t.agg(F.max("_synced").alias("t")) for t in src.sync_tables]
    return reduce(DataFrame.unionByName, newest).agg(F.date_trunc("hour", F.max("t")).alias("hour"))


def last_complete_hour(src: Sources) -> str:
    """S9 as a knowledge time."""
    t = synced_hour(src).select(F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).first()[0]
    if t is None:
        raise ValueError("the sync tables are empty: no knowledge time can be derived")
    return t
