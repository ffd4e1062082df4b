"""The jobs as one command, for spark-submit or ``python -m hazardline``.

    python -m hazardline weekly --source /data/orders --survival /data/survival
    python -m hazardline hourly --source /data/orders --sync event_logs=synced_at --survival /data/survival \\
                                --prediction /data/prediction [--ship-dates 2019-09-20 2019-09-21] [--knowledge-time ...]

``weekly`` trains curves (knowledge time: now unless given), ``hourly`` corrects predictions (knowledge time: the last complete
synced hour unless given).  Without ship dates the plan takes them from the data.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from hazardline import jobs
from hazardline.params import TRAINING_WEEKS, RunParams
from hazardline.session import ensure_utc
from hazardline.sources.tables import Sources

MODES = ("weekly", "hourly")


def run_event(spark: SparkSession, event: dict, source: str, survival: str, prediction: str | None = None,
              sync: dict[str, str] | None = None, packed: bool = False, **params) -> DataFrame:
    """Run what an event asks for: {"mode": "weekly" | "hourly", "ship_dates": [...], "knowledge_time": ...}, the last
    two optional.  A missing or unknown mode raises.  Returns the stored table."""
    mode = event.get("mode")
    if mode not in MODES:
        raise ValueError(f"mode {mode!r}: must be one of {', '.join(MODES)}")
    if unknown := sorted(set(event) - {"mode", "ship_dates", "knowledge_time"}):
        raise ValueError(f"unknown: {', '.join(unknown)}")
    ensure_utc(spark)
    p = RunParams(knowledge_time=event.get("knowledge_time"), ship_dates=tuple(event.get("ship_dates") or ()) or None, **params)
    src = Sources.from_parquet(spark, source, sync_tables=sync)
    if mode == "weekly":
        return jobs.run_training_job(spark, src, p, survival, packed)
    if not prediction:
        raise ValueError("hourly needs a prediction table")
    return jobs.run_correction_job(spark, src, p, survival, prediction)


def _arguments() -> argparse.ArgumentParser:
    a = argparse.ArgumentParser(prog="hazardline", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    a.add_argument("mode")
    a.add_argument("--source", required=True, help="folder with the operational tables")
    a.add_argument("--survival", required=True, help="folder of the curve table")
    a.add_argument("--packed", action="store_true", help="a new curve table gets one row per curve (weekly)")
    a.add_argument("--prediction", help="folder of the prediction table (hourly)")
    a.add_argument("--ship-dates", nargs="*", default=[])
    a.add_argument("--knowledge-time", help="ISO time with offset, or CURRENT_TIMESTAMP")
    a.add_argument("--training-weeks", type=int, default=TRAINING_WEEKS)
    a.add_argument("--sync", nargs="*", default=[], metavar="TABLE=COLUMN",
                   help="tables (or paths) and their sync time column, for the default knowledge time")
    return a


def run(spark: SparkSession, argv: list[str]) -> DataFrame:
    x = _arguments().parse_args(argv)
    event = {"mode": x.mode, "ship_dates": x.ship_dates, "knowledge_time": x.knowledge_time}
    return run_event(spark, event, x.source, x.survival, x.prediction,
                     dict(pair.rsplit("=", 1) for pair in x.sync), packed=x.packed, training_weeks=x.training_weeks)
