"""Registry shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline import jobs
from hazardline.params import REFERENCE_KT, RunParams
from hazardline.session import ensure_utc
from hazardline.sources.fixtures import fixture_sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a Spark callable under ``name`` (and its oracle SQL, if SQL-expressible)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def reference_params(**kw) -> RunParams:
    return RunParams(knowledge_time=REFERENCE_KT, **kw)


def setup(spark: SparkSession, sf_dir: str, **kw):
    ensure_utc(spark)
    return fixture_sources(spark, sf_dir), reference_params(**kw)


M6 = ("predicted_con", "predicted_cor", "predicted_coa", "predicted_orders",
      "adjusted_con", "adjusted_cor", "adjusted_coa")


def present(df: DataFrame) -> DataFrame:
    """Report form: timestamps as zone-less UTC wall clock; doubles rounded
    (9 decimals; 6 for sums over many cohorts, whose magnitude is in the thousands)."""
    out = []
    for c, t in df.dtypes:
        if t == "timestamp":
            out.append(F.col(c).cast("timestamp_ntz").alias(c))
        elif c in M6:
            out.append(F.round(F.col(c), 6).alias(c))
        elif t == "double":
            out.append(F.round(F.col(c), 9).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def training(spark, sf_dir, **kw):
    src, p = setup(spark, sf_dir, **kw)
    return src, p, jobs.training_plan(spark, src, p)


def correction(spark, sf_dir, **kw):
    src, p = setup(spark, sf_dir, **kw)
    return src, p, jobs.correction_plan(spark, src, p)
