"""The operational tables the jobs read, as DataFrames.

A deployment points :meth:`Sources.from_catalog` or :meth:`Sources.from_parquet`
at its tables; tests and the benchmark use :func:`fixture_sources`, which derives
the same schemas from the driver's ``orders`` table.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.params import FACILITY_ZONES

TABLES = ("weekly_orders", "deliveries", "event_logs", "plans", "freights", "facilities")


def literal_rows(spark: SparkSession, rows, names) -> DataFrame:
    """A literal relation evaluated in the JVM (no Python-backed RDD behind it)."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def literal_table(spark: SparkSession, columns: dict[str, tuple[pa.DataType, list]]) -> DataFrame:
    """A literal relation of many rows (a LocalRelation: no RDD, no file, no Python at run time)."""
    return spark.createDataFrame(pa.table({n: pa.array(v, t) for n, (t, v) in columns.items()}))


def timezones_frame(spark: SparkSession, zones=FACILITY_ZONES) -> DataFrame:
    """S5 inline facility -> zone relation (3 literal rows; broadcast-safe by construction)."""
    return literal_rows(spark, zones, ("facility_id", "facility_timezone")).select(
        F.col("facility_id").cast("int"), F.col("facility_timezone").cast("string"))


def sync_times(tables: dict[str, DataFrame], columns: dict[str, str] | None) -> tuple[DataFrame, ...]:
    """The sync times of each table as a frame with the column ``_synced``."""
    return tuple(df.select(F.col(columns[t]).cast("timestamp").alias("_synced")) for t, df in tables.items())


@dataclass
class Sources:
    weekly_orders: DataFrame
    deliveries: DataFrame
    event_logs: DataFrame
    plans: DataFrame
    freights: DataFrame
    facilities: DataFrame
    timezones: DataFrame
    # Tables whose newest sync time marks data freshness
    sync_tables: tuple[DataFrame, ...] = ()

    @classmethod
    def from_parquet(cls, spark: SparkSession, base: str, zones=FACILITY_ZONES,
                     sync_tables: dict[str, str] | None = None) -> "Sources":
        """``sync_tables``: table under ``base``, or a path -> column with the time a row was synced."""
        rd = {t: spark.read.parquet(f"{base.rstrip('/')}/{t}") for t in TABLES}
        synced = {t: spark.read.parquet(t if "/" in t else f"{base.rstrip('/')}/{t}") for t in sync_tables or {}}
        return cls(timezones=timezones_frame(spark, zones), sync_tables=sync_times(synced, sync_tables), **rd)

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "", zones=FACILITY_ZONES,
                     sync_tables: dict[str, str] | None = None) -> "Sources":
        """``sync_tables``: table name after ``prefix`` -> column with the time a row was synced."""
        rd = {t: spark.table(f"{prefix}{t}") for t in TABLES}
        synced = {t: spark.table(f"{prefix}{t}") for t in sync_tables or {}}
        return cls(timezones=timezones_frame(spark, zones), sync_tables=sync_times(synced, sync_tables), **rd)

    def zone_of_facility(self) -> DataFrame:
        """Zone map; literal and tiny, so broadcasting it is always safe."""
        return F.broadcast(self.timezones)
