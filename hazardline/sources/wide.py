"""J12/D7 the wide export of curves (one column per group) and back.

    <path>/set=00000/part-*.parquet     ship_date, timeline, then one column for each of at most ``width`` groups
    <path>/groups/set=00000/...         the groups of that set
    <path>/_COMPLETE                    written last: a folder without it is no export

The groups are taken in the order of their names, ``width`` at a time, so neither the driver nor a plan ever holds more
than ``width`` names, and a task holds ``width`` values a row, however many groups there are.  The list of groups comes from
the keys of packed curves; the rows of a set are found by the range of its names, on files sorted by them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.operators.survival import pack, unpack
from hazardline.session import scratch_path

KEYS = ("ship_date", "timeline")
WIDTH = 500


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def export_wide(curves: DataFrame, path: str, width: int = WIDTH) -> int:
    """Write curves, long or packed, as column sets; returns how many.  ``path`` must not exist.

    Curves without a group are left out.  Without curves there is one set without group columns.
    """
    spark = curves.sparkSession
    where, fs = _file_system(spark, path)
    if fs.exists(where):
        raise FileExistsError(path)
    sorted_path = scratch_path(spark, "wide-source")
    (pack(curves).filter(F.col("grp").isNotNull()).repartitionByRange("grp").sortWithinPartitions("grp").write.parquet(sorted_path))
    packed = spark.read.parquet(sorted_path)
    sets, last = 0, None
    while True:
        keys = packed if last is None else packed.filter(F.col("grp") > last)
        names = [r[0] for r in keys.select("grp").distinct().orderBy("grp").limit(width).collect()]
        if not names and sets:
            break
        rows = unpack(packed.filter(F.col("grp").between(names[0], names[-1]) if names else F.lit(False)))
        wide = rows.groupBy(*KEYS).pivot("grp", names).agg(F.first("survival_rate")) if names else rows.select(*KEYS)
        wide.write.parquet(f"{path}/set={sets:05d}")
        spark.createDataFrame([(n,) for n in names], "grp string").coalesce(1).write.parquet(f"{path}/groups/set={sets:05d}")
        sets += 1
        if len(names) < width:
            break
        last = names[-1]
    marker, fs = _file_system(spark, f"{path}/_COMPLETE")
    fs.create(marker, False).close()
    return sets


def wide_groups(spark: SparkSession, path: str) -> DataFrame:
    """(set, grp) of a complete export."""
    marker, fs = _file_system(spark, f"{path}/_COMPLETE")
    if not fs.exists(marker):
        raise FileNotFoundError(f"no complete export at {path}")
    return spark.read.schema("grp string, set int").option("basePath", f"{path}/groups").parquet(f"{path}/groups")


def _sets(spark: SparkSession, path: str) -> list[DataFrame]:
    wide_groups(spark, path)
    root, fs = _file_system(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("set="))
    return [spark.read.parquet(f"{path}/{n}") for n in names]


def read_wide(spark: SparkSession, path: str, groups=None) -> DataFrame:
    """The columns of ``groups`` (by default all) side by side; only the sets that hold them are read.

    A point that a group lacks is NULL.  An unknown group raises."""
    if groups is None:
        parts = _sets(spark, path)
    else:
        held = wide_groups(spark, path).filter(F.col("grp").isin(list(groups))).collect()
        if unknown := sorted(set(groups) - {r["grp"] for r in held}):
            raise KeyError(", ".join(unknown))
        per_set: dict[int, list[str]] = {}
        for r in held:
            per_set.setdefault(r["set"], []).append(r["grp"])
        parts = [spark.read.parquet(f"{path}/set={n:05d}").select(*KEYS, *(f"`{g}`" for g in sorted(gs)))
                 for n, gs in sorted(per_set.items())]
    return reduce(lambda a, b: a.join(b, list(KEYS), "full"), parts)


def read_long(spark: SparkSession, path: str) -> DataFrame:
    """D7 the export as rows (ship_date, grp, timeline, survival_rate), each set unpivoted by itself."""
    out = []
    for part in _sets(spark, path):
        names = [c for c in part.columns if c not in KEYS]
        if names:
            out.append(part.unpivot(list(KEYS), [F.col(f"`{c}`") for c in names], "grp", "survival_rate"))
        else:
            out.append(part.select(*KEYS, F.lit(None).cast("string").alias("grp"), F.lit(None).cast("double").alias("survival_rate")))
    rows = reduce(DataFrame.unionByName, out)
    return rows.filter(F.col("survival_rate").isNotNull()).select("ship_date", "grp", "timeline", "survival_rate")
