"""Shared pieces: table access, staged tables, joins that survive one hot key."""

from __future__ import annotations

import ctypes
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.session import scratch_path

#: Keys holding more than 1/HOT_SHARE of all rows are hot; there are at most HOT_SHARE of them.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a lost
    executor repeats no earlier stage, and gives later joins measured sizes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean(run):
    """A function for mapInArrow that gives its freed memory back to the system at the end of a task: workers are used again, and
    what one stage needed should not be held through the next."""
    def of(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return of


def docs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a null text as the empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def join_counted(left: DataFrame, groups: DataFrame, key: str, values: list[str], cnt: str, spread: Column) -> DataFrame:
    """``left`` joined to ``groups`` (a stored table, one row per key, ``cnt`` = rows of ``left`` with it).

    One shuffled join on key and salt.  Rows of a hot key get one of ``salts`` by ``spread``, and its row in
    ``groups`` is repeated once per salt, so that no pair of key and salt has more than about 1/HOT_SHARE of the
    rows.  Only hashes of the hot keys come to the driver: fewer than HOT_SHARE numbers, and fewer than
    HOT_SHARE * HOT_SHARE / 4 repeated rows, whatever the size of the data.
    """
    total, most = groups.agg(F.sum(cnt), F.max(cnt)).first()
    keep = [*left.columns, *values]
    if not total or most * HOT_SHARE <= total:
        return left.join(groups.select(key, *values), key).select(*keep)
    hot = groups.where(F.col(cnt) * HOT_SHARE > F.lit(total)).select(F.xxhash64(key), cnt).collect()
    salts = max(-(-n * HOT_SHARE // total) for _, n in hot)
    is_hot = F.xxhash64(key).isin([h for h, _ in hot])
    left = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0))
    groups = groups.select(key, *values, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(int(salts) - 1)))
                                                   .otherwise(F.array(F.lit(0)))).alias("_salt"))
    return left.join(groups, [key, "_salt"]).select(*keep)
