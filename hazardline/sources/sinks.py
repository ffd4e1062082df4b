"""S10-S15 sinks: the types of the stored tables, CSV and parquet export, plain folders.

The jobs store curves and predictions in :class:`hazardline.sources.store.SnapshotTable`, where all ship dates of a
request are replaced in one commit.  :func:`replace_partitions` is for folders that are read as plain
parquet: a dynamic partition overwrite, one date after the other, without a common commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed sink schemas.
SURVIVAL_DDL = ("grp VARCHAR(20) NOT NULL, timeline INT NOT NULL, survival_rate DECIMAL(17,15) NOT NULL, "
                "ship_date DATE NOT NULL")
MEASURE = T.DecimalType(38, 15)
PREDICTION_SCHEMA = T.StructType(
    [T.StructField("checkpoint", T.TimestampType()), T.StructField("facility_id", T.IntegerType()),
     T.StructField("freight_id", T.IntegerType()), T.StructField("alignment_timestamp", T.TimestampType()),
     T.StructField("finalization_timestamp", T.TimestampType())]
    + [T.StructField(c, MEASURE) for c in (
        "predicted_con", "predicted_cor", "predicted_coa", "predicted_orders", "con", "cor", "coa", "orders",
        "delta_con", "adjusted_con", "delta_cor", "adjusted_cor", "delta_coa", "adjusted_coa")]
    + [T.StructField("ship_date", T.DateType(), False)])
SURVIVAL_SCHEMA = T.StructType([
    T.StructField("grp", T.StringType(), False), T.StructField("timeline", T.IntegerType(), False),
    T.StructField("survival_rate", T.DecimalType(17, 15), False), T.StructField("ship_date", T.DateType(), False)])

RATES = T.ArrayType(T.DecimalType(17, 15))
PACKED_SCHEMA = T.StructType([T.StructField("grp", T.StringType(), False), T.StructField("rates", RATES, False),
                              T.StructField("ship_date", T.DateType(), False)])


def require(col: str, cond, message: str):
    """Fail the writing task (not the driver) when a row violates a sink constraint."""
    return F.when(cond, F.col(col)).otherwise(F.raise_error(F.lit(message)))


def survival_rows(curves: DataFrame) -> DataFrame:
    """Curves in the sink's types; NOT NULL and VARCHAR(20) are checked per row (parquet
    tables enforce neither by themselves)."""
    return curves.select(
        require("grp", F.col("grp").isNotNull() & (F.length("grp") <= 20), "survival: bad grp").alias("grp"),
        require("timeline", F.col("timeline").isNotNull(), "survival: NULL timeline").cast("int").alias("timeline"),
        require("survival_rate", F.col("survival_rate").isNotNull(), "survival: NULL rate")
        .cast(T.DecimalType(17, 15)).alias("survival_rate"),
        require("ship_date", F.col("ship_date").isNotNull(), "survival: NULL ship_date").alias("ship_date"),
    )


def packed_rows(packed: DataFrame) -> DataFrame:
    """Packed curves in the sink's types, under the same constraints as :func:`survival_rows`."""
    return packed.select(
        require("grp", F.col("grp").isNotNull() & (F.length("grp") <= 20), "survival: bad grp").alias("grp"),
        require("rates", F.coalesce(F.forall("rates", lambda r: r.isNotNull()), F.lit(False)), "survival: NULL rate")
        .cast(RATES).alias("rates"),
        require("ship_date", F.col("ship_date").isNotNull(), "survival: NULL ship_date").alias("ship_date"),
    )


def prediction_rows(final: DataFrame) -> DataFrame:
    cols = []
    for f in PREDICTION_SCHEMA.fields:
        c = F.col(f.name)
        if f.name == "ship_date":
            c = require("ship_date", c.isNotNull(), "prediction: NULL ship_date")
        cols.append(c.cast(f.dataType).alias(f.name))
    return final.select(*cols)


def create_sink(spark: SparkSession, table: str, ddl: str, location: str) -> None:
    """S10 CREATE TABLE IF NOT EXISTS, typed, partitioned by ship_date."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet "
              f"PARTITIONED BY (ship_date) LOCATION '{location}'")


def replace_partitions(df: DataFrame, path: str, dates=None) -> None:
    """S13 replace the ship dates present in ``df`` (dynamic partition overwrite) and, if the requested
    ``dates`` are given, those of them that got no rows: their old rows go."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ship_date").parquet(path))
    if dates:
        spark = df.sparkSession
        have = {str(r[0]) for r in df.select("ship_date").distinct().collect()}
        jvm = spark._jvm
        for d in sorted({str(x) for x in dates} - have):
            part = jvm.org.apache.hadoop.fs.Path(f"{path}/ship_date={d}")
            part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(part, True)


def insert_replacing(df: DataFrame, table: str) -> None:
    """S13 into a catalog table: columns by name, only the incoming ship dates replaced."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """S14 as a frame: rows of ``incoming`` replace rows of ``existing`` with the same key values
    (``SnapshotTable.upsert`` stores the result)."""
    keys = list(keys)
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming)


def write_csv(df: DataFrame, path: str) -> None:
    """S11 CSV with a header line; NULL written as an empty field."""
    df.write.option("header", True).option("nullValue", "").option("emptyValue", '""').csv(path)


def load_csv_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S12 strict bulk load: header skipped, optional quotes, empty -> NULL, UTF-8,
    columns by position, any malformed row fails the load."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"')
            .option("nullValue", "").option("encoding", "UTF-8").option("mode", "FAILFAST")
            .option("enforceSchema", True).csv(path))


def export_parquet(df: DataFrame, path: str) -> None:
    """S15 parquet files partitioned by ship date."""
    df.write.mode("overwrite").partitionBy("ship_date").parquet(path)
