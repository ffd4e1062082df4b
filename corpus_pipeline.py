"""The corpus pipeline: quality, exact and near duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept.  All but the last return
documents with the columns they came with.  Decisions name a row by a hash of its id and text, so rows with a null id
are decided like others and the texts of a repeated id one by one; a null id is larger than any other for "smallest".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.llm.common import stage, table
from hazardline.llm.decontaminate import contaminated
from hazardline.llm.exact_dedup import exact_dedup
from hazardline.llm.near_dedup import near_dedup
from hazardline.llm.packing import pack
from hazardline.llm.quality import fit, without_rejected
from hazardline.llm.queries import tokenizer_path


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with the name of each row."""
    return docs.withColumn("_row", _name(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))


def _name(sha: Column) -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.isnull("doc_id"), sha)


def _without(named: DataFrame, dropped: DataFrame) -> DataFrame:
    """Named rows without those of ``dropped``, by the same shuffled join at every size."""
    gone = stage(dropped.select("_row").distinct(), "dropped").hint("shuffle_merge")
    return named.join(gone, "_row", "left_anti").select(*named.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.  It learns from the labelled rows among them."""
    return without_rejected(docs, fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id; of rows with that id and text one, by a hash of the row."""
    left = _without(_named(docs), exact_dedup(docs).where("NOT kept").withColumn("_row", _name(F.col("text_sha256"))))
    again = stage(left.groupBy("_row").count().where("count > 1").select("_row"), "repeated-rows")
    row = F.struct(*docs.columns)
    once = left.join(again, "_row").groupBy("_row").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("x")).select("x.*")
    return left.join(again, "_row", "left_anti").select(*docs.columns).unionByName(once)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more) the smallest id."""
    named = _named(docs)
    found = near_dedup(named, k=5, num=80, den=100, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = named.select(F.col("doc_id").cast("long").alias("doc_id"), "_row").distinct()
    found = stage(found.join(ids, "_row"), "near-rows")
    kept = found.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "_row")).alias("x")).select("x._row")
    return _without(named, found.join(kept, "_row", "left_anti")).drop("_row")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    named = _named(docs)
    hits = contaminated(named, table(spark, sf_dir, "benchmark"), id_col="_row")
    return _without(named, hits.select(F.col("doc_id").alias("_row"))).drop("_row")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", benchmark),
          ("packing", packing)]

#: Classifier, shingle sets and tokenizer cannot be written in SQL; tests hold the rows that
#: run() packs against a plain version of the stages after the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
