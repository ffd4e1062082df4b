"""The queries op1_ .. op13_ and their oracle SQL (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazardline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.quality import fit, quality_scores
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))


@query("op4_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op6_token_output")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.tokenfile import token_output
    return token_output(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op7_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.near_dedup import near_dedup
    return near_dedup(table(spark, sf_dir, "documents"), k=4, num=80, den=100)


@query("op8_repeated_spans")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.repeats import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"), length=200)


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048)


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.decontaminate import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op5_sql() -> str:
    from hazardline.llm.license_scan import oracle
    return oracle()


@query("op5_license_scan", _op5_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.license_scan import license_scan
    return license_scan(table(spark, sf_dir, "documents"))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.pii import pii_spans
    return pii_spans(table(spark, sf_dir, "documents"))


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.language import page_language, text_model
    return page_language(table(spark, sf_dir, "pages"), *text_model(table(spark, sf_dir, "documents")))


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.toxicity import fit_toxicity, toxicity_scores
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.runs import periodic_runs
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


@query("op11_prefix_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hazardline.llm.prefixes import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)
