"""One query for each operator of this package, and the corpus pipeline.

Each query reads whole tables under ``sf_dir`` by Spark's readers alone and fits
an operator's own columns to the columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scanloom.llm import embedding_search, jpeg, lexical_search, main_text, mixing, ngram_join, packing, pii, secrets, sql, substring_dedup, token_store, toxicity, whitening
from scanloom.llm.common import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("source", "tie")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), ngram_join.Similarity(n=3, num=90, den=100))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_search.search(table(spark, sf_dir, "embeddings"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_tokens(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op10_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.media(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # At the repository's top, and built on this package.
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_main_text": op2_main_text,
        "op3_toxicity": op3_toxicity,
        "op4_pii": op4_pii,
        "op5_pack": op5_pack,
        "op6_mixing": op6_mixing,
        "op7_search": op7_search,
        "op8_token_store": op8_token_store,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_jpeg": op10_jpeg,
        "op11_whitening": op11_whitening,
        "op12_secrets": op12_secrets,
        "op13_lexical_search": op13_lexical_search,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the other ones are tested by other means."""
    return {
        "op1_ngram_join": sql.NGRAM_JOIN,
        "op6_mixing": sql.mixing(mixing.FILLS),
        "op7_search": sql.EMBEDDING_SEARCH,
        "op9_substring_dedup": sql.SUBSTRING_DEDUP,
        "op13_lexical_search": sql.LEXICAL_SEARCH,
    }
