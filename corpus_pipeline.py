"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
what a stage returns to the shared folder as Parquet and gives it to the next.
All but the last return the columns of ``documents``: doc_id, text, lang, source,
n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.llm import mixing, ngram_join, packing, pii, toxicity
from scanloom.llm.common import WORD, settled, small_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger scores below 0.5, whatever their labels say."""
    small_batches(spark)
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(*COLUMNS), chain, keep=True).filter(F.col("predicted") == 0).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document of the least id.

    Rows without an id or without words stay, and decide on no other row of their
    id. All texts of the kept id stay but for repeated ones, so that no text goes
    that isn't near to a kept one.
    """
    small_batches(spark)
    found = ngram_join.near_duplicates(docs, ngram_join.Similarity(n=5, num=80, den=100))
    # The texts of an id hang together, so one decision holds for all that have words, and another one for those without.
    kept = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id", (F.col("n_shingles") == 0).alias("none")).agg(F.count("*").alias("rows"))
    none = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    out = docs.select(*COLUMNS, none.alias("none")).join(kept, ["doc_id", "none"])
    # Only where an id repeats do its rows have to meet.
    once = out.filter(F.col("rows") == 1).unionByName(out.filter(F.col("rows") > 1).withColumn("h", F.sha2("text", 256)).dropDuplicates(["doc_id", "h"]).drop("h"))
    return once.select(*COLUMNS).unionByName(docs.filter(F.col("doc_id").isNull()).select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every identifier, plain or disguised, replaced by its kind."""
    small_batches(spark)
    out = pii.mask(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times.

    Rows alike in id, text and source share their copies out evenly.
    """
    keys = ("doc_id", "source", "tie")
    taken = mixing.mix_sources(docs).groupBy(*(F.col(c).alias(f"of_{c}") for c in keys)).agg(F.sum("copies").alias("copies"), F.count("*").alias("alike")).filter(F.col("copies") > 0)
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("tie"))
    # The hash also stands in for a null id, so that rows without one don't meet in one place.
    same = [F.coalesce(F.col(f"{p}doc_id"), F.col(f"{p}tie")) for p in ("", "of_")]
    rows = rows.join(taken, (same[0] == same[1]) & F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("tie") == F.col("of_tie")))
    # Rows alike are interchangeable, however many: each takes the whole part of their mean, and one more by a hash of its place.
    share = F.col("copies") / F.col("alike")
    more = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) < (share - F.floor(share)) * F.lit(1 << 20)
    rows = rows.withColumn("copies", F.floor(share) + more.cast("long")).filter(F.col("copies") > 0)
    return rows.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has neither the tagger nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settled(docs, f"stage-{k}")
    return docs
