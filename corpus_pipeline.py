"""From raw documents to token files: toxicity, near copies, benchmark leaks, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  ``run`` writes each stage's result as Parquet in the shared folder
and reads it back as the next stage's documents, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import decontam, mixing, simhash, tokens, toxicity
from panelkit.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts as toxic go."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.scores(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"), labels)
    return scored.where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs within its edit budget go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), inside=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, shard by shard."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; doc_id, start, n_tokens and ids_crc32 read back from them."""
    return tokens.token_files(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_files),
]

#: Model fitting, XXH64 fingerprints and the tokenizer are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
