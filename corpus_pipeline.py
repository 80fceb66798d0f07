"""The corpus pipeline: quality classifier, near-dedup, secret scans, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept and returns a DataFrame; all but
the last return the columns of documents. Nulls, repeated rows and clashing columns are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from idloom.llm import packing, quality, secrets, simhash
from idloom.llm.queries import tokenizer_path
from idloom.plans.storage import materialize

#: Near-duplicates are found on shingles of five words.
SHINGLE = 5
#: Jaccard similarity of two documents' shingles from which on they are near-duplicates, besides those within SimHash's bits.
SIMILARITY = 0.8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the least doc_id, of each group of near-duplicates."""
    return simhash.keep_first(docs, SHINGLE, similarity=SIMILARITY)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; n_chars follows the new text."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Scores, SimHash bits and token ids can't be had in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents on, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
