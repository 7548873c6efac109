"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the stage before kept and hands on Parquet; all but the last keep the
columns of ``documents``. The last gives the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm.common import documents, stage
from tillwise.llm.mixing import mix
from tillwise.llm.packing import packed_digest
from tillwise.llm.privacy import disclosing_terms, sanitise
from tillwise.llm.quality import fit_quality, with_score
from tillwise.llm.simhash import drop_near_duplicates

#: Documents below this probability of being good are rejected.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores below ``LEAST_QUALITY``; a null or empty text
    is scored like any other. Without labels every document scores 0.5 and stays."""
    trees = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_score(docs, trees, "_score").where(f"_score >= {LEAST_QUALITY}").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of smallest doc_id, of each group linked by SimHash fingerprints of
    three-word shingles that differ in at most three bits. Texts without words are copies of each
    other, null and empty ones too; an empty table stays empty."""
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that disclose it; other texts stay as they are, null and
    empty ones too. An empty table stays empty."""
    return sanitise(docs, disclosing_terms(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins documents so that sources come to their target shares. A null or empty text
    weighs nothing; null is a source of its own; an empty table stays empty."""
    return mix(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents (a repeated document gives its pieces repeatedly) in sequences. A null
    or empty text is one piece with the end id alone; an empty table has no pieces."""
    return packed_digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", packing),
]

#: SQL has no trees, XXH64 or tokenizer; tests hold the stages against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
