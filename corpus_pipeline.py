"""The corpus pipeline: quality rules, near-duplicate join, substring dedup, mixing, tokenizing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before it kept; all but the last return the columns of ``documents``.
Null and empty texts fail the quality rules; a null id, language or source is
a value like others; repeated rows go through together and the near-duplicate
stage keeps one of them; an empty table gives no rows in every stage.
``run`` writes each stage as Parquet into the shared checkpoint folder and
reads it back, like the callers of ``STAGES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barspark.llm import mixing, pigeonhole, quality, recompress, sentencepieces
from barspark.llm.common import materialize
from barspark.llm.queries import MODEL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # the later stages (components, rounding, tokenizer) are beyond SQL; see tests/llm


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (similarity 0.75 or more on shingles of five words)."""
    return pigeonhole.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows of 35 words that occur again anywhere."""
    return recompress.apply(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources come to their target weights."""
    return mixing.apply(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = MODEL) -> DataFrame:
    """One row per document and copy: doc_id, n_tokens, ids, whether decoding gives the text again, and whether the
    reference library encodes the text alike."""
    return sentencepieces.encode(docs, model).select("doc_id", "n_tokens", "ids", "round_trip", "parity")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage_{i}")
    return docs
