"""Corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

1. quality: documents that fail the quality rules go; 2. near_copies: of documents that are alike (five-word shingles,
Jaccard similarity 0.8 or more, also over several steps) the one with the least id stays; 3. decontamination: documents
that share a window with a benchmark item go; 4. privacy: personal data and secrets are replaced by their kinds;
5. packing: what is left is cut and packed into sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giniflow.llm import jaccard, packing, pii, quality_rules, winnow
from giniflow.llm.common import read_table, stored

#: Of the near-copy stage.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rule and the compression bands; null and empty texts go."""
    return quality_rules.keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of alike documents, the one with the least id."""
    return jaccard.drop_near_copies(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a hit in ``benchmark``."""
    return winnow.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts redacted; ``n_chars`` follows the text."""
    out = docs.withColumn("text", pii.redact(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontamination", decontamination),
          ("privacy", privacy), ("packing", pack)]

#: Compression ratios, redaction and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
