"""A training-corpus pipeline: five stages of ``playmart.llm``, each written and reread as Parquet.

STAGES: quality rules (4), n-gram Jaccard join (8), suffix-array dedup (5), mixing sources (2),
byte-level BPE (7). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playmart.llm import bpe, jaccard_join, mixing, quality, suffix_dedup
from playmart.llm.common import documents, stored


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One digest row per document that is left (a document taken twice has two rows)."""
    return bpe.encode_digest(docs)


STAGES = [
    ("quality_rules", quality.filter_quality),
    ("ngram_jaccard_join", jaccard_join.dedup_stage),
    ("suffix_array_dedup", suffix_dedup.dedup_stage),
    ("source_mixing", mixing.mix),
    ("byte_level_bpe", tokenise),
]

#: Line labels, components and long repeats are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows stored in the shared folder before the next."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
