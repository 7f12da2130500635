"""Corpus pipeline: documents in, packed sequences out, in stages of the text operators.

Each stage is (spark, docs, sf_dir) -> DataFrame; its output is written as Parquet and reread
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skewscope.llm.common import read, save
from skewscope.llm.decontaminate import decontamination_stage
from skewscope.llm.minhash import dedup_stage
from skewscope.llm.packing import packing_stage
from skewscope.llm.pii import pii_stage
from skewscope.llm.quality import quality_stage

STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii_redaction", pii_stage),
    ("bm25_packing", packing_stage),
]

#: Learned models and tokenizers: not expressible in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir))
    return docs
