"""The corpus pipeline: stages over ``documents``, each fed by the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm.common import written
from pricelens.llm.stages import bpe_stage, decontamination_stage, jaccard_stage, line_dedup_stage, quality_stage

STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("bpe encoding", bpe_stage),
]

# the trained classifier and the byte-pair encoder have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the
    shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
