"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import written


def label_rows(labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label 0/1) of the rows to learn from; ids whose rows disagree
    and labels other than 0 and 1 are left out."""
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
    return (rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
            .filter("label = top").select("doc_id", "label"))


def hashed_sample(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows with the smallest hash of their id, a fixed choice."""
    return written(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n))
