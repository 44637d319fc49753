"""Pipeline stages: (spark, docs, sf_dir) -> DataFrame, one operator each.

All but the last return the columns of ``docs`` as they came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.bpe import encode_decode
from pricelens.llm.common import held_out, table, written
from pricelens.llm.decontamination import contaminated
from pricelens.llm.jaccard import jaccard_components
from pricelens.llm.labelled import label_rows
from pricelens.llm.line_dedup import line_dedup
from pricelens.llm.quality import fit_quality, quality_score

REJECT_BELOW = 0.5
ROW = "__document"  # a key made for a stage; not a column of documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier low than high in quality go.

    Every row is judged by its own text, whatever its id; null and empty texts
    by the classifier's score of an empty text.  An empty table stays empty."""
    labels = label_rows(table(spark, sf_dir, "labels", "doc_id", "quality"), "quality",
                        ~held_out(F.col("doc_id"), 4, 2))
    model = fit_quality(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
    return docs.filter(quality_score(spark, model)(F.col("text").cast("string")) >= REJECT_BELOW)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents of which nothing
    is left.  ``n_chars`` follows the text where there is such a column.

    Null and empty texts have no lines to remove and stay; rows that repeat an
    id are texts of their own; rows without an id take part."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = line_dedup(docs, keep=rest).filter(~((F.col("n_removed") > 0) & (F.trim(F.translate("text", "\n", " ")) == "")))
    kind = dict(docs.dtypes).get("n_chars")
    n_chars = F.coalesce(F.length("text").cast(kind), F.col("n_chars")) if kind else None
    return out.select(*[n_chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays:
    the one with the smallest id (then the smallest digest of its text).

    A document is an id with a text: rows that repeat both are one, rows of one
    id with different texts are judged each by its own.  Documents without
    words stay, and so do all rows without an id."""
    found = written(jaccard_components(docs).filter("doc_id is not null").select("doc_id", "text_md5", "group"))
    first = (found.filter("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "text_md5")).alias("k"))
             .select("k.doc_id", "k.text_md5"))
    kept = written(first.unionByName(found.filter("group is null").drop("group")).distinct())
    keyed = docs.withColumn(ROW, F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))))
    stay = (keyed.join(kept.withColumnRenamed("text_md5", ROW), ["doc_id", ROW], "left_semi")
            .dropDuplicates(["doc_id", ROW]))
    return stay.select(*docs.columns).unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    A document is an id, null or not, with a text; other rows of the id stay.
    Null and empty texts hold nothing and stay; repeated rows go or stay
    together."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn(ROW, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                             F.md5(text.cast("binary"))))
    found = contaminated(keyed, table(spark, sf_dir, "benchmark", "item_id", "text"), id_col=ROW)
    gone = written(found.select(F.col("doc_id").alias(ROW)).distinct())
    return keyed.join(gone, ROW, "left_anti").select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, decoded text; one row for each row,
    null texts as empty ones (no ids)."""
    import public_tokenizers
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
