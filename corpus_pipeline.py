"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the caller writes it as Parquet
and reads it again as the next one's ``docs``.  All but the last return the columns of ``documents``.
The classifier decides by learnt weights, and SQL has no fingerprints, so the whole has no
``ORACLE_SQL``.  Tests hold every stage and the whole against plain Python, whole row sets, on a
small corpus with rows that meet each stage's rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snapflow.llm import covering_simhash, line_dedup, line_rules, pairwise_quality, residual_packing
from snapflow.llm.common import materialize, prepare, read_table


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has shortened."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failing lines.  Null text: rejected.
    Phrases of page furniture count as whole words here: 'design in' holds no 'sign in'."""
    prepare(spark)
    return _measured(line_rules.keep_clean(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold.  The model learns from the labelled documents
    of ``sf_dir`` as they came: behind the rules hardly a bad one is left to learn from."""
    prepare(spark)
    model = pairwise_quality.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return pairwise_quality.keep_predicted(docs, model)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the long lines that five or more share (the largest id keeps them)."""
    prepare(spark)
    return _measured(line_dedup.drop_repeated_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: the one with the smallest id (null ids last), among rows of
    that id the one with the least text digest, of equal rows any one."""
    prepare(spark)
    by = ["__none", "__id", "__digest"]

    def keys(doc_id: Column, digest: Column) -> list[Column]:
        return [doc_id.isNull().alias("__none"), F.coalesce(doc_id, F.lit(0)).alias("__id"), digest.alias("__digest")]

    groups = covering_simhash.grouped(docs)
    stay = groups.groupBy("root").agg(F.min(F.struct(*keys(F.col("doc_id"), F.col("digest")))).alias("m")).select("m.*")
    # id and digest name one group: equal texts have one root
    rows = docs.select("*", *keys(F.col("doc_id").cast("long"), covering_simhash.text_digest(F.col("text"))))
    return (rows.withColumn("__row", F.row_number().over(Window.partitionBy(*by).orderBy("__digest"))).filter("__row = 1")
            .join(stay, by, "left_semi").select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents and their places in sequences of 2048 tokens."""
    prepare(spark)
    return residual_packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("SimHash near-dedup", near_duplicates),
    ("best-fit packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{i + 1}")
    return docs
