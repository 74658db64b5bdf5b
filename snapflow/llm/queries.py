"""Registered queries of the operators: whole tables, production parameters, digest columns.

Every callable takes ``(spark, sf_dir)``.  ``SQL`` holds DuckDB SQL where SQL expresses the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapflow.llm import (bottom_k, contour_whitening, covering_simhash, hilbert, host_words, line_dedup, line_rules, pair_bitmaps,
                          pairwise_quality, residual_packing, sql, stable_search, suffix_pieces, token_matrix)
from snapflow.llm.common import read_table

DIMENSIONS = [hilbert.Dimension("source"), hilbert.Dimension("lang"),
              hilbert.Dimension("n_chars", numeric=True)]

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_dedup.line_report(read_table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = pairwise_quality.train(docs, read_table(spark, sf_dir, "labels"))
    return pairwise_quality.scored(docs, model)


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(read_table(spark, sf_dir, "documents"), DIMENSIONS)


def op4_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.edit_likeness(read_table(spark, sf_dir, "documents"))


def op6_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrix.packed_matrix(read_table(spark, sf_dir, "documents"))


def op7_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residual_packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op8_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_words.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(read_table(spark, sf_dir, "documents")).drop("kept_chars")


def op10_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_pieces.encoded(read_table(spark, sf_dir, "documents"))


def op11_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contour_whitening.whitening_report(read_table(spark, sf_dir, "embeddings")).drop("deviation_exact")


def op12_stable_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_search.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op13_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bitmaps.align(read_table(spark, sf_dir, "documents")).scored().drop("groups")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_pairwise_quality, op3_hilbert_shards, op4_covering_simhash, op5_bottom_k,
    op6_token_matrix, op7_residual_packing, op8_host_words, op9_line_rules, op10_suffix_pieces,
    op11_contour_whitening, op12_stable_search, op13_pair_bitmaps)}
SQL = {"op1_line_dedup": sql.LINE_DEDUP, "op9_line_rules": sql.line_rules_sql()}
