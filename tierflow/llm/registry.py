"""Queries of the subpackage over whole test tables, and the SQL of those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import (chat, encoding, html_text, language, line_dedup, merkle, near_vectors, neighbours,
                          packing, periodic_runs, shingle_join, suffix_dedup, warc)
from tierflow.llm.common import ship_package, table
from tierflow.session import prepare

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(prepare(spark))
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def tokenizer_path() -> str:
    """The installed tokenizer file; operators take the path as a parameter."""
    return public_tokenizers.path(TOKENIZER)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated_lines(table(spark, sf_dir, "documents"))


@query
def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_derivatives(table(spark, sf_dir, "pages"))


@query
def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.linked_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_texts(table(spark, sf_dir, "documents"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted_languages(table(spark, sf_dir, "documents"))


@query
def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encoding_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(table(spark, sf_dir, "conversations"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_rows(table(spark, sf_dir, "documents"))


SQL["op1_line_dedup"] = line_dedup.SQL
SQL["op13_merkle_manifest"] = merkle.SQL
SQL["op12_suffix_dedup"] = suffix_dedup.SQL
