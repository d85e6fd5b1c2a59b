"""Training corpus from raw documents: the stages, and a run over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import language, line_dedup, packing, shingle_join
from tierflow.llm.common import ship_package, stored, table
from tierflow.llm.registry import tokenizer_path
from tierflow.session import prepare


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings of a stage: texts go to Python workers in small batches,
    as four stages' leftovers share an executor's memory."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters or without a main language go.

    The model is learned from the labelled documents that are not held out.
    """
    ready(spark)
    return language.keep_labelled(docs, language.fit(docs))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier run of lines; none goes."""
    ready(spark)
    return line_dedup.renewed_documents(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of similar ones."""
    ready(spark)
    return shingle_join.one_of_each(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces of the kept documents in training sequences."""
    ready(spark)
    return packing.packed_documents(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_languages),
    ("line dedup", remove_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("best-fit packing", pack_documents),
]

# Languages learned from the corpus, shingle components and BPE ids have no DuckDB SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    ship_package(prepare(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
