"""Documents to packed training sequences: language, quality, near copies, repeated passages, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from concordat.llm.jaccard import keep_one
from concordat.llm.langid import keep_languages
from concordat.llm.packing import pack_documents
from concordat.llm.quality import keep_good
from concordat.llm.queries import VOCABULARY
from concordat.llm.shared import stored
from concordat.llm.substring_dedup import drop_repeats

#: Rows that go to Python at a time in stages that hand over whole texts beside much else: about 7 MB of them. Of Spark's
#: own 10,000 rows each task has a buffer of 64 MB outside the heap, and Python another copy.
TEXT_ROWS, ROWS = 2048, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands at most TEXT_ROWS rows to Python at a time; a smaller setting stays."""
    if not 0 < int(spark.conf.get(ROWS)) <= TEXT_ROWS:
        spark.conf.set(ROWS, TEXT_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows: it has to tell the winner from the second by a margin."""
    return keep_languages(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model holds to be good."""
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at 0.8."""
    return keep_one(docs, percent=80, width=5)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words or more that an earlier one holds."""
    small_batches(spark)
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens, with their ids."""
    small_batches(spark)
    return pack_documents(docs, VOCABULARY, capacity=4096, end_id=2, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("quality", quality), ("near_copies", near_copies), ("passages", passages), ("packing", packing),
]
#: SQL cannot express the models of the first two stages; the tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
