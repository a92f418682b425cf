"""Helpers of the text operators: scratch tables, vocabulary files and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A vocabulary file holds at most some hundred thousand entries; larger files are refused, not broadcast.
VOCAB_FILE_LIMIT = 64 << 20
#: Spark's setting that removes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_working: ContextVar[list[str] | None] = ContextVar("working", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for a working table, under the folder all executors share.

    Only a local session without a checkpoint folder gets a temporary one; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="concordat-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def working(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end, save those stored with keep, and shuffle files after each execution.

    All that leaves the block has to be stored with keep: it reads no working table then. A stage that is repeated after
    a lost executor finds its input, as the block ends only when what it gives is written.
    """
    paths: list[str] = []
    before, token = spark.conf.get(CLEANUP, "false"), _working.set(paths)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        _working.reset(token)
        spark.conf.set(CLEANUP, before)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(frame: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows of frame, written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = scratch(spark, name)
    if not keep and (paths := _working.get()) is not None:
        paths.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The content of a tokenizer file, read on the driver and sent to the executors; its size is checked."""
    if (size := os.path.getsize(path)) > VOCAB_FILE_LIMIT:
        raise ValueError(f"{path} has {size} bytes; a vocabulary has at most {VOCAB_FILE_LIMIT}")
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def held_out(id_col: str, modulus: int, remainder: int):
    """True for documents whose crc32 of the id's decimal text leaves the remainder; false for ids that are null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of links(a, b): the least node that it reaches.

    Alternates large-star and small-star steps, which keep each node's rows near its degree, and stops when no label
    moves. A star's hub is never gathered: minima are pre-aggregated in the map tasks and joined back by key.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        edges = stored(small, name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches that are sorted by them; memory holds one run and one batch."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        marks = np.stack([held.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy() for c in keys], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield held.slice(a, b - a)
        held = held.slice(cuts[-1])
    if held is not None:
        yield held
