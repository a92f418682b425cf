"""Keep the latest row per key from a stream of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from concordat.operators.catalog import latest_by_key
from concordat.sources.tables import read_if_exists


def stream_latest_by_key(
    changes: DataFrame, path: str, keys: str | Sequence[str], order: str | Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Take in all changes that have landed and stop.

    Each micro-batch is reduced to the latest row per key and stored under its own number, so a
    batch replayed after a failure replaces itself. Taking the latest is the same in any order
    and grouping, hence ``read_latest`` equals the batch operator over all changes, and no batch
    ever rewrites earlier ones.
    """
    root = path.rstrip("/")

    def store(batch: DataFrame, number: int) -> None:
        latest_by_key(batch, keys, order).write.mode("overwrite").parquet(f"{root}/batch={number}")

    return (
        changes.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(
    spark: SparkSession, path: str, keys: str | Sequence[str], order: str | Sequence[str]
) -> DataFrame:
    """Current row per key over the compacted base and the batches stored since."""
    root = path.rstrip("/")
    stored = _stored(spark, root)
    if stored is None:
        raise ValueError(f"nothing stored at {root}")
    return latest_by_key(stored.drop("batch"), keys, order)


def compact(spark: SparkSession, path: str, keys: str | Sequence[str], order: str | Sequence[str]) -> None:
    """Fold the stored batches into a base, which later reads take instead of them."""
    root = path.rstrip("/")
    stored = _stored(spark, root)
    last = stored.agg(F.max("batch")).first()[0]
    latest_by_key(stored.drop("batch"), keys, order).write.mode("overwrite").parquet(f"{root}/_base/upto={last}")
    done = spark.createDataFrame([(int(last),)], "upto long")
    done.coalesce(1).write.mode("append").parquet(f"{root}/_compactions")


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    batches = read_if_exists(spark, root)
    done = read_if_exists(spark, f"{root}/_compactions")
    if done is None or batches is None:
        return batches
    upto = done.agg(F.max("upto")).first()[0]
    base = spark.read.parquet(f"{root}/_base/upto={upto}").withColumn("batch", F.lit(upto))
    return base.unionByName(batches.filter(F.col("batch") > upto).withColumn("batch", F.col("batch").cast("long")))
