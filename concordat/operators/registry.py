"""Reports over the import registry, and tables split per data owner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.names import Names

STATUSES = ("success", "skipped", "error")


def import_status_metrics(registry: DataFrame) -> DataFrame:
    """The registry with one 0/1 column per status."""
    return registry.withColumns({s: F.when(F.col("status") == s, 1).otherwise(0) for s in STATUSES})


def data_owners(registry: DataFrame, use_case: str, names: Names = Names()) -> DataFrame:
    return (
        registry.filter(F.col(names.use_case) == use_case)
        .groupBy("data_owner_id")
        .agg(F.min("org_name").alias("data_owner_label"), F.count(F.lit(1)).alias("import_count"))
    )


def owner_view(df: DataFrame, owner: str) -> DataFrame:
    """Rows of one owner. On a table split by ``split_by_owner`` only that owner's files are read."""
    return df.filter(F.col("data_owner_id") == owner)


def split_by_owner(df: DataFrame, path: str, owner: str = "data_owner_id", mode: str = "overwrite") -> None:
    """Write one table partitioned by owner, in place of one view per owner.

    Rebalancing first keeps tasks from each writing a file for every owner, and splits a large one.
    """
    df.hint("rebalance", owner).write.mode(mode).partitionBy(owner).parquet(path)
