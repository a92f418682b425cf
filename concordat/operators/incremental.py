"""Incremental materialisation: take what changed, replace whole groups by key."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.operators.joins import sized
from concordat.sources.tables import GroupedTable

EPOCH = datetime.datetime(1970, 1, 1)


def watermark(target: DataFrame | None, ts_col: str = "last_changed") -> datetime.datetime:
    """Greatest stamp in the target, or 1970 when it has none."""
    found = None if target is None else target.agg(F.max(ts_col)).first()[0]
    return EPOCH if found is None else found


def changed_since(
    df: DataFrame, target: DataFrame | None, ts_col: str = "last_changed", inclusive: bool = False
) -> DataFrame:
    """Rows stamped after everything in the target.

    The watermark is read first and compared as a literal, so the filter reaches the scan.
    ``inclusive`` also takes rows that carry the watermark itself, which replacing by key makes safe.
    """
    return since(df, watermark(target, ts_col), ts_col, inclusive)


def since(df: DataFrame, mark, ts_col: str, inclusive: bool = False) -> DataFrame:
    bound = F.lit(mark).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) >= bound if inclusive else F.col(ts_col) > bound)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The target without the groups whose key occurs in the batch, plus the whole batch.

    A key may have many rows on both sides. NULL keys never match. The batch's keys are
    broadcast when they are proven few, and then the target is not shuffled.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    replaced = sized(batch.select(*keys).distinct())
    return target.join(replaced, keys, "left_anti").select(*target.columns).unionByName(batch)


def run_incremental(
    source: DataFrame,
    path: str,
    keys: str | Sequence[str],
    ts_col: str = "last_changed",
    mode: str = "incremental",
    inclusive: bool = False,
    partitioned: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Bring the stored table up to date and return it.

    Rows stamped after the last run replace the groups that have their key. The table is laid out in ``buckets`` by a hash of
    the key, and only those that hold a replaced group are read and written. With ``partitioned`` every key has a folder of
    its own and nothing is read; use it when groups are large and keys are few. ``mode="full"`` writes the table anew.
    """
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    table = GroupedTable(source.sparkSession, path, keys, by_value=partitioned, buckets=buckets)
    current = None if mode == "full" else table.read()
    if current is None:
        table.store(source, ts_col)
        return table.read()
    mark = table.mark() or EPOCH
    # Stored rows past the watermark come from a run that died before it was noted.
    table.replace(since(source, mark, ts_col, inclusive), ts_col, unfinished=since(current, mark, ts_col, inclusive))
    return table.read()
