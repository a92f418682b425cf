"""Storing tables as files: plain writes, and tables of which groups of rows are replaced."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators.joins import sized

_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, name: str, if_exists: str = "replace", path: str | None = None) -> None:
    """Write a named table, or plain files when ``path`` is given, replacing it by default."""
    writer = df.write.mode(_MODES[if_exists])
    if path is None:
        writer.saveAsTable(name)
    else:
        writer.parquet(f"{path.rstrip('/')}/{name}")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the cluster shares; a local one only where a local session has none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.gettempdir()
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


_BUCKET, _VALUE, _LIVE = "__bucket_of_", "__value_of_", "__live"


class GroupedTable:
    """Plain Parquet in which all rows of a key lie in one folder, so that replacing them leaves the others alone.

    Rows are dealt to folders by a hash of their key, in as many buckets as ``buckets`` or else the session's shuffle
    partitions say when the table is first written; the folders' name keeps the number. With ``by_value`` a key has its own
    folder, and replacing it reads nothing. Rows with a NULL in their key are in bucket -1 and belong to no group.

    Folders are overwritten dynamically: Spark writes the new files beside the old ones and swaps folder by folder at the
    end. ``<path>/marks`` gets the greatest stamp of a run once all are swapped, so a run that failed is repeated from the
    same mark, and replaces the same groups. Readers may meet some folders swapped and others not. One run at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], by_value: bool = False, buckets: int | None = None):
        self.spark, self.path, self.keys, self.by_value = spark, path.rstrip("/"), list(keys), by_value
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _raw(self) -> DataFrame | None:
        return read_if_exists(self.spark, f"{self.path}/data")

    def _plain(self, raw: DataFrame) -> DataFrame:
        hidden = (_BUCKET, _VALUE, _LIVE)
        return raw.filter(_LIVE).select(*[f"`{c}`" for c in raw.columns if not c.startswith(hidden)])

    def read(self) -> DataFrame | None:
        raw = self._raw()
        return None if raw is None else self._plain(raw)

    def group(self, *values) -> DataFrame | None:
        """The rows of one key; only its folder is read."""
        raw = self._raw()
        if raw is None:
            return None
        own = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(self.keys, values, strict=True)])
        for name, value in self._folders(raw, [F.lit(v) for v in values]).items():
            own = own & (F.col(name) == value)
        return self._plain(raw.filter(own))

    def mark(self):
        """The greatest stamp of the last finished run."""
        marks = read_if_exists(self.spark, f"{self.path}/marks")
        return None if marks is None else marks.agg(F.max_by("mark", "noted")).first()[0]

    def _note(self, mark) -> None:
        row = self.spark.createDataFrame([(mark,)], "mark timestamp_ntz").withColumn("noted", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/marks")

    def _folders(self, raw: DataFrame | None, keys: Sequence[Column] | None = None) -> dict[str, Column]:
        """The columns that lay rows out. Keys count as text, so that they may come as another type of number."""
        texts = [k.cast("string") for k in keys or [F.col(f"`{k}`") for k in self.keys]]
        if self.by_value:
            return {f"{_VALUE}{i}": t for i, t in enumerate(texts)}
        name = next((c for c in raw.columns if c.startswith(_BUCKET)), None) if raw is not None else None
        count = int(name.removeprefix(_BUCKET)) if name else self.buckets
        known = reduce(lambda a, b: a & b, [t.isNotNull() for t in texts])
        return {f"{_BUCKET}{count}": F.when(known, F.pmod(F.xxhash64(*texts), F.lit(count))).otherwise(-1).cast("int")}

    def _write(self, laid: DataFrame, folders: Sequence[str], mode: str, overwrite: str = "dynamic") -> None:
        # Rebalancing makes few files per folder and splits a very large one among tasks.
        writer = laid.hint("rebalance", *folders).write.mode(mode).option("partitionOverwriteMode", overwrite)
        writer.partitionBy(*folders).parquet(f"{self.path}/data")

    def store(self, df: DataFrame, stamp: str | None = None) -> None:
        """Write the table anew."""
        folders = self._folders(None)
        laid = df.withColumns({**folders, _LIVE: F.lit(True)})
        # A row that is not live keeps the columns of a table without rows.
        schema = ", ".join([f"{_LIVE} boolean", *[f"{n} {'string' if self.by_value else 'int'}" for n in folders]])
        keeper = self.spark.createDataFrame([(False, *[None if self.by_value else -1] * len(folders))], schema)
        self._write(laid.unionByName(keeper, allowMissingColumns=True), list(folders), "overwrite", "static")
        if stamp is not None:
            self._note(self.read().agg(F.max(stamp).cast("timestamp_ntz")).first()[0])

    def replace(self, batch: DataFrame, stamp: str | None = None, replaced: DataFrame | None = None, unfinished: DataFrame | None = None) -> None:
        """Put the batch in place of all rows that have its keys, or those of ``replaced``, which then has to hold them all.

        Only folders of these keys are read and written. Rows with a NULL key are added, save those that a failed run left
        behind (``unfinished``).
        """
        raw = self._raw()
        folders = self._folders(raw)
        names = list(folders)
        known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in self.keys])
        live = batch.withColumns({**folders, _LIVE: F.lit(True)})
        unknown = batch.filter(~known)
        if unfinished is not None:
            unknown = unknown.exceptAll(unfinished.filter(~known).select(*[f"`{c}`" for c in batch.columns]))
        # These come first: what is stored is read as it was listed. limit(1) stops at the first row found.
        if unknown.limit(1).count():
            self._write(unknown.withColumns({**folders, _LIVE: F.lit(True)}), names, "append")
        greatest = F.max(stamp if stamp else F.lit(None)).cast("timestamp_ntz").alias("mark")
        new = live.filter(known)
        if self.by_value:
            mark = batch.agg(greatest).first()["mark"]
        else:
            (bucket,) = names
            touching = live if replaced is None else replaced.withColumns(folders)
            facts = touching.groupBy(bucket).agg(greatest if replaced is None else F.lit(None).alias("mark")).collect()
            mark = max((r["mark"] for r in facts if r["mark"] is not None), default=None)
            touched = sorted(r[bucket] for r in facts if r[bucket] != -1)
            keys = sized((batch if replaced is None else replaced).select(*self.keys).filter(known).distinct())
            kept = raw.filter(F.col(bucket).isin(touched) & F.col(_LIVE)).join(keys, self.keys, "left_anti").select(*[f"`{c}`" for c in raw.columns])
            # A folder that loses its last row has to be written too.
            keepers = self.spark.createDataFrame([(False, b) for b in touched], f"{_LIVE} boolean, {bucket} int")
            new = kept.unionByName(new).unionByName(keepers, allowMissingColumns=True)
        if self.by_value or touched:
            self._write(new, names, "overwrite")
        if stamp is not None and mark is not None:
            self._note(max(mark, self.mark() or mark))
