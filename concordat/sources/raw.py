"""Raw all-text tables, opened by schema and table name."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.sources.tables import read_if_exists


def table_key(schema: str, table: str) -> str:
    return f"{schema}.{table}"


#: Of each table, the columns that are wanted, in the order of the result; None where it has none.
Wanted = Mapping[str, Sequence[str | None]]


class RawTables(Protocol):
    def headers(self, keys: Sequence[str]) -> dict[str, T.StructType]:
        """The columns of those of the tables that exist."""

    def open(self, keys: Sequence[str]) -> list[DataFrame]:
        """Frames that together hold the given tables, each with an ``import_table`` column.

        Tables in one frame have the same columns.
        """

    def columns(self, wanted: Wanted, types: Sequence[T.DataType]) -> DataFrame:
        """The wanted columns of all tables as ``c0``, ``c1``, ..., of the given types, and ``import_table``."""

    def dictionary(self, schema: str, table: str) -> DataFrame: ...


def _stacked(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by position as a balanced tree."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [reduce(DataFrame.union, frames[i : i + 2]) for i in range(0, len(frames), 2)]
    return frames[0]


class FrameTables:
    """Tables given as frames, such as temporary views or catalogued tables."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self.frames = dict(frames)

    def headers(self, keys: Sequence[str]) -> dict[str, T.StructType]:
        return {k: self.frames[k].schema for k in keys if k in self.frames}

    def open(self, keys: Sequence[str]) -> list[DataFrame]:
        return [self.frames[k].withColumn("import_table", F.lit(k)) for k in keys if k in self.frames]

    def columns(self, wanted: Wanted, types: Sequence[T.DataType]) -> DataFrame:
        def chosen(key: str, names: Sequence[str | None]) -> DataFrame:
            raw = self.frames[key]
            place = {f.name: i for i, f in reversed(list(enumerate(raw.schema)))}
            values = [F.lit(None).cast(t) if n is None else F.col(f"r{place[n]}") for n, t in zip(names, types, strict=True)]
            return raw.toDF(*[f"r{i}" for i in range(len(raw.columns))]).select(
                *[v.alias(f"c{i}") for i, v in enumerate(values)], F.lit(key).alias("import_table"))

        return _stacked(chosen(k, names) for k, names in wanted.items())

    def dictionary(self, schema: str, table: str) -> DataFrame:
        return self.frames[table_key(schema, table)]


class ParquetTables:
    """Tables stored as ``<root>/<schema>/<table>``, and their headers in one small table beside them.

    Tables stored by ``write``, or noted by ``note``, are opened without a look at their files; those that are not noted
    cost a look each. A table rewritten with other columns has to be noted again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, key: str) -> str:
        return f"{self.root}/{key.replace('.', '/', 1)}"

    def write(self, key: str, frame: DataFrame) -> None:
        frame.write.mode("overwrite").parquet(self._path(key))
        self.note({key: frame.schema})

    def note(self, headers: Mapping[str, T.StructType]) -> None:
        """Keep the columns of tables that were stored; what was noted last of a table counts."""
        rows = [(key, schema.json()) for key, schema in headers.items()]
        if rows:
            stamped = self.spark.createDataFrame(rows, "key string, header string").withColumn("noted", F.current_timestamp())
            stamped.coalesce(1).write.mode("append").parquet(f"{self.root}/_headers")

    def headers(self, keys: Sequence[str]) -> dict[str, T.StructType]:
        noted = read_if_exists(self.spark, f"{self.root}/_headers")
        found = {}
        if noted is not None:
            latest = noted.filter(F.col("key").isin(list(keys))).groupBy("key").agg(F.max_by("header", "noted").alias("header"))
            found = {r["key"]: T.StructType.fromJson(json.loads(r["header"])) for r in latest.collect()}
        return {k: found.get(k) or self.spark.read.parquet(self._path(k)).schema for k in keys}

    def _scan(self, keys: Iterable[str], schema: T.StructType) -> DataFrame:
        # The two folders above a file, cut off without a pattern, which every row would try at each place of a long path.
        # Paths of files come percent-encoded, and a plus in them stands for itself.
        folders = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -3), "/", 2)
        table = F.replace(F.url_decode(F.replace(folders, F.lit("+"), F.lit("%2B"))), F.lit("/"), F.lit("."))
        return self.spark.read.schema(schema).parquet(*map(self._path, keys)).withColumn("import_table", table)

    def open(self, keys: Sequence[str]) -> list[DataFrame]:
        alike: dict[str, list[str]] = defaultdict(list)
        headers = self.headers(keys)
        for key in keys:
            alike[headers[key].json()].append(key)
        return [self._scan(some, headers[some[0]]) for some in alike.values()]

    def columns(self, wanted: Wanted, types: Sequence[T.DataType]) -> DataFrame:
        """One scan of all tables, unless they hold a column under different types.

        Which column a table means is joined to its rows; a column that all mean alike is taken as it is.
        """
        scans: list[tuple[dict[str, T.StructField], dict[str, Sequence[str | None]]]] = []
        for key, names in wanted.items():
            # Spark tells columns apart by more than case only if it is asked to.
            own = {n.lower(): T.StructField(n, t) for n, t in zip(names, types, strict=True) if n is not None}
            for fields, members in scans:
                if all(fields.get(n, f).dataType == f.dataType for n, f in own.items()):
                    break
            else:
                fields, members = {}, {}
                scans.append((fields, members))
            for n, f in own.items():
                fields.setdefault(n, f)
            members[key] = names
        return _stacked(self._chosen(fields, members, types) for fields, members in scans)

    def _chosen(self, fields: dict[str, T.StructField], members: Wanted, types: Sequence[T.DataType]) -> DataFrame:
        scan = self._scan(members, T.StructType(list(fields.values())))
        means = [{names[i] and names[i].lower() for names in members.values()} for i in range(len(types))]
        unlike = [i for i, m in enumerate(means) if len(m) > 1]
        if unlike:
            choice = T.StructType([T.StructField("__key", T.StringType()), *[T.StructField(f"__s{i}", T.StringType()) for i in unlike]])
            rows = [(k, *[names[i] and names[i].lower() for i in unlike]) for k, names in members.items()]
            scan = scan.join(F.broadcast(self.spark.createDataFrame(rows, choice)), F.col("import_table") == F.col("__key"), "left")
        values = []
        for i, (meant, kind) in enumerate(zip(means, types, strict=True)):
            named = sorted(m for m in meant if m is not None)
            value = F.col(f"`{fields[named[0]].name}`") if named else F.lit(None).cast(kind)
            if i in unlike:
                value = F.lit(None).cast(kind)
                for n in named:
                    value = F.when(F.col(f"__s{i}") == n, F.col(f"`{fields[n].name}`")).otherwise(value)
            values.append(value.alias(f"c{i}"))
        return scan.select(*values, "import_table")

    def dictionary(self, schema: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self._path(table_key(schema, table)))
