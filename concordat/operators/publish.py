"""Publish tables as CSV with a manifest that says what changed."""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import geometry as G
from concordat.operators.catalog import iso
from concordat.sources.tables import read_if_exists
from concordat.types import is_geometry, is_number, is_text, is_timestamp

# Title of what each role publishes, and label of each target.
ROLE_TITLES = {"echange": "Données normalisées", "kpi": "Indicateurs"}
TARGET_LABELS = {"test": "DONNEES D'EXEMPLE", "staging": "DONNEES DE DEVELOPPEMENT"}
# What is open to everyone.
OPEN_ROLE, OPEN_TARGET = "kpi", "exemple"

MANIFEST_KEYS = ("relation", "partition")


def to_csv_frame(df: DataFrame, wkt: bool = False, prefix_regex: str | None = None) -> DataFrame:
    """The table as a CSV can hold it.

    Columns named ``geo*`` that hold a geometry become WKT or GeoJSON, arrays and structs JSON,
    stamps ISO text and anything else text; text and numbers stay.
    """
    columns, names = [], []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if is_geometry(field.dataType):
            c = G.to_wkt(c) if wkt else G.to_geojson(c)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif is_timestamp(field.dataType):
            c = iso(c)
        elif not (is_text(field.dataType) or is_number(field.dataType)):
            c = c.cast("string")
        name = re.sub(prefix_regex, "", field.name) if prefix_regex else field.name
        names.append(name)
        columns.append(c.alias(name))
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns share a published name: {clash}")
    return df.select(*columns)


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Rename columns without the use-case prefix."""
    names = [c.replace(f"{prefix}_", "") for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns collide without the prefix {prefix!r}")
    return df.toDF(*names)


def field_types(schema: T.StructType) -> str:
    """Columns with the types a data store knows, as JSON text."""

    def kind(t: T.DataType) -> str:
        if is_number(t):
            return "numeric"
        if is_timestamp(t):
            return "timestamp"
        return "bool" if isinstance(t, T.BooleanType) else "text"

    return "[" + ",".join(f'{{"id":{json.dumps(f.name, ensure_ascii=False)},"type":"{kind(f.dataType)}"}}' for f in schema) + "]"


def title(role: str, target: str) -> str:
    label = TARGET_LABELS.get(target)
    text = ROLE_TITLES.get(role, role)
    return f"{label} - {text}" if label else text


def is_private(role: str, target: str) -> bool:
    return not (role == OPEN_ROLE or target == OPEN_TARGET)


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def build_manifest(
    frame: DataFrame,
    relation: str,
    by: str | None = None,
    previous: DataFrame | None = None,
    role: str = "echange",
    target: str = "prod",
    checksum: Column | None = None,
    stamp: str | None = None,
) -> DataFrame:
    """One line per partition: rows, checksum, columns, and the action against ``previous``.

    ``create`` is a new partition, ``skip`` an unchanged one, ``update`` one with other content, ``delete`` one
    that is no longer in the table; it has no rows and the columns and name it was published with. A partition that comes
    back is new. When the columns differ from those published, the resource cannot be updated: it is created
    again under a name that starts with ``stamp``.
    """
    # The sum of row hashes does not depend on row order; a decimal keeps it from overflowing.
    total = F.sum((row_hash(frame) if checksum is None else checksum).cast("decimal(38,0)"))
    part = F.lit("all") if by is None else F.coalesce(F.col(f"`{by}`").cast("string"), F.lit(""))
    lines = frame.groupBy(part.alias("partition")).agg(
        F.count(F.lit(1)).alias("rows"), total.cast("string").alias("checksum")
    )
    lines = lines.select(
        F.lit(relation).alias("relation"), "partition", "rows", "checksum",
        F.lit(field_types(frame.schema)).alias("fields"),
        F.lit(title(role, target)).alias("title"),
        F.lit(is_private(role, target)).alias("private"),
    )
    if previous is None:
        return lines.withColumns({"action": F.lit("create"), "resource_name": F.col("relation")})
    before = previous.filter(F.col("action") != "delete").select(
        *MANIFEST_KEYS, F.col("rows").alias("__rows"), F.col("checksum").alias("__checksum"),
        F.col("fields").alias("__fields"), F.col("resource_name").alias("__name"),
    )
    joined = lines.join(before, list(MANIFEST_KEYS), "full")
    gone = F.col("rows").isNull()
    same = (F.col("rows") == F.col("__rows")) & (F.col("checksum") == F.col("__checksum"))
    conflict = F.coalesce(F.col("__fields") != F.col("fields"), F.lit(False))
    action = (
        F.when(gone, "delete").when(F.col("__rows").isNull() | conflict, "create").when(same, "skip").otherwise("update")
    )
    sibling = F.concat_ws("_", F.lit(stamp) if stamp else iso(F.current_timestamp()), "relation")
    return joined.select(
        *MANIFEST_KEYS, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("checksum", F.lit("0")).alias("checksum"),
        F.coalesce("fields", "__fields").alias("fields"), F.lit(title(role, target)).alias("title"),
        F.lit(is_private(role, target)).alias("private"), action.alias("action"),
        # A sibling stays the resource of its partition until the next conflict.
        F.when(conflict, sibling).otherwise(F.coalesce("__name", "relation")).alias("resource_name"),
    )


def _unfinished(previous: DataFrame | None, intent: DataFrame) -> DataFrame:
    """What is published after a run that stopped half-way: partitions it meant to change hold nobody knows what."""
    changed = intent.filter(F.col("action") != "skip").drop("run")
    # No table has fewer than no rows, so such a partition is never skipped.
    unknown = changed.withColumns({"rows": F.lit(-1).cast("long"), "action": F.lit("update")})
    if previous is None:
        return unknown
    return previous.drop("run").join(changed, list(MANIFEST_KEYS), "left_anti").unionByName(unknown)


def _remove(spark: SparkSession, root: str, gone: DataFrame) -> None:
    """Remove the files of partitions that are gone. One row a partition and one path a file reach the driver."""
    folders = [(r[0], r[1]) for r in gone.select("resource_name", "partition").collect()]
    if not folders:
        return
    # Partition values are text as they were written, so "01" stays apart from "1".
    files = spark.read.schema("line string, resource_name string, partition string").csv(root)
    part = F.coalesce("partition", F.lit(""))
    wanted = reduce(or_, [(F.col("resource_name") == name) & (part == value) for name, value in folders])
    for row in files.filter(wanted).select(F.col("_metadata.file_path").alias("path")).distinct().collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.path))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def publish(
    df: DataFrame,
    path: str,
    relation: str,
    by: str | None = None,
    role: str = "echange",
    target: str = "prod",
    wkt: bool = True,
    prefix_regex: str | None = None,
    stamp: str | None = None,
) -> DataFrame:
    """Write the partitions that changed since the last run as CSV, remove those that are gone, and return the manifest.

    What a run means to change is written first, and joins the manifest when all of it is done. The run after one that
    stopped half-way writes all partitions again that the stopped one meant to change. Rows are rebalanced by partition before the write: adaptive execution splits a very large
    owner among many tasks and gathers small ones, so files have an even size.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    frame = to_csv_frame(df, wkt, prefix_regex)
    published_by = re.sub(prefix_regex, "", by) if by and prefix_regex else by
    history = read_if_exists(spark, f"{root}/_manifest/{relation}")
    runs = 0
    previous = None
    if history is not None:
        runs = history.agg(F.max("run")).first()[0] + 1
        previous = history.filter(F.col("run") == runs - 1)
    attempt = 0
    while (intent := read_if_exists(spark, f"{root}/_pending/{relation}/run{runs}-{attempt}")) is not None:
        previous, attempt = _unfinished(previous, intent), attempt + 1
    manifest = build_manifest(frame, relation, published_by, previous, role, target, stamp=stamp)
    # Writing it fixes it: later steps read the same lines without scanning the table again.
    pending = f"{root}/_pending/{relation}/run{runs}-{attempt}"
    manifest.withColumn("run", F.lit(runs)).write.parquet(pending)
    manifest = spark.read.parquet(pending)

    part = "partition"
    key = F.lit("all") if published_by is None else F.coalesce(F.col(f"`{published_by}`").cast("string"), F.lit(""))
    changed = manifest.filter(F.col("action").isin("create", "update")).select(part, "resource_name")
    body = frame.withColumn(part, key).join(changed, part).hint("rebalance", "resource_name", part)
    (
        body.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
        .partitionBy("resource_name", part).csv(root)
    )
    _remove(spark, root, manifest.filter(F.col("action") == "delete"))
    manifest.write.mode("append").parquet(f"{root}/_manifest/{relation}")
    return manifest
