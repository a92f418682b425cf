"""Records of delimited text whose values hold line breaks, found without reading a file in one task."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOM = "\ufeff"
#: Encodings whose line breaks and quotes are the single bytes of ASCII.
BYTE_ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")


def open_line(sep: str) -> str:
    """Pattern of a line that begins outside quotes and ends inside them.

    Only a quote at the beginning of a value opens it, and two quotes in it are one. What follows
    the closing quote belongs to the value up to the separator. Nothing is tried twice, so the
    time is linear in the line.
    """
    s = re.escape(sep)
    quoted = '"[^"]*+(?:""[^"]*+)*+'
    return f'\\A(?:(?:{quoted}"[^{s}]*+|(?!")[^{s}]*+){s})*+{quoted}\\z'


def _lines(spark: SparkSession, paths: Sequence[str], charset: str) -> DataFrame:
    """``(path, block, at, value)``: the lines of every split (``block``: its first byte) in the order of ``at``."""
    raw = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    value = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    return raw.withColumn("value", F.regexp_replace(value, f"\\A{BOM}", ""))


def _steps(sep: str) -> dict[str, Column]:
    """What a line does to the state (inside quotes or not): ``fixed`` sets it, ``flips`` of 1 turns it, else it stays."""
    outside = F.col("value").rlike(open_line(sep))
    inside = F.concat(F.lit('"'), "value").rlike(open_line(sep))
    return {"fixed": F.when(outside == inside, outside.cast("int")), "flips": (outside & ~inside).cast("int")}


def _after() -> Column:
    return F.coalesce("fixed", (F.col("state") + F.col("flips")) % 2)


def _before(rows: DataFrame, keys: Sequence[str], order: str, entry: Column) -> DataFrame:
    """Adds ``state``, in which a row is entered: the last fixed one, turned by all flips since, or else ``entry`` turned."""
    up_to = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("turned", F.sum("flips").over(up_to))
    fixed = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turned")), ignorenulls=True).over(earlier)
    known = summed.withColumns({"known": fixed, "so_far": F.coalesce(F.sum("flips").over(earlier), F.lit(0))})
    start = F.coalesce("known.fixed", entry)
    return known.withColumn("state", (start + F.col("so_far") - F.coalesce("known.turned", F.lit(0))) % 2).drop("known", "so_far", "turned")


def _entries(lines: DataFrame, sep: str) -> DataFrame:
    """``(path, block, entry)``: the state in which every split begins. Lines without quotes change nothing and go as one row."""
    quote = F.contains("value", F.lit('"'))
    steps = lines.withColumns(_steps(sep)).select("path", "block", F.when(quote, F.col("at")).otherwise(-1).alias("at"), "fixed", "flips")
    quoted = steps.groupBy("path", "block", "at").agg(F.max("fixed").alias("fixed"), F.max("flips").alias("flips"))
    tried = _before(quoted, ["path", "block"], "at", F.lit(0)).withColumn("after", _after())
    ends = tried.groupBy("path", "block").agg(F.max_by("after", "at").alias("end"), F.max(F.col("fixed").isNotNull()).alias("sets"))
    blocks = ends.select(
        "path", "block", F.when(F.col("sets"), F.col("end")).alias("fixed"), F.when(F.col("sets"), 0).otherwise(F.col("end")).alias("flips"))
    return _before(blocks, ["path"], "block", F.lit(0)).select("path", "block", F.col("state").alias("entry"))


def _joined(piece: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["text"]), "\n")


def quoted_records(spark: SparkSession, paths: Sequence[str], sep: str, charset: str = "UTF-8") -> DataFrame:
    """``(record, header)``: the records of files whose values may hold line breaks in quotes.

    Files are split by bytes. Every split is reduced to what it does to the state "inside quotes", a
    running composition over the splits of a file tells the state at each one's beginning, and then
    lines are put together within their split. Only the pieces at the ends of splits, two of each at
    most, meet those of other splits. Line breaks in values become ``\\n``; blank lines are no records;
    ``header`` marks the first record of a file. A quote that is never closed takes the rest of its file.
    """
    lines = _lines(spark, paths, charset)
    entered = lines.withColumns(_steps(sep)).join(_entries(lines, sep), ["path", "block"])
    placed = _before(entered, ["path", "block"], "at", F.col("entry")).withColumn("after", _after())
    outside = F.col("state") == 0
    kept = placed.filter(~(outside & (F.trim("value") == "")))
    number = F.sum(outside.cast("int")).over(Window.partitionBy("path", "block").orderBy("at"))
    pieces = kept.withColumn("no", number).groupBy("path", "block", "no").agg(
        _joined(F.struct("at", F.col("value").alias("text"))).alias("text"), F.max_by("after", "at").alias("open"))
    edge = (F.col("no") == 0) | (F.col("open") == 1)
    in_order = Window.partitionBy("path").orderBy("block", "no")
    owner = F.last(F.when(F.col("no") > 0, F.struct("block", "no")), ignorenulls=True).over(in_order)
    across = pieces.filter(edge).withColumn("owner", owner).groupBy("path", "owner").agg(_joined(F.struct("block", "no", "text")).alias("text"))
    header = lambda block, no: ((F.col(block) == 0) & (F.col(no) == 1)).alias("header")
    return pieces.filter(~edge).select(F.col("text").alias("record"), header("block", "no")).unionByName(
        across.select(F.col("text").alias("record"), header("owner.block", "owner.no")))
