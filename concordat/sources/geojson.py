"""GeoJSON as rows, cut at the boundaries of features where Spark reads the text.

What parts two features is the same all through a file that a program wrote, white space included. It is read off the first
two features and named as the record separator, so a collection is split into byte ranges like any text, be it on one line
or on many. Every piece is parsed by itself and held to account: brackets that do not balance, text that is no JSON, and a
file without a proper head or tail are errors. Where features cannot be told apart that way, a file is parsed as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions import geometry as G

_MARK = '"Feature"'
_FEATURE = "type: string, properties: map<string,string>, geometry: string"
_DOCUMENT = f"array<struct<type: string, features: array<struct<{_FEATURE}>>, properties: map<string,string>, geometry: string>>"
_CORRUPT = "__corrupt"
_STRING = r'"(?:[^"\\]|\\.)*"'
#: Files that are looked into for two features, in the order of their names, and the texts that are taken of each.
_TRIED, _MARKS = 8, 8


class MalformedText(ValueError):
    """What is written in a file is not what the file is called."""


class Boundary(NamedTuple):
    """What parts two features, the beginning of a feature that is part of it, and whether brackets enclose all features."""

    separator: str
    start: str
    enclosed: bool


def _depth(token: str) -> int:
    return {"{": 1, "[": 1, "}": -1, "]": -1}.get(token, 0)


def boundary(head: str, rest: str) -> Boundary | None:
    """The boundary behind the first feature, from the texts before and after the first ``"Feature"``.

    If features begin with their type, the separator reaches as far as its value and cannot be mistaken for the beginning of
    a geometry. Otherwise it ends with the name of their first member.
    """
    token = re.compile(rf"{_STRING}|[{{}}\[\]]")
    enclosing = sum(map(_depth, token.findall(head))) - 1
    depth = 1
    for found in token.finditer(rest):
        depth += _depth(found[0])
        if depth == 0:
            part = re.compile(rf'([\s,\x1e]*){{\s*(?:"type"\s*:\s*{_MARK}|{_STRING})').match(rest, found.end())
            return part and Boundary(part[0], part[0][len(part[1]) :], enclosing > 0)
    return None


def _sniff(spark: SparkSession, paths: Sequence[str]) -> Boundary | None:
    for file in sorted(spark.read.text(paths).inputFiles())[:_TRIED]:
        some = [r[0] for r in spark.read.option("lineSep", _MARK).text(unquote(file)).take(_MARKS)]
        if len(some) > 1 and (found := boundary(some[0], _MARK.join(some[1:]))):
            return found
    return None


def _balance(text: Column) -> Column:
    """Opening less closing brackets outside of strings; the text begins and ends outside of them."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    bare = F.regexp_replace(plain, r'"[^"]*+"', "")
    return F.length(F.translate(bare, "}]", "")) - F.length(F.translate(bare, "{[", ""))


def _features(document: Column, single: bool) -> Column:
    """The features of a document, NULL if it is malformed or anything else is among them."""
    parsed = F.from_json(F.concat(F.lit("["), document, F.lit("]")), _DOCUMENT)
    only = F.when(F.size(parsed) == 1, parsed[0])
    found = only["features"]
    if single:
        own = F.array(F.struct(only["type"].alias("type"), only["properties"].alias("properties"), only["geometry"].alias("geometry")))
        found = F.when(only["type"] == "Feature", own).otherwise(found)
    return F.when(F.forall(found, lambda f: F.coalesce(f["type"] == "Feature", F.lit(False))), found)


def _documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, text, features)`` of whole files."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.ltrim("value", F.lit("﻿")).alias("text"))
    listed = F.col("text").rlike(r"\A\s*\[")
    document = F.when(listed, F.concat(F.lit('{"features":'), "text", F.lit("}"))).otherwise(F.col("text"))
    return whole.select("path", "text", _features(document, single=True).alias("features"))


def _pieces(spark: SparkSession, paths: Sequence[str], cut: Boundary) -> DataFrame:
    """``(path, text, features, first, last)`` of what lies between separators, the beginning of the feature put back."""
    rows = spark.read.option("lineSep", cut.separator).text(paths).select(F.col("_metadata.file_path").alias("path"), F.ltrim("value", F.lit("﻿\x1e")).alias("text"))
    # After a separator the feature goes on: behind its first name with a colon, behind its type with the next member.
    rows = rows.withColumns({"first": ~F.col("text").rlike(r"\A\s*[:,}]"), "depth": _balance(F.col("text"))})
    first, depth, text = F.col("first"), F.col("depth"), F.col("text")
    start = F.lit(cut.start)
    if not cut.enclosed:
        # Features stand by themselves, one after another; commas between them are allowed.
        own = F.regexp_replace(text, r",?\s*\z", "")
        document = F.when(first & (depth == 0), own).when(~first & (depth == -1), F.concat(start, own))
        return rows.select("path", "text", _features(document, single=True).alias("features"), "first", F.lit(True).alias("last"))
    opened, begun, closed = F.lit('{"features":'), F.concat(F.lit('{"features":['), start), F.lit("]}")
    listed = text.rlike(r"\A\s*\[")
    document = (
        F.when(first & (depth == 0), F.when(listed, F.concat(opened, text, F.lit("}"))).otherwise(text))
        .when(first & listed & (depth == 1), F.concat(opened, text, closed))
        .when(first & (depth == 2), F.concat(text, closed))
        .when(~first & (depth == -1), F.concat(begun, text, closed))
        .when(~first & (depth == -2), F.concat(begun, text, F.lit("}")))
        .when(~first & (depth == -3), F.concat(begun, text))
    )
    return rows.select("path", "text", _features(document, single=False).alias("features"), "first", F.when(first, depth == 0).otherwise(depth < -1).alias("last"))


def _complaint(pieces: DataFrame) -> str | None:
    """What is wrong with one of the files, if anything: told from a few numbers for each file."""
    at_fault = F.col("features").isNull()
    facts = [F.count_if(at_fault).alias("bad"), F.min(F.when(at_fault, F.substring("text", 1, 200))).alias("text")]
    if "first" in pieces.columns:
        facts += [F.count_if("first").alias("heads"), F.count_if("last").alias("tails"), F.count_if(~F.col("last")).alias("inner")]
        wrong = (F.col("bad") > 0) | (F.col("heads") != 1) | ((F.col("inner") > 0) & (F.col("tails") != 1))
    else:
        wrong = F.col("bad") > 0
    found = pieces.groupBy("path").agg(*facts).where(wrong).orderBy("path").first()
    if found is None:
        return None
    if found["bad"]:
        return f"{unquote(found['path'])}: {found['bad']} piece(s) are no features, such as: {found['text']}"
    return f"{unquote(found['path'])}: the collection of features breaks off"


def _by_line(lines: DataFrame) -> DataFrame:
    """Features that have a line each, in lines that may also hold the frame of a collection."""
    feature = "type string, properties map<string,string>, geometry string"
    lines = lines.select(F.regexp_replace(F.trim("value"), r",$", "").alias("text"))
    # Text that breaks off is parsed as far as it goes, and marked.
    lines = lines.select("text", F.from_json("text", f"{feature}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT}).alias("f"))
    is_feature = F.coalesce((F.col("f.type") == "Feature") & F.col(f"f.{_CORRUPT}").isNull(), F.lit(False))
    # What stands around features that have a line each: brackets, and the head and tail of the collection.
    is_frame = F.col("text").rlike(r'^[\[\]{}\s]*$|^\{?\s*"(type|name|crs|bbox|features)"|^\]')
    strange = ~is_feature & (~is_frame | F.contains("text", F.lit(_MARK)))
    error = F.raise_error(F.concat(F.lit("neither a feature nor the frame of a collection: "), F.substring("text", 1, 200)))
    return lines.filter(F.when(strange, error.cast("boolean")).otherwise(is_feature)).select("f.*")


def read_geojson(spark: SparkSession, path: str | Sequence[str], layout: str | None = None) -> DataFrame:
    """Features as rows: one text column per property, and ``geometry`` in longitude and latitude.

    A file is a collection, a list of features, features one after another, or one feature, in any layout. It is split at the
    boundaries of features; see the module. ``layout`` may name ``lines``, where every feature has its own line and no look
    at the text is wanted, or ``document``, where each file is parsed as a whole. Text that is no GeoJSON, or breaks off,
    raises MalformedText and gives no rows; an empty file is no features. A property called geometry comes as
    ``geometry__property``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if layout not in (None, "lines", "document"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "lines":
        features = _by_line(spark.read.text(paths))
    else:
        cut = _sniff(spark, paths) if layout is None else None
        read = _pieces(spark, paths, cut) if cut else _documents(spark, paths)
        complaint = _complaint(read)
        if complaint and cut:
            # Nested text may look like a boundary, and files may have been written by several programs.
            read = _documents(spark, paths)
            complaint = _complaint(read)
        if complaint:
            raise MalformedText(complaint)
        changed = F.raise_error(F.lit("a file changed while it was read")).cast(read.schema["features"].dataType)
        features = read.select(F.explode(F.coalesce("features", changed)).alias("f")).select("f.*")
    found = features.select(F.explode(F.map_keys("properties")).alias("k")).distinct()
    keys = sorted(r["k"] for r in found.collect())
    columns = [F.try_element_at("properties", F.lit(k)).alias("geometry__property" if k == "geometry" else k) for k in keys]
    return features.select(*columns, G.from_geojson(F.col("geometry"), 4326).alias("geometry"))
