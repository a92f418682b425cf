"""Convert an all-text table leniently to a target schema, in one projection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import casts
from concordat.functions import geometry as G
from concordat.operators.dictionary import read_coded, short_name, translate_codes
from concordat.types import is_geometry, is_number, is_text, is_timestamp

# Columns that hold a geometry in many exports, best first.
BEST_GEOMETRY = ("geom", "Geom", "geometrie")
GEO_PATTERN = ".*geo.*"
_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def definition(example: DataFrame) -> DataFrame:
    """Zero rows with the columns of an example table."""
    return example.limit(0)


def _as_schema(model: T.StructType | DataFrame) -> T.StructType:
    return model.schema if isinstance(model, DataFrame) else model


def target_fields(
    source: T.StructType, models: Sequence[T.StructType | DataFrame], defined_only: bool
) -> list[T.StructField]:
    """Columns of the models, first definition wins, then other source columns if wanted."""
    fields: dict[str, T.StructField] = {}
    for model in models:
        for field in _as_schema(model):
            fields.setdefault(field.name, field)
    if not defined_only or not models:
        for field in source:
            fields.setdefault(field.name, field)
    return list(fields.values())


def best_geometry_column(source: T.StructType, candidates: Sequence[str]) -> str | None:
    """First candidate that holds a geometry, else the first that holds text."""
    present = [source[c] for c in candidates if c in source.fieldNames()]
    for suits in (is_geometry, is_text):
        for field in present:
            if suits(field.dataType):
                return field.name
    return None


def is_geometric(field: T.StructField, geo_pattern: str = GEO_PATTERN) -> bool:
    return bool(re.match(geo_pattern, field.name, re.IGNORECASE)) and is_geometry(field.dataType)


def source_column(
    field: T.StructField, source: T.StructType, mapping: Mapping[str, str], best: str | None, geo_pattern: str = GEO_PATTERN
) -> str | None:
    """Under which name the source holds a target column: its mapped name, that in lower case, or its own."""
    if best and is_geometric(field, geo_pattern):
        return best
    mapped = mapping.get(field.name)
    candidates = [mapped, mapped.lower(), field.name] if mapped else [field.name]
    return next((c for c in candidates if c in source.fieldNames()), None)


def to_geometry(c: Column, data_type: T.DataType, wkt: bool, srid: int) -> Column:
    """Geometry is reprojected; text is parsed, assigning (WKT) or reprojecting to (GeoJSON) the system."""
    if is_geometry(data_type):
        return G.transform(c, srid)
    return G.from_wkt(c, srid) if wkt else G.from_geojson(c, srid)


def strict_uuid(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    return F.when(text.isNull() | text.rlike(_UUID), F.lower(text)).otherwise(
        F.raise_error(F.concat(F.lit("invalid uuid: "), text))
    )


def _text(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def _null(data_type: T.DataType) -> Column:
    keep = is_number(data_type) or is_geometry(data_type) or is_timestamp(data_type)
    keep = keep or isinstance(data_type, (T.DateType, T.BooleanType, T.ArrayType))
    return F.lit(None).cast(data_type if keep else T.StringType())


def conform(
    df: DataFrame,
    models: Sequence[T.StructType | DataFrame] = (),
    *,
    defined_only: bool = False,
    complete: bool = False,
    mapping: Mapping[str, str] | None = None,
    dictionary: DataFrame | None = None,
    coded: Sequence[str] | None = None,
    match_field: bool = True,
    date_formats: Sequence[str] = casts.DATE_FORMATS,
    geo_pattern: str = GEO_PATTERN,
    wkt: bool = False,
    best_geometry: Sequence[str] = BEST_GEOMETRY,
    geometry_name: str | None = "geometry",
    srid: int = 2154,
    uuid_pattern: str | None = None,
    strict_boolean: bool = False,
    debug: bool = False,
) -> DataFrame:
    """Rename, complete and convert the columns of ``df``.

    - ``models`` name the target columns and types; other source columns follow unless ``defined_only``.
    - ``complete`` adds target columns the source lacks as NULL; otherwise they are left out.
    - ``mapping`` says under which name the source holds a column: that exact name, then its lower
      case, then the target name.
    - ``dictionary`` with ``defined_only`` translates labels to codes in the ``coded`` fields.
    - ``uuid_pattern`` names, by a regular expression searched in the column name, columns that
      must be UUIDs; a malformed one fails the run.
    - ``debug`` adds the source text of each column as ``<column>__src``.
    """
    source = df.schema
    mapping = mapping or {}
    fields = target_fields(source, models, defined_only)
    if not complete:
        fields = [f for f in fields if f.name in source.fieldNames()]
    best = best_geometry_column(source, best_geometry)

    # Columns are addressed by position, since source names may differ only by case.
    placed = df.toDF(*[f"c{i}" for i in range(len(source))])
    position = {f.name: i for i, f in reversed(list(enumerate(source)))}

    output: list[Column] = []
    renamed: dict[str, str] = {}
    for field in fields:
        geometric = is_geometric(field, geo_pattern)
        name = source_column(field, source, mapping, best, geo_pattern)
        alias = geometry_name if geometric and not models and geometry_name else field.name
        renamed[field.name] = alias
        if name is None:
            value, text = _null(field.dataType), F.lit(None).cast("string")
        else:
            column, held = F.col(f"c{position[name]}"), source[position[name]].dataType
            text = _text(column, held)
            if geometric:
                value = to_geometry(column, held, wkt, srid)
            elif isinstance(field.dataType, T.ArrayType) and isinstance(held, T.ArrayType):
                value = column
            elif uuid_pattern and re.search(uuid_pattern, field.name):
                value = strict_uuid(column)
            elif is_text(field.dataType) or isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
                value = text
            else:
                value = casts.lenient(column, held, field.dataType, date_formats, strict_boolean)
        output.append(value.alias(alias))
        if debug:
            output.append(text.alias(f"{field.name}__src"))
    converted = placed.select(*output)

    if dictionary is None or not (defined_only and models):
        return converted
    if coded is None:
        coded = read_coded(dictionary, {short_name(f.name) for f in fields})
    translated = [renamed[f.name] for f in fields if short_name(f.name) in coded]
    return translate_codes(converted, dictionary, translated, match_field)


def read_example_perimeters(df: DataFrame, srid: int = 2154) -> DataFrame:
    """Example rows with their outline parsed from text: the contract other perimeters follow."""
    return df.select(G.from_wkt(F.col("geom"), srid).alias("geom"))


def normalize_types(
    df: DataFrame, spec: Mapping[str, T.DataType | str], formats: Sequence[str] = casts.DATE_FORMATS
) -> DataFrame:
    """Replace the columns named in ``spec`` by their lenient conversion; text keeps NULL for blanks."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if field.name in spec:
            target = _type(spec[field.name])
            lenient = casts.lenient(c, field.dataType, target, formats)
            c = (casts.to_text(c) if is_text(target) else lenient).alias(field.name)
        columns.append(c)
    return df.select(*columns)


def _type(t: T.DataType | str) -> T.DataType:
    return T.DataType.fromDDL(t) if isinstance(t, str) else t


def strict_types(df: DataFrame, spec: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast the columns named in ``spec``; the first value that does not fit fails the run."""
    values = {}
    for name, t in spec.items():
        wanted = _type(t)
        c = F.col(f"`{name}`")
        checked = c.try_cast(wanted)
        value = F.when(c.isNull() | checked.isNotNull(), checked).otherwise(
            F.raise_error(F.concat(F.lit(f"{name} does not fit {wanted.simpleString()}: "), c.cast("string")))
        )
        values[name] = value
    return df.withColumns(values)


def cast_report(
    df: DataFrame, spec: Mapping[str, T.DataType | str], formats: Sequence[str] = casts.DATE_FORMATS
) -> DataFrame:
    """Per column: rows, blanks, values that parsed and values rejected, with the least rejected one.

    Each value is converted once, and all counts come from one aggregation over the table, so
    its size does not multiply by the number of columns.
    """
    aggregates, names, judged = [], list(spec), []
    for i, name in enumerate(names):
        c = F.col(f"`{name}`")
        target = _type(spec[name])
        blank = c.isNull() | (F.length(F.trim(c.cast("string"))) == 0)
        parsed = casts.lenient(c, df.schema[name].dataType, target, formats, strict_boolean=True).isNotNull()
        judged.append(
            F.struct(
                c.cast("string").alias("text"),
                F.when(blank, "blank").when(parsed, "parsed").otherwise("rejected").alias("verdict"),
            ).alias(f"c{i}")
        )
        verdict = F.col(f"c{i}.verdict")
        aggregates += [F.count_if(verdict == v).alias(f"{v}{i}") for v in ("blank", "parsed", "rejected")]
        aggregates.append(F.min(F.when(verdict == "rejected", F.col(f"c{i}.text"))).alias(f"sample{i}"))
    counts = df.select(*judged).agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    lines = [
        F.struct(
            F.lit(name).alias("column"), F.col("rows"), F.col(f"blank{i}").alias("blank"),
            F.col(f"parsed{i}").alias("parsed"), F.col(f"rejected{i}").alias("rejected"),
            F.col(f"sample{i}").alias("sample_reject"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def parse_geometry(df: DataFrame, column: str, fmt: str, srid: int) -> DataFrame:
    """Replace a text column by the geometry it spells, ``fmt`` being ``wkt`` or ``geojson``."""
    if fmt not in ("wkt", "geojson"):
        raise ValueError(f"unknown geometry format {fmt!r}")
    return df.withColumn(column, to_geometry(F.col(column), df.schema[column].dataType, fmt == "wkt", srid))


def reproject(df: DataFrame, column: str, to_srid: int) -> DataFrame:
    return df.withColumn(column, G.transform(F.col(column), to_srid))


def render_geometry(df: DataFrame, column: str, fmt: str) -> DataFrame:
    text = G.to_wkt(F.col(column)) if fmt == "wkt" else G.to_geojson(F.col(column))
    return df.withColumn(column, text)
