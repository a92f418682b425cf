"""Entities as JSON-LD: every column a property, code and name columns nested."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import geometry as G
from concordat.types import is_geometry

# Fields that JSON-LD defines itself.
EXTERNAL = ("id", "type", "@context", "location")
# Technical columns of a published data store.
TECHNICAL = ("_id", "_full_text")
# The code that keeps its name beside it.
OWN_CODE, OWN_NAME = "com_code", "com_name"


def _property(c: Column, data_type: T.DataType, legacy_falsy: bool) -> Column:
    if isinstance(data_type, T.BooleanType):
        # A JSON boolean and an empty text share the field, so it is a variant.
        false = '""' if legacy_falsy else "false"
        text = F.when(c, F.lit("true")).when(~c, F.lit(false)).otherwise(F.lit('""'))
        value = F.parse_json(text)
    else:
        value = F.coalesce(c.cast("string"), F.lit(""))
    return F.struct(F.lit("Property").alias("type"), value.alias("value"))


def to_jsonld(
    df: DataFrame,
    entity_type: str,
    id_prefix: str,
    context: str,
    id_column: str = "com_code",
    location: str | None = "geometry",
    drop: Sequence[str] = TECHNICAL,
    legacy_falsy: bool = True,
) -> DataFrame:
    """One entity per row: ``id``, ``type``, ``@context``, ``location`` and properties.

    Missing values become empty text; with ``legacy_falsy`` so does false. A ``X_name`` column moves
    into ``X_code`` where there is one, and other ``_name`` columns are left out, save the entity's
    own name.
    """
    fields = {f.name: f.dataType for f in df.schema if f.name not in (location, *drop)}
    made = {name: _property(F.col(f"`{name}`"), t, legacy_falsy) for name, t in fields.items()}
    columns = [
        F.concat(F.lit(id_prefix), F.col(f"`{id_column}`").cast("string")).alias("id"),
        F.lit(entity_type).alias("type"),
        F.lit(context).alias("@context"),
    ]
    if location is not None:
        c = F.col(f"`{location}`")
        text = G.to_geojson(c) if is_geometry(df.schema[location].dataType) else c
        columns.append(
            F.struct(F.lit("GeoProperty").alias("type"), F.parse_json(text).alias("value")).alias("location")
        )
    for name, value in made.items():
        partner = name[: -len("_code")] + "_name"
        if name.endswith("_name") and name != OWN_NAME:
            continue
        if name.endswith("_code") and name != OWN_CODE and partner in made:
            value = value.withField(partner, made[partner])
        columns.append(value.alias(name))
    return df.select(*columns)


def to_json_lines(entities: DataFrame) -> DataFrame:
    """One JSON document per row in the single column ``value``, as ``write.text`` takes it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in entities.columns])
    return entities.select(F.to_json(whole).alias("value"))


def jsonld_context(
    df: DataFrame, entity_type: str, base_uri: str, location: str | None = "geometry",
    drop: Sequence[str] = TECHNICAL,
) -> dict[str, dict[str, str]]:
    """The context document: the URI of the type and of each field."""
    fields = [c for c in df.columns if c not in (location, *drop, *EXTERNAL)]
    terms = {entity_type: f"{base_uri}#{entity_type}"}
    terms.update({f: f"{base_uri}/{entity_type.lower()}#{f}" for f in fields})
    return {"@context": terms}
