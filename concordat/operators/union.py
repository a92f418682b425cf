"""Union the raw tables of many owners into one conformed table with provenance."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.casts import to_timestamp
from concordat.names import PROVENANCE_STAMPS, Names
from concordat.operators.conform import BEST_GEOMETRY, best_geometry_column, conform, source_column
from concordat.operators.dictionary import CODE, FIELD, LABEL, build_mapping, short_name
from concordat.operators.imports import ARCHIVE
from concordat.operators.joins import BROADCAST_ROWS
from concordat.sources.raw import RawTables, table_key

log = logging.getLogger(__name__)

# How the registry names an owner's data dictionary.
DICTIONARY, DICTIONARY_SUFFIX = "dictionnaire_champs_valeurs_raw", "_dict"
# Fixed value: how the registry writes stamps.
_STAMP = 'YYYY-MM-DD"T"HH24:MI:SS'


def _usable(registry: DataFrame, names: Names) -> DataFrame:
    return registry.filter((F.col("status") == "success") & (F.col(names.target) != ARCHIVE))


def owner_dictionaries(registry: DataFrame, names: Names = Names()) -> DataFrame:
    """One dictionary per use case and owner, the least by schema and by table name."""
    source = F.col(names.source)
    return (
        _usable(registry, names)
        .filter((source == DICTIONARY) | source.endswith(DICTIONARY_SUFFIX))
        .groupBy(names.use_case, "data_owner_id")
        .agg(F.min("schema").alias("dict_schema"), F.min("table").alias("dict_table"))
    )


def matching_tables(
    registry: DataFrame,
    criteria: Column | str | None = None,
    forced_source: str | None = None,
    forced_prefix: str | None = None,
    names: Names = Names(),
) -> DataFrame:
    """Successfully imported tables that meet ``criteria``, each with its owner's dictionary.

    ``group_source`` and ``group_prefix`` name the union the table belongs to. The criteria apply
    as a whole besides the status and archive conditions, whatever ``or`` they hold.
    """
    chosen = _usable(registry, names)
    if criteria is not None:
        chosen = chosen.filter(criteria)
    found = chosen.join(owner_dictionaries(registry, names), [names.use_case, "data_owner_id"], "left")
    prefixes = chosen.groupBy(names.use_case, names.source).agg(F.min("use_case_prefix").alias("__prefix"))
    return found.join(prefixes, [names.use_case, names.source], "left").select(
        *names.fields,
        F.lit(forced_source).alias("group_source") if forced_source else F.col(names.source).alias("group_source"),
        F.lit(forced_prefix).alias("group_prefix") if forced_prefix else F.col("__prefix").alias("group_prefix"),
        "schema", "table", "dict_schema", "dict_table",
        "data_owner_id", F.col("org_name").alias("data_owner_label"), *PROVENANCE_STAMPS,
    )


def provenance(registry_rows: DataFrame, names: Names = Names(), keep: Sequence[str] = ()) -> DataFrame:
    """Registry rows as the provenance columns of the tables they describe."""
    stamps = [to_timestamp(F.col(c), [_STAMP]).alias(c) for c in PROVENANCE_STAMPS]
    key = F.concat_ws(".", "schema", "table").alias("import_table")
    return registry_rows.select(key, *stamps, "data_owner_id", "data_owner_label", *names.fields, *keep)


def empty_union(spark: SparkSession, target: T.StructType, names: Names = Names()) -> DataFrame:
    """No rows, with the columns a union to ``target`` has."""
    stamps = {c: T.TimestampNTZType() for c in PROVENANCE_STAMPS}
    extra = [T.StructField(c, stamps.get(c, T.StringType())) for c in names.provenance]
    return spark.createDataFrame([], T.StructType([extra[0], *target.fields, *extra[1:]]))


def _same_types(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Cast to text the columns that the frames hold under different types."""
    types: dict[str, set[str]] = defaultdict(set)
    for frame in frames:
        for field in frame.schema:
            types[field.name.lower()].add(field.dataType.json())
    mixed = {name for name, found in types.items() if len(found) > 1}
    if not mixed:
        return list(frames)

    def text(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if field.name.lower() not in mixed:
            return c
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        return (F.to_json(c) if nested else c.cast("string")).alias(field.name)

    return [frame.select(*[text(f) for f in frame.schema]) for frame in frames]


def fold_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name as a balanced tree, so that many inputs make no deep plan."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def _clear_provenance(raw: DataFrame, names: Names) -> DataFrame:
    """Set aside, under ``<column>__src``, raw columns named like the provenance to come."""
    taken = {c.lower() for c in names.provenance}
    held = [c for c in raw.columns if c != "import_table"]
    renamed = [f"{c}__src" if c.lower() in taken else c for c in held]
    return raw.select(*[f"`{c}`" for c in held], "import_table").toDF(*renamed, "__import_table")


class _Words(NamedTuple):
    """What the dictionaries of all owners say: one frame of entries, and per dictionary the renames and coded fields."""

    entries: DataFrame | None
    renames: dict[tuple[str, str], dict[str, str]]
    coded: dict[str, set[str]]
    codes: int


class _Tables(NamedTuple):
    rows: list[Row]
    headers: dict[str, T.StructType]
    words: _Words


def _dictionary_key(row: Row) -> str | None:
    return table_key(row["dict_schema"], row["dict_table"]) if row["dict_table"] else None


def _read_words(tables: RawTables, keys: Sequence[str], names: Names) -> _Words:
    """All dictionaries in one scan for each layout, and their renames and coded fields in one job.

    Renames and coded fields are metadata of the size of the headers; labels and codes stay where they are.
    """
    frames = tables.open(keys) if keys else []
    if not frames:
        return _Words(None, {}, {}, 0)
    entries = fold_union([f.select("import_table", FIELD, LABEL, CODE, names.source) for f in frames])
    has_code = F.col(CODE).isNotNull()
    facts = entries.filter(F.col(LABEL).isNotNull()).groupBy("import_table", FIELD, names.source).agg(
        F.min(F.when(~has_code, F.col(LABEL))).alias("rename"), F.count_if(has_code).alias("codes")).collect()
    renames: dict[tuple[str, str], dict[str, str]] = defaultdict(dict)
    coded: dict[str, set[str]] = defaultdict(set)
    for r in facts:
        if r["rename"] is not None and r[names.source] is not None:
            renames[r["import_table"], r[names.source]][r[FIELD]] = r["rename"]
        if r["codes"]:
            coded[r["import_table"]].add(r[FIELD])
    return _Words(entries, renames, coded, sum(r["codes"] for r in facts))


def _prepare(registry_rows: DataFrame, tables: RawTables, with_words: bool, names: Names) -> _Tables:
    """What the driver has to know, in as many jobs for two tables as for thousands."""
    rows = registry_rows.orderBy("schema", "table").collect()
    keys = sorted({k for r in rows if (k := _dictionary_key(r))}) if with_words else []
    return _Tables(rows, tables.headers([table_key(r["schema"], r["table"]) for r in rows]), _read_words(tables, keys, names))


def union_sources(
    spark: SparkSession,
    registry: DataFrame,
    tables: RawTables,
    criteria: Column | str | None = None,
    target: T.StructType | None = None,
    *,
    best_geometry: Sequence[str] = BEST_GEOMETRY,
    geometry_name: str | None = "geometry",
    srid: int = 2154,
    match_field: bool = True,
    debug: bool = False,
    names: Names = Names(),
) -> DataFrame:
    """All matching raw tables, conformed to ``target`` and unioned, with provenance columns.

    Without ``target`` all columns found are kept; those of differing types become text. Only the registry's few columns
    about tables, their headers and what dictionaries call columns reach the driver. With ``target`` every table's columns
    are chosen there, and all tables are read, conformed and translated together: neither the jobs nor the scans, joins
    and projections of the plan become more with more owners.
    """
    known = _prepare(matching_tables(registry, criteria, names=names), tables, target is not None, names)
    return _union_rows(spark, known, tables, target, best_geometry, geometry_name, srid, match_field, debug, names)


def union_by_name(
    spark: SparkSession, registry: DataFrame, tables: RawTables, source: str, use_case: str,
    target: T.StructType | None = None, names: Names = Names(), **options,
) -> DataFrame:
    """Union of one source of one use case."""
    criteria = (F.col(names.use_case) == use_case) & (F.col(names.source) == source)
    return union_sources(spark, registry, tables, criteria, target, names=names, **options)


def union_groups(
    spark: SparkSession, registry: DataFrame, tables: RawTables, target: T.StructType | None = None,
    names: Names = Names(), *, best_geometry: Sequence[str] = BEST_GEOMETRY, geometry_name: str | None = "geometry",
    srid: int = 2154, match_field: bool = True, debug: bool = False,
) -> dict[str, DataFrame]:
    """Every union there is to build: ``<prefix>_src_<source>`` -> frame. The jobs are those of one union."""
    known = _prepare(matching_tables(registry, names=names), tables, target is not None, names)
    groups: dict[tuple, list[Row]] = defaultdict(list)
    for row in known.rows:
        groups[row[names.use_case], row["group_source"]].append(row)
    return {
        f"{min((r['group_prefix'] for r in members if r['group_prefix'] is not None), default=None)}_src_{source}": _union_rows(
            spark, known._replace(rows=members), tables, target, best_geometry, geometry_name, srid, match_field, debug, names)
        for (_, source), members in sorted(groups.items(), key=lambda g: tuple(map(str, g[0])))
    }


def _chosen(known: _Tables, target: T.StructType, best_geometry: Sequence[str], names: Names) -> dict[str, list[T.StructField | None]]:
    """Of every table that exists, the raw column behind each target column."""
    out = {}
    for row in known.rows:
        key = table_key(row["schema"], row["table"])
        if (header := known.headers.get(key)) is None:
            continue
        mapping = build_mapping(target.names, known.words.renames.get((_dictionary_key(row), row[names.source])))
        best = best_geometry_column(header, best_geometry)
        found = [source_column(field, header, mapping, best) for field in target]
        out[key] = [None if n is None else header[n] for n in found]
    return out


def _by_type(chosen: dict[str, list[T.StructField | None]]) -> list[tuple[list[T.DataType | None], dict[str, list[str | None]]]]:
    """Tables grouped so that a target column has one raw type in a group: all of them, if raw tables are text."""
    groups: list[tuple[list[T.DataType | None], dict[str, list[str | None]]]] = []
    for key, fields in chosen.items():
        own = [f and f.dataType for f in fields]
        for types, members in groups:
            if all(a is None or b is None or a == b for a, b in zip(types, own, strict=True)):
                types[:] = [a or b for a, b in zip(types, own, strict=True)]
                break
        else:
            members = {}
            groups.append((own, members))
        members[key] = [f and f.name for f in fields]
    return groups


def _translate(conformed: DataFrame, known: _Tables, target: T.StructType, match_field: bool) -> DataFrame:
    """Labels to codes by one join for each coded column, on the dictionary of the row's owner and the label.

    A column is translated in the rows of owners whose dictionary has codes for it; a label without one becomes NULL there.
    """
    words = known.words
    coded = [c for c in target.names if any(short_name(c) in fields for fields in words.coded.values())]
    if not coded or words.entries is None:
        return conformed
    usable = words.entries.filter(F.col(LABEL).isNotNull() & F.col(CODE).isNotNull())
    for i, column in enumerate(coded):
        book, label, code = f"__book{i}", f"__label{i}", f"__code{i}"
        if match_field:
            codes = usable.filter(F.col(FIELD) == short_name(column)).groupBy(F.col("import_table").alias(book), F.col(LABEL).alias(label)).agg(F.min(CODE).alias(code))
        else:
            codes = usable.select(F.col("import_table").alias(book), F.col(LABEL).alias(label), F.col(CODE).alias(code))
        own = F.array_contains("__coded", column)
        value = F.col(f"`{column}`").cast("string")
        codes = F.broadcast(codes) if words.codes <= BROADCAST_ROWS else codes
        conformed = conformed.join(codes, (F.when(own, F.col("__dictionary")) == F.col(book)) & (value == F.col(label)), "left")
        conformed = conformed.withColumn(column, F.when(own, F.col(code)).otherwise(value)).drop(book, label, code)
    return conformed


def _known_rows(spark: SparkSession, known: _Tables, target: T.StructType | None, names: Names) -> DataFrame:
    """Provenance of every table, and with a target its dictionary and the columns that the dictionary translates."""
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in ("schema", "table", "data_owner_id", "data_owner_label", *PROVENANCE_STAMPS, *names.fields)],
        T.StructField("__dictionary", T.StringType()), T.StructField("__coded", T.ArrayType(T.StringType())),
    ])

    def words(row: Row) -> tuple[str | None, list[str]]:
        key = _dictionary_key(row)
        return key, [c for c in (target.names if target is not None else []) if short_name(c) in known.words.coded.get(key, ())]

    rows = spark.createDataFrame([(*[r[c] for c in schema.names[:-2]], *words(r)) for r in known.rows], schema)
    return provenance(rows, names, ["__dictionary", "__coded"]).withColumn("__known", F.lit(True))


def _union_rows(
    spark, known: _Tables, tables: RawTables, target, best_geometry, geometry_name, srid, match_field, debug, names: Names,
) -> DataFrame:
    present = [k for r in known.rows if (k := table_key(r["schema"], r["table"])) in known.headers]
    if not present:
        if target is None:
            raise ValueError("no raw table matches, and there is no target schema for an empty result")
        log.warning("no raw table matches the criteria; the union is empty")
        return empty_union(spark, target, names)

    if target is None:
        frames = [
            conform(_clear_provenance(raw, names), [], complete=True, wkt=True, best_geometry=best_geometry, geometry_name=geometry_name, srid=srid, debug=debug)
            .drop("__import_table__src")
            for raw in tables.open(present)
        ]
        frames = _same_types(frames)
    else:
        model = T.StructType([*target.fields, T.StructField("__import_table", T.StringType())])
        frames = []
        for types, wanted in _by_type(_chosen(known, target, best_geometry, names)):
            raw = tables.columns(wanted, [t or T.StringType() for t in types]).toDF(*model.names)
            # The columns are chosen already.
            frames.append(conform(raw, [model], defined_only=True, complete=True, wkt=True, best_geometry=(), srid=srid, debug=debug).drop("__import_table__src"))
    conformed = fold_union(frames).withColumnRenamed("__import_table", "import_table")

    own = [c for c in conformed.columns if c != "import_table"]
    # One row for each table, held by the driver already: broadcast, or all rows of an owner would meet in one partition.
    joined = conformed.join(F.broadcast(_known_rows(spark, known, target, names)), "import_table", "left")
    # A row that no registered table accounts for must not vanish.
    unknown = F.raise_error(F.concat(F.lit("no provenance for table "), F.coalesce("import_table", F.lit("NULL"))))
    table = F.when(F.col("__known"), F.col("import_table")).otherwise(unknown).alias("import_table")
    if target is not None:
        joined = _translate(joined, known, target, match_field)
    return joined.select(table, *[f"`{c}`" for c in own], *names.provenance[1:])
