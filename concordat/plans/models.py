"""The named datasets: perimeters, communes, regions, population, links and entities.

Parsed datasets are lazy unions of raw tables. Standard ones are stored incrementally and are
the only layer kept on disk; whatever builds on them stays a lazy frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import geometry as G
from concordat.functions.casts import to_numeric
from concordat.names import Names
from concordat.operators.conform import read_example_perimeters, strict_types
from concordat.operators.incremental import run_incremental
from concordat.operators.jsonld import to_jsonld
from concordat.operators.keys import translate_perimeters
from concordat.operators.link import MARKER, link_watermark, link_within, marked
from concordat.operators.union import union_by_name, union_sources
from concordat.sources.raw import RawTables
from concordat.sources.tables import GroupedTable
from concordat.types import DECIMAL, GEOMETRY

PERIMETER = T.StructType([T.StructField("geom", GEOMETRY)])
# Example outlines, which show what a perimeter file holds.
PERIMETER_EXAMPLES = (
    "POLYGON((3.8 48.5, 3.8 48.6, 3.9 48.6, 3.8 48.5))",
    "POLYGON((3.6 48.3, 3.6 48.4, 3.7 48.4, 3.6 48.3))",
)
# Reference columns of the population and demography sources.
POPULATION_KEY, POPULATION = "Code", "Population municipale 2019"
DEMOGRAPHY_KEY, DEMOGRAPHY = "CODGEO", "Population"
PERIMETER_ROLE = "perimetre"


def perimeter_example(spark: SparkSession) -> DataFrame:
    """Example perimeters, parsed; their schema is the definition other perimeters follow."""
    return read_example_perimeters(spark.createDataFrame([(w,) for w in PERIMETER_EXAMPLES], "geom string"))


def perimeters_parsed(
    spark: SparkSession, registry: DataFrame, tables: RawTables, use_case: str | None = None, names: Names = Names()
) -> DataFrame:
    """Outlines of data owners, of one use case or of all, as 2154 geometry with provenance."""
    wanted: Column = F.col(names.role) == PERIMETER_ROLE
    if use_case is not None:
        wanted = wanted & (F.col(names.use_case) == use_case)
    return union_sources(spark, registry, tables, wanted, PERIMETER, srid=2154, names=names)


def perimeters_standard(parsed: DataFrame, path: str, mode: str = "incremental", names: Names = Names()) -> DataFrame:
    """Stored perimeters: an owner's outlines of a use case are replaced together."""
    return run_incremental(parsed, path, [names.use_case, "data_owner_id"], mode=mode)


def perimeters_translated(
    standard: DataFrame, use_case_prefix: str, namespace: str, src_priority: str | None = None, names: Names = Names()
) -> DataFrame:
    return translate_perimeters(standard, f"{use_case_prefix}percomp_", namespace, src_priority, names=names)


def reference_parsed(
    spark: SparkSession, registry: DataFrame, tables: RawTables, source: str, use_case: str, names: Names = Names()
) -> DataFrame:
    """Communes, regions or population as found, with geometry in 4326."""
    return union_by_name(spark, registry, tables, source, use_case, names=names, srid=4326)


def population_typed(parsed: DataFrame) -> DataFrame:
    """Population with its number cast strictly: a malformed one fails the run."""
    return strict_types(parsed, {POPULATION: DECIMAL})


def population_standard(typed: DataFrame, path: str, mode: str = "incremental") -> DataFrame:
    """Stored population: what is newer replaces the rows of its commune's code."""
    return run_incremental(typed, path, POPULATION_KEY, mode=mode)


def demography_typed(parsed: DataFrame) -> DataFrame:
    return strict_types(parsed.withColumn(DEMOGRAPHY, to_numeric(F.col(f"`{DEMOGRAPHY}`"))), {DEMOGRAPHY: DECIMAL})


def with_centres(df: DataFrame) -> DataFrame:
    """Shape and centre in 2154 besides 4326; ``geo_point_2d`` holds latitude first."""
    centre = G.point_from_lat_lon(F.col("geo_point_2d"), 4326)
    return df.withColumns(
        {
            "geometry_center": centre,
            "geometry_shape_2154": G.transform(F.col("geometry"), 2154, source_srid=4326),
            "geometry_center_2154": G.transform(centre, 2154, source_srid=4326),
        }
    ).drop("geo_point_2d")


def communes_enriched(
    communes: DataFrame, population: DataFrame, demography: DataFrame, names: Names = Names()
) -> DataFrame:
    """Communes with shapes, 2019 population and 2014 demography; a commune without them stays."""
    inhabitants = population.select(F.col(POPULATION_KEY).alias("__code"), POPULATION)
    people = demography.drop(*names.provenance)
    return (
        with_centres(communes)
        .join(inhabitants, F.col("com_code") == F.col("__code"), "left")
        .drop("__code")
        .join(people, F.col("com_code") == F.col(DEMOGRAPHY_KEY), "left")
    )


def communes_standard(enriched: DataFrame, path: str, mode: str = "incremental") -> DataFrame:
    return run_incremental(enriched, path, "com_code", mode=mode)


def regions_standard(parsed: DataFrame, path: str, mode: str = "incremental") -> DataFrame:
    return run_incremental(with_centres(parsed), path, "reg_code", mode=mode)


def commune_links(
    objects: DataFrame,
    communes: DataFrame,
    path: str,
    object_id: str,
    geometry: str = "geometry",
    srid: int = 4326,
    mode: str = "incremental",
    **options,
) -> DataFrame:
    """Stored links of objects to communes. Changed objects get all their links replaced.

    Links are not refreshed when communes change; run with ``mode="full"`` then.
    """
    objects = objects.withColumn(object_id, F.col(object_id).cast("string"))
    table = GroupedTable(objects.sparkSession, path, [object_id])
    current = None if mode == "full" else table.group(MARKER)
    mark = None if current is None else link_watermark(current)
    links = link_within(
        objects, communes, object_id, geometry,
        area_geometry="geometry_shape_2154" if srid == 2154 else "geometry",
        since_mark=mark, marker=True, **options,
    )
    if current is None:
        table.store(links)
    else:
        # Objects that moved out of every commune must lose their links too, and the old watermark goes.
        changed = objects.filter(F.col("last_changed") > F.lit(mark)).select(object_id)
        marker = objects.sparkSession.createDataFrame([(MARKER,)], f"`{object_id}` string")
        table.replace(links, replaced=changed.unionByName(marker))
    return table.read()


def links_only(stored: DataFrame) -> DataFrame:
    """Links without the row that carries the watermark."""
    return stored.filter(~marked(stored))


def commune_entities(communes: DataFrame, id_prefix: str, context: str) -> DataFrame:
    """Communes as JSON-LD entities."""
    flat = communes.drop("geometry_center", "geometry_shape_2154", "geometry_center_2154")
    return to_jsonld(flat, "Commune", id_prefix, context)


