"""Queries over the driver's tables, one per operator, each beside the SQL that states its answer.

The tables hold no geometry, registry or dictionary, so each query derives its input from keys of
whole tables by a formula that its SQL repeats. The SQL says what must come out, not how.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import geometry as G
from concordat.functions.casts import fold_text, namespace_uuid, to_date, to_timestamp
from concordat.operators import (
    catalog, conform, dedupe, dictionary, imports, incremental, jsonld, keys, kpi, link, meta, profile, publish,
    registry, union,
)
from concordat.plans import models
from concordat.sources import files
from concordat.sources.raw import FrameTables, ParquetTables
from concordat.sources.tables import shared_dir
from concordat.streaming import upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def iso_text(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd'T'HH:mm:ss")


# --- indicators ---------------------------------------------------------------------------


@query("kpi_join_aggregate", """
SELECT c_mktsegment, n_name, n_regionkey, count(o_orderkey) AS order_count,
       round(sum(o_totalprice), 2) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_mktsegment, n_name, n_regionkey
""")
def kpi_join_aggregate(spark, sf_dir):
    owners = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    result = kpi.count_and_sum_by(
        table(spark, sf_dir, "orders"), owners, "o_custkey", "c_custkey",
        by=["c_mktsegment", "n_name", "n_regionkey"], counted="o_orderkey", summed="o_totalprice",
        count_name="order_count", sum_name="total_price",
    )
    return result.withColumn("total_price", F.round("total_price", 2))


@query("kpi_light_points", """
SELECT l_returnflag AS gestionnaire_title, s_name AS est_dans_commune_com_nom,
       CAST(s_acctbal AS DOUBLE) AS population_2019,
       count(CASE WHEN l_linenumber % 3 <> 0 THEN l_orderkey END) AS nombre_point_lumineux,
       round(sum(l_quantity), 2) AS puissance_totale
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE s_suppkey % 10 <> 7
GROUP BY ALL
""")
def kpi_light_points(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    points = table(spark, sf_dir, "lineitem").join(names, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.when(F.col("l_linenumber") % 3 != 0, text("l_orderkey")).alias("reference"),
        F.col("l_quantity").alias("puissance"),
        F.col("l_returnflag").alias("gestionnaire_title"),
        F.col("s_name").alias("est_dans_commune_com_nom"),
        text("l_suppkey").alias("insee"),
    )
    population = table(spark, sf_dir, "supplier").filter("s_suppkey % 10 <> 7").select(
        text("s_suppkey").alias("Code"), F.col("s_acctbal").alias("Population municipale 2019")
    )
    result = kpi.light_points_by_commune(points, population)
    return result.select(
        "gestionnaire_title", "est_dans_commune_com_nom",
        F.col("Population municipale 2019").alias("population_2019"),
        "nombre_point_lumineux", F.round("puissance_totale", 2).alias("puissance_totale"),
    )


# --- catalogue and import run -------------------------------------------------------------

_USE_CASE_SQL = """CASE c_custkey % 6 WHEN 0 THEN 'apcom' WHEN 1 THEN 'sdirve' WHEN 2 THEN 'eaupotable'
     WHEN 3 THEN 'eclairage_public' WHEN 4 THEN 'unknown' ELSE 'apcom' END"""


def _cases(key: Column, values: list[str | None]) -> Column:
    result = F.lit(values[-1]).cast("string")
    for i, v in enumerate(values[:-1]):
        result = F.when(key == i, F.lit(v)).otherwise(result)
    return result


def _use_case(key: Column) -> Column:
    return _cases(key % 6, ["apcom", "sdirve", "eaupotable", "eclairage_public", "unknown", "apcom"])


def _catalog_inputs(spark, sf_dir) -> dict[str, DataFrame]:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    start = F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00"))

    def extra(name: str, value: Column, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(name).alias("key"), value.alias("value")))

    extras = F.array_compact(F.array(
        extra(" CAS_USAGE", F.concat(F.lit(" "), _use_case(key)), key % 11 != 0),
        extra("ROLE ", F.lit(" source "), key % 2 == 0),
        extra("SOURCE_NOM", F.col("c_mktsegment"), F.lit(True)),
        extra("SOURCE_NOM", F.lit("ZZ"), F.lit(True)),
        extra("TARGET", F.lit("archive"), key % 13 == 0),
    ))
    return {
        "resource": table(spark, sf_dir, "orders").select(
            text("o_orderkey").alias("id"),
            F.concat(F.lit("file-"), text("o_orderkey"), F.lit(".csv")).alias("name"),
            F.col("o_orderdate").alias("created"),
            F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate")).alias("last_modified"),
            F.col("o_orderkey").alias("size"),
            F.lit("CSV").alias("format"), F.lit("{}").alias("extras"), F.lit("http://data/").alias("url"),
            text("o_custkey").alias("package_id"),
            F.when(F.col("o_orderkey") % 17 == 0, "deleted").otherwise("active").alias("state"),
        ),
        "package": customer.select(
            text(key).alias("id"), F.concat(F.lit("ds-"), text(key)).alias("name"), F.col("c_name").alias("title"),
            start.alias("metadata_created"),
            (start + F.make_dt_interval((key % 1000).cast("int"))).alias("metadata_modified"),
            text("c_nationkey").alias("owner_org"),
            text(F.col("c_nationkey") % 5).alias("creator_user_id"),
            F.when(key % 7 == 0, "deleted").otherwise("active").alias("state"),
        ),
        "package_extra": customer.select(text(key).alias("package_id"), F.explode(extras).alias("e")).select(
            "package_id", "e.*"
        ),
        "organisation": nation.select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            F.concat(F.lit("Org "), "n_name").alias("title"),
            (F.col("n_nationkey") % 9 != 8).alias("is_organization"),
        ),
        "organisation_extra": nation.filter("n_nationkey < 24").select(
            text("n_nationkey").alias("group_id"),
            F.when(F.col("n_nationkey") < 20, "SIREN").otherwise("OTHER").alias("key"),
            F.concat(F.lit("99"), text("n_nationkey")).alias("value"),
        ),
        "user": table(spark, sf_dir, "region").select(
            text("r_regionkey").alias("id"), F.concat("r_name", F.lit("@mail")).alias("email"),
            F.col("r_name").alias("name"),
        ),
    }


@query("eav_pivot_catalog", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS ds_id, {_USE_CASE_SQL} AS cas_usage,
       CASE WHEN c_custkey % 2 = 0 THEN 'source' END AS role, least(c_mktsegment, 'ZZ') AS source_nom,
       CASE WHEN c_custkey % 13 = 0 THEN 'archive' END AS target, n_name AS org_name,
       CASE WHEN n_nationkey < 20 THEN '99' || n_nationkey END AS siren, r_name AS u_name,
       strftime(greatest(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END,
                         TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER))),
                '%Y-%m-%dT%H:%M:%S') AS last_changed
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON r_regionkey = n_nationkey % 5
WHERE o_orderkey % 17 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
      AND n_nationkey < 24 AND n_nationkey % 9 <> 8
""")
def eav_pivot_catalog(spark, sf_dir):
    return catalog.resource_catalog(**_catalog_inputs(spark, sf_dir)).select(
        "id", "ds_id", "cas_usage", "role", "source_nom", "target", "org_name", "siren", "u_name",
        iso_text("last_changed").alias("last_changed"),
    )


def _plan_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A catalogue of one resource per customer, and the state kept from an earlier run."""
    key = F.col("c_custkey")
    day = F.make_dt_interval((key % 1000).cast("int"))
    resources = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            text(key).alias("id"),
            F.concat(_cases(key % 5, ["reparations", "canalisations_en_service", "divers", "x", "y"]),
                     F.lit("-"), text(key), F.lit(".csv")).alias("name"),
            F.concat(F.lit("ds-"), text(key)).alias("ds_id"), F.concat(F.lit("ds-"), text(key)).alias("ds_name"),
            F.col("c_name").alias("ds_title"),
            F.to_timestamp_ntz(F.lit("1994-01-01 00:00:00")).alias("ds_metadata_created"),
            F.when(key % 19 != 0, F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")) + day).alias("ds_metadata_modified"),
            F.lit(None).cast("timestamp_ntz").alias("last_modified"),
            F.concat(F.lit("org-"), "n_name").alias("org_id"), F.col("n_name").alias("org_name"),
            F.col("n_name").alias("org_title"), F.lit("a@b").alias("u_email"), F.lit("http://data/").alias("url"),
            _use_case(key).alias("cas_usage"),
            _cases(key % 4, ["source", " ", "perimetre", "kpi"]).alias("role"),
            F.when(key % 3 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("source_nom"),
            F.when(key % 13 == 0, F.lit("archive")).alias("target"),
            F.when(key % 2 == 0, F.concat(F.lit("S-"), text(F.floor(key / 4)))).alias("siren"),
            _cases(key % 8, ["CSV", "csv", "GeoJSON", "csv", "pdf", "csv", None, "csv"]).alias("format"),
        )
    )
    stamp = F.date_format("ds_metadata_modified", "yyyy-MM-dd'T'HH:mm:ss")
    number = F.col("id").cast("long")
    kept = [
        resources.filter(number % divisor == 1).select(
            imports.resource_key(step, "prod").alias("resource_key"), stamp.alias("timestamp"), status.alias("status")
        )
        for step, divisor, status in (
            ("download", 5, F.when(number % 25 == 1, "too big").otherwise("success")),
            ("insert", 10, F.lit("success")),
        )
    ]
    return resources, kept[0].unionByName(kept[1])


_PLAN_SQL = f"""
WITH base AS (
  SELECT *, CAST(c_custkey AS VARCHAR) AS id, {_USE_CASE_SQL} AS use_case,
    CASE WHEN c_custkey % 4 = 2 THEN 'perimetre' ELSE 'source' END AS role,
    CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment
         WHEN c_custkey % 5 = 0 THEN 'reparations'
         WHEN c_custkey % 5 = 1 THEN 'canalisations_en_service' END AS source,
    c_custkey % 13 = 0 AS archived,
    CASE WHEN c_custkey % 2 = 0 THEN 's' || (c_custkey // 4)
         ELSE 'org' || regexp_replace(right(lower(n_name), 6), '[^a-z0-9_]', '', 'g') END AS owner,
    c_custkey % 19 <> 0 AS stamped
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 <> 3
), judged AS (
  SELECT *, use_case = 'unknown' AS bad_case, source IS NULL AS bad_source,
    NOT archived AND stamped AND c_custkey % 25 = 1 AS bad_download,
    CASE use_case WHEN 'eaupotable' THEN 'eaupot' WHEN 'eclairage_public' THEN 'eclpub' ELSE use_case END AS prefix
  FROM base
), named AS (
  SELECT *, CASE WHEN NOT (bad_case OR bad_source OR bad_download OR archived)
                 THEN prefix || '_raw_' || source || '_' || owner END AS tbl
  FROM judged
), ranked AS (
  SELECT *, tbl IS NOT NULL AND row_number() OVER (PARTITION BY use_case, tbl ORDER BY id) > 1 AS duplicate
  FROM named
), done AS (
  SELECT *, tbl IS NOT NULL AND NOT duplicate AND stamped AND c_custkey % 10 = 1 AS unchanged,
    CASE c_custkey % 8 WHEN 2 THEN 'geojson' WHEN 4 THEN 'pdf' ELSE 'csv' END AS format
  FROM ranked
)
"""


@query("registry_plan", _PLAN_SQL + """
SELECT id AS resource_id, use_case, role, source, CASE WHEN archived THEN 'archive' ELSE 'prod' END AS target,
  CASE WHEN bad_case OR bad_source OR bad_download OR duplicate
            OR (tbl IS NOT NULL AND NOT duplicate AND NOT unchanged AND format = 'pdf') THEN 'error'
       WHEN archived THEN 'skipped' ELSE 'success' END AS status,
  CASE WHEN unchanged THEN 'no change, skipped'
       WHEN tbl IS NULL OR duplicate OR format = 'pdf' THEN 'prepare'
       WHEN format = 'csv' THEN 'read_delimited' ELSE 'read_geojson' END AS step,
  owner AS data_owner_id, format, tbl AS "table",
  CAST(bad_case AS INTEGER) + CAST(bad_source AS INTEGER) + CAST(bad_download AS INTEGER)
    + CAST(archived AS INTEGER) + CAST(duplicate AS INTEGER) + CAST(unchanged AS INTEGER)
    + CAST(tbl IS NOT NULL AND NOT duplicate AND NOT unchanged AND format = 'pdf' AS INTEGER) AS messages
FROM done
""")
def registry_plan(spark, sf_dir):
    resources, state = _plan_inputs(spark, sf_dir)
    plan = imports.plan_imports(resources, state)
    return plan.select(
        "resource_id", F.col("CAS_USAGE").alias("use_case"), F.col("ROLE").alias("role"),
        F.col("SOURCE_NOM").alias("source"), F.col("TARGET").alias("target"),
        "status", "step", "data_owner_id", "format", "table",
        F.coalesce(F.json_array_length("messages"), F.lit(0)).alias("messages"),
    )


@query("import_state", _PLAN_SQL + """
, fresh AS (
  SELECT id, 'download' AS step, CASE WHEN bad_download THEN 'too big' ELSE 'success' END AS status
  FROM done WHERE NOT archived
  UNION ALL
  SELECT id, 'insert', 'success' FROM done
  WHERE tbl IS NOT NULL AND NOT duplicate AND NOT unchanged AND format <> 'pdf'
), old AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 'download' AS step,
         CASE WHEN c_custkey % 25 = 1 THEN 'too big' ELSE 'success' END AS status
  FROM customer WHERE c_custkey % 5 = 1
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'insert', 'success' FROM customer WHERE c_custkey % 10 = 1
)
SELECT id, step, status FROM fresh
UNION ALL
SELECT id, step, status FROM old WHERE (id, step) NOT IN (SELECT (id, step) FROM fresh)
""")
def import_state(spark, sf_dir):
    resources, state = _plan_inputs(spark, sf_dir)
    after = imports.next_state(state, imports.plan_imports(resources, state))
    parts = F.split("resource_key", "/")
    return after.select(
        F.element_at(parts, 4).alias("id"), F.element_at(parts, 5).alias("step"), "status"
    )


@query("change_detection", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 THEN FALSE ELSE TRUE END AS changed
FROM orders
""")
def change_detection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.lit("org").alias("org_name"), text("o_custkey").alias("ds_name"), F.lit("r").alias("name"),
        text("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("last_changed"),
    )
    number = F.col("id").cast("long")
    stamp = F.when(number % 3 == 0, iso_text("last_changed")).otherwise("1970-01-01T00:00:00")
    state = orders.filter(number % 3 < 2).select(
        imports.resource_key("insert", "prod").alias("resource_key"), stamp.alias("timestamp"),
        F.lit("success").alias("status"),
    )
    changed = imports.has_changed(orders, state, "insert")
    return changed.select(F.col("id").cast("long").alias("id"), "changed")


def _order_registry(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "skipped")
        .when(F.col("o_orderstatus") == "P", "error").alias("status"),
    )


@query("status_metrics", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' WHEN 'P' THEN 'error' END AS status,
       CAST(o_orderstatus = 'F' AS INTEGER) AS success, CAST(o_orderstatus = 'O' AS INTEGER) AS skipped,
       CAST(o_orderstatus = 'P' AS INTEGER) AS error
FROM orders
""")
def status_metrics(spark, sf_dir):
    return registry.import_status_metrics(_order_registry(spark, sf_dir))


@query("data_owners", """
SELECT CAST(c_nationkey AS VARCHAR) AS data_owner_id, min(c_name) AS data_owner_label, count(*) AS import_count
FROM customer WHERE c_custkey % 6 IN (0, 5) GROUP BY c_nationkey
""")
def data_owners(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        _use_case(F.col("c_custkey")).alias("CAS_USAGE"), text("c_nationkey").alias("data_owner_id"),
        F.col("c_name").alias("org_name"),
    )
    return registry.data_owners(rows, "apcom")


@query("owner_split", """
SELECT c_custkey, c_name, c_nationkey AS data_owner_id FROM customer WHERE c_nationkey = 7
""")
def owner_split(spark, sf_dir):
    path = shared_dir(spark, "owners")
    registry.split_by_owner(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("data_owner_id")), path
    )
    return registry.owner_view(spark.read.parquet(path), 7)


@query("owner_split_all", """
SELECT c_custkey, c_name, c_nationkey AS data_owner_id, 'data_owner_id=' || c_nationkey AS folder FROM customer
""")
def owner_split_all(spark, sf_dir):
    """All owners' rows as they were written, each with the folder that its file lies in."""
    path = shared_dir(spark, "owners")
    registry.split_by_owner(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("data_owner_id")), path
    )
    folder = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    return spark.read.parquet(path).select("c_custkey", "c_name", "data_owner_id", folder.alias("folder"))


_LATEST_SQL = """
SELECT DISTINCT ON (user_id) user_id, event_id, event_type, round(value, 6) AS value
FROM events ORDER BY user_id, ts DESC, event_id DESC
"""


@query("latest_by_key", _LATEST_SQL)
def latest_by_key(spark, sf_dir):
    latest = catalog.latest_by_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"))


@query("stream_upsert", _LATEST_SQL)
def stream_upsert(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # As a pattern, the table may be one file or a folder of files.
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events.parque[t]")
    path = shared_dir(spark, "latest")
    upsert.stream_latest_by_key(changes, path, "user_id", ["ts", "event_id"], f"{path}-progress").awaitTermination()
    latest = upsert.read_latest(spark, path, "user_id", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"))


@query("stream_compacted", _LATEST_SQL)
def stream_compacted(spark, sf_dir):
    """The same stream landed as two batches, the first of which was folded into a base."""
    events = table(spark, sf_dir, "events")
    landing, path = shared_dir(spark, "landing"), shared_dir(spark, "latest")
    for rest in (1, 0):
        events.filter(F.col("event_id") % 2 == rest).write.parquet(f"{landing}/half{rest}")
        changes = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(landing)
        upsert.stream_latest_by_key(changes, path, "user_id", ["ts", "event_id"], f"{path}-progress").awaitTermination()
        if rest:
            upsert.compact(spark, path, "user_id", ["ts", "event_id"])
    latest = upsert.read_latest(spark, path, "user_id", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"))


# --- conversion ---------------------------------------------------------------------------

_RAW_SQL = """
WITH raw AS (
  SELECT o_orderkey,
    CASE o_orderkey % 8 WHEN 0 THEN ' ' || o_custkey || ' ' WHEN 1 THEN '1e3' WHEN 2 THEN '1,5' WHEN 3 THEN ''
         WHEN 4 THEN NULL WHEN 5 THEN o_orderpriority WHEN 6 THEN '-' || o_custkey || '.25' ELSE '.5' END AS num,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN '1.5' WHEN 2 THEN ' -7 ' ELSE o_orderpriority END AS int_,
    CASE o_orderkey % 10 WHEN 0 THEN 'true' WHEN 1 THEN 'Oui ' WHEN 2 THEN 'YES' WHEN 3 THEN 'on' WHEN 4 THEN '1'
         WHEN 5 THEN 'non' WHEN 6 THEN '' WHEN 7 THEN NULL WHEN 8 THEN 'off' ELSE o_orderstatus END AS flag,
    CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE ' ' || o_orderpriority END AS label,
    CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000')
         WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S.000') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
         WHEN 3 THEN 'xx' WHEN 4 THEN ' ' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
    o_orderdate
  FROM orders
)
"""


def _raw_orders(spark, sf_dir) -> DataFrame:
    key, cust = F.col("o_orderkey"), text("o_custkey")
    day = F.col("o_orderdate")

    def pick(modulus: int, *choices: Column | str | None) -> Column:
        result = choices[-1] if isinstance(choices[-1], Column) else F.lit(choices[-1])
        for i, choice in enumerate(choices[:-1]):
            value = choice if isinstance(choice, Column) else F.lit(choice).cast("string")
            result = F.when(key % modulus == i, value).otherwise(result)
        return result

    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pick(8, F.concat(F.lit(" "), cust, F.lit(" ")), "1e3", "1,5", "", None, F.col("o_orderpriority"),
             F.concat(F.lit("-"), cust, F.lit(".25")), ".5").alias("num"),
        pick(4, cust, "1.5", " -7 ", F.col("o_orderpriority")).alias("int_"),
        pick(10, "true", "Oui ", "YES", "on", "1", "non", "", None, "off", F.col("o_orderstatus")).alias("flag"),
        pick(4, "", "  ", None, F.concat(F.lit(" "), "o_orderpriority")).alias("label"),
        pick(6, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.date_format(day, "yyyy/MM/dd HH:mm:ss.SSS"),
             F.date_format(day, "dd/MM/yyyy"), "xx", " ", F.date_format(day, "yyyy-MM-dd")).alias("day"),
    )


_SPEC = {"num": "decimal(38,10)", "int_": "int", "flag": "boolean", "label": "string", "day": "date"}


@query("lenient_cast", _RAW_SQL + """
SELECT o_orderkey,
  round(try_cast(trim(num) AS DOUBLE), 6) AS num,
  CASE WHEN regexp_full_match(trim(int_), '-?[0-9]+') THEN CAST(trim(int_) AS INTEGER) END AS int_,
  CASE WHEN flag IS NULL THEN NULL ELSE lower(trim(flag)) IN ('true', 'oui', 'yes', 'on', '1') END AS flag,
  CASE WHEN trim(label) <> '' THEN label END AS label,
  CASE WHEN o_orderkey % 6 IN (3, 4) THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM raw
""")
def lenient_cast(spark, sf_dir):
    typed = conform.normalize_types(_raw_orders(spark, sf_dir), _SPEC)
    return typed.withColumns({"num": F.round(F.col("num").cast("double"), 6), "day": text("day")})


@query("zoned_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' 07:05:09' AS stamp, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
""")
def zoned_dates(spark, sf_dir):
    """Stamps with a zone, which is passed over, and days and months of one digit."""
    zone = _cases(F.col("o_orderkey") % 3, ["Z", "+02:00", ""])
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'07:05:09"), zone)
    day = F.concat_ws("/", *[F.date_format("o_orderdate", f) for f in ("d", "M", "yyyy")])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(to_timestamp(stamp), "yyyy-MM-dd HH:mm:ss").alias("stamp"), text(to_date(day)).alias("day"))


@query("text_folding", """
SELECT p_partkey, upper(p_name) AS folded FROM part
""")
def text_folding(spark, sf_dir):
    accented = F.translate("p_name", "aeiou", "âéîöÙ")
    return table(spark, sf_dir, "part").select("p_partkey", fold_text(accented).alias("folded"))


@query("cast_report", _RAW_SQL + """
SELECT 'num' AS "column", count(*) AS rows, CAST(count_if(num IS NULL OR trim(num) = '') AS BIGINT) AS blank,
       CAST(count_if(o_orderkey % 8 IN (0, 1, 6, 7)) AS BIGINT) AS parsed, CAST(count_if(o_orderkey % 8 IN (2, 5)) AS BIGINT) AS rejected,
       min(CASE WHEN o_orderkey % 8 IN (2, 5) THEN num END) AS sample_reject FROM raw
UNION ALL
SELECT 'int_', count(*), CAST(0 AS BIGINT), CAST(count_if(o_orderkey % 4 IN (0, 2)) AS BIGINT), CAST(count_if(o_orderkey % 4 IN (1, 3)) AS BIGINT),
       min(CASE WHEN o_orderkey % 4 IN (1, 3) THEN int_ END) FROM raw
UNION ALL
SELECT 'flag', count(*), CAST(count_if(o_orderkey % 10 IN (6, 7)) AS BIGINT),
       CAST(count_if(o_orderkey % 10 IN (0, 1, 2, 3, 4, 5, 8) OR (o_orderkey % 10 = 9 AND flag = 'F')) AS BIGINT),
       CAST(count_if(o_orderkey % 10 = 9 AND flag <> 'F') AS BIGINT),
       min(CASE WHEN o_orderkey % 10 = 9 AND flag <> 'F' THEN flag END) FROM raw
UNION ALL
SELECT 'label', count(*), CAST(count_if(o_orderkey % 4 <> 3) AS BIGINT), CAST(count_if(o_orderkey % 4 = 3) AS BIGINT), CAST(0 AS BIGINT), NULL FROM raw
UNION ALL
SELECT 'day', count(*), CAST(count_if(o_orderkey % 6 = 4) AS BIGINT), CAST(count_if(o_orderkey % 6 NOT IN (3, 4)) AS BIGINT),
       CAST(count_if(o_orderkey % 6 = 3) AS BIGINT), min(CASE WHEN o_orderkey % 6 = 3 THEN day END) FROM raw
""")
def cast_report(spark, sf_dir):
    return conform.cast_report(_raw_orders(spark, sf_dir), _SPEC)


@query("conform_null_complete", """
SELECT p_name AS "prod_libelle", round(CAST(p_size AS DOUBLE), 6) AS "prod_taille", round(p_retailprice, 6) AS "prod_Prix",
       CAST(NULL AS VARCHAR) AS "prod_pose", CAST(NULL AS BOOLEAN) AS "prod_enService",
       CAST(p_size AS VARCHAR) AS "prod_taille__src"
FROM part
""")
def conform_null_complete(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("nom"), text("p_size").alias("taille"), text("p_retailprice").alias("prix"),
        F.col("p_brand").alias("marque"),
    )
    target = T.StructType([
        T.StructField("prod_libelle", T.StringType()), T.StructField("prod_taille", T.DecimalType(38, 10)),
        T.StructField("prod_Prix", T.DecimalType(38, 10)), T.StructField("prod_pose", T.DateType()),
        T.StructField("prod_enService", T.BooleanType()),
    ])
    mapping = dictionary.build_mapping(target.names, {"libelle": "nom"})
    done = conform.conform(raw, [target], defined_only=True, complete=True, mapping=mapping, debug=True)
    return done.select(
        "prod_libelle", F.round(F.col("prod_taille").cast("double"), 6).alias("prod_taille"),
        F.round(F.col("prod_Prix").cast("double"), 6).alias("prod_Prix"),
        text("prod_pose").alias("prod_pose"), "prod_enService", "prod_taille__src",
    )


def _part_dictionary(spark, sf_dir) -> DataFrame:
    """Codes of part types and brands. A type's label also occurs as a brand, with another code."""
    part = table(spark, sf_dir, "part")
    types = part.select("p_type").distinct()
    brands = part.select("p_brand").distinct()

    def rows(df: DataFrame, field: str, label: Column, code: Column) -> DataFrame:
        return df.select(F.lit(field).alias("Champs"), label.alias("Valeur"), code.alias("Code"),
                         F.lit("pieces").alias("SOURCE_NOM"))

    kind, brand = F.col("p_type"), F.col("p_brand")
    coded = [
        rows(types.filter(kind != "PROMO"), "type", kind, F.substring(kind, 1, 3)),
        rows(types, "marque", kind, F.lit("X")),
        rows(brands, "marque", brand, F.regexp_extract(brand, r"(\d+)$", 1)),
        rows(part.agg(F.max("p_type")), "libelle", F.lit("p_name"), F.lit(None).cast("string")),
    ]
    return union.fold_union(coded)


@query("dictionary_translate", """
SELECT p_partkey, p_name AS part_libelle,
       CASE WHEN p_type <> 'PROMO' THEN substr(p_type, 1, 3) END AS part_type,
       regexp_extract(p_brand, '([0-9]+)$', 1) AS part_marque
FROM part
""")
def dictionary_translate(spark, sf_dir):
    words = _part_dictionary(spark, sf_dir)
    raw = table(spark, sf_dir, "part").select(
        text("p_partkey").alias("partkey"), "p_name", F.col("p_type").alias("type"), F.col("p_brand").alias("marque")
    )
    target = T.StructType([
        T.StructField(n, T.StringType()) for n in ("part_partkey", "part_libelle", "part_type", "part_marque")
    ])
    short = [dictionary.short_name(n) for n in target.names]
    mapping = dictionary.build_mapping(target.names, dictionary.read_renames(words, "pieces", short))
    done = conform.conform(raw, [target], defined_only=True, complete=True, mapping=mapping, dictionary=words)
    return done.select(F.col("part_partkey").cast("long").alias("p_partkey"), "part_libelle", "part_type", "part_marque")


@query("dictionary_columns", """
SELECT 'coded' AS kind, 'marque' AS field, NULL AS name UNION ALL SELECT 'coded', 'type', NULL
UNION ALL SELECT 'renamed', 'libelle', 'p_name'
""")
def dictionary_columns(spark, sf_dir):
    words = _part_dictionary(spark, sf_dir)
    coded = dictionary.coded_columns(words).select(
        F.lit("coded").alias("kind"), F.col("Champs").alias("field"), F.lit(None).cast("string").alias("name")
    )
    renamed = dictionary.column_renames(words, "pieces").select(
        F.lit("renamed").alias("kind"), F.col("Champs").alias("field"), F.col("Valeur").alias("name")
    )
    return coded.unionByName(renamed)


# --- union of sources ---------------------------------------------------------------------


def _order_tables(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Orders as three owners' raw tables, which name and order their columns differently."""
    orders = table(spark, sf_dir, "orders")
    key, price, day = text("o_orderkey"), text("o_totalprice"), F.date_format("o_orderdate", "dd/MM/yyyy")
    frames = {
        "commerce.com_raw_commandes_f": orders.filter("o_orderstatus = 'F'").select(
            key.alias("numero"), price.alias("montant"), day.alias("date")),
        "commerce.com_raw_commandes_o": orders.filter("o_orderstatus = 'O'").select(
            day.alias("date"), key.alias("numero"), F.col("o_orderpriority").alias("autre"), price.alias("prix")),
        "commerce.com_raw_commandes_p": orders.filter("o_orderstatus = 'P'").select(price.alias("montant"), key.alias("numero")),
        "commerce.com_raw_dict_o": orders.filter("o_orderstatus = 'O'").groupBy("o_orderstatus").agg(
            F.lit("montant").alias("Champs"), F.lit("prix").alias("Valeur"), F.lit(None).cast("string").alias("Code"),
            F.lit("commandes").alias("SOURCE_NOM")).drop("o_orderstatus"),
    }
    owner = F.lower("o_orderstatus")
    known = orders.groupBy("o_orderstatus").agg(F.max("o_orderdate").alias("newest")).select(
        F.lit("vente").alias("CAS_USAGE"), F.lit("source").alias("ROLE"), F.lit("commandes").alias("SOURCE_NOM"),
        F.lit("prod").alias("TARGET"), F.lit("success").alias("status"),
        iso_text("newest").alias("last_changed"), F.lit("1990-01-01T00:00:00").alias("added"),
        F.lit(imports.NEVER_REMOVED).alias("removed"), F.lit("not a date").alias("imported"),
        F.concat(F.lit("Owner "), owner).alias("org_name"), owner.alias("data_owner_id"),
        F.lit("commerce").alias("schema"), F.concat(F.lit("com_raw_commandes_"), owner).alias("table"),
        F.lit("com").alias("use_case_prefix"),
    )
    words = known.filter("data_owner_id = 'o'").withColumns(
        {"SOURCE_NOM": F.lit("commandes_dict"), "table": F.lit("com_raw_dict_o")})
    archived = known.filter("data_owner_id = 'f'").withColumns(
        {"TARGET": F.lit("archive"), "table": F.lit("com_raw_commandes_old")})
    return union.fold_union([known, words, archived]), frames


_ORDER_TARGET = T.StructType([
    T.StructField("cmd_numero", T.LongType()), T.StructField("cmd_montant", T.DoubleType()),
    T.StructField("cmd_date", T.DateType()),
])

_UNION_SQL = """
SELECT 'commerce.com_raw_commandes_' || lower(o_orderstatus) AS import_table, o_orderkey AS cmd_numero,
       round(o_totalprice, 6) AS cmd_montant,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS cmd_date,
       strftime(max(o_orderdate) OVER (PARTITION BY o_orderstatus), '%Y-%m-%dT%H:%M:%S') AS last_changed,
       CAST(NULL AS VARCHAR) AS imported, lower(o_orderstatus) AS data_owner_id,
       'Owner ' || lower(o_orderstatus) AS data_owner_label, 'vente' AS use_case
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
"""


def _union_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "import_table", "cmd_numero", F.round("cmd_montant", 6).alias("cmd_montant"), text("cmd_date").alias("cmd_date"),
        iso_text("last_changed").alias("last_changed"), text("imported").alias("imported"),
        "data_owner_id", "data_owner_label", F.col("CAS_USAGE").alias("use_case"),
    )


@query("union_sources", _UNION_SQL)
def union_sources(spark, sf_dir):
    known, frames = _order_tables(spark, sf_dir)
    done = union.union_by_name(spark, known, FrameTables(frames), "commandes", "vente", _ORDER_TARGET)
    return _union_columns(done)


@query("union_stored_tables", _UNION_SQL)
def union_stored_tables(spark, sf_dir):
    """The same union over stored raw tables: those with equal columns are one scan."""
    known, frames = _order_tables(spark, sf_dir)
    root = shared_dir(spark, "raw")
    store = ParquetTables(spark, root)
    for name, frame in frames.items():
        store.write(name, frame)
    criteria = "SOURCE_NOM = 'commandes' or SOURCE_NOM = 'nothing'"
    return _union_columns(union.union_sources(spark, known, store, criteria, _ORDER_TARGET))


@query("union_empty_fallback", """
SELECT 'none' AS source, 0 AS n UNION ALL SELECT 'orders', count(*) FROM orders
""")
def union_empty_fallback(spark, sf_dir):
    known, frames = _order_tables(spark, sf_dir)
    none = union.union_by_name(spark, known, FrameTables(frames), "nothing", "vente", _ORDER_TARGET)
    counted = none.agg(F.count(F.lit(1)).alias("n")).select(F.lit("none").alias("source"), "n")
    some = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n")).select(F.lit("orders").alias("source"), "n")
    return counted.unionByName(some)


@query("matching_tables", """
SELECT 'commandes' AS source, lower(o_orderstatus) AS data_owner_id, 'com' AS prefix,
       'com_raw_commandes_' || lower(o_orderstatus) AS "table",
       CASE o_orderstatus WHEN 'O' THEN 'com_raw_dict_o' END AS dict_table
FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'commandes_dict', 'o', 'com', 'com_raw_dict_o', 'com_raw_dict_o'
""")
def matching_tables(spark, sf_dir):
    known, _ = _order_tables(spark, sf_dir)
    return union.matching_tables(known).select(
        F.col("group_source").alias("source"), "data_owner_id", F.col("group_prefix").alias("prefix"), "table", "dict_table"
    )


@query("union_without_target", """
SELECT 'commerce.com_raw_commandes_' || lower(o_orderstatus) AS import_table, CAST(o_orderkey AS VARCHAR) AS numero,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS autre,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%d/%m/%Y') END AS date
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
""")
def union_without_target(spark, sf_dir):
    known, frames = _order_tables(spark, sf_dir)
    done = union.union_groups(spark, known, FrameTables(frames))
    return done["com_src_commandes"].select("import_table", "numero", "autre", "date")


# --- keys, dedupe, incremental ------------------------------------------------------------

_NAMESPACE = "commandes.concordat"
_UUID_SQL = f"""
WITH h AS (
  SELECT *, 'clients_' || lower(c_mktsegment) || '_' || c_custkey AS id,
         sha1(unhex('{namespace_uuid(_NAMESPACE).hex}') || encode('clients_' || lower(c_mktsegment) || '_' || c_custkey)) AS d
  FROM customer
)
SELECT c_custkey, 'clients' AS cli_src_kind, 'clients_' || lower(c_mktsegment) AS cli_src_name, 'raw' AS cli_src_table,
       '10_clients_' || lower(c_mktsegment) AS cli_src_priority, id AS cli_id,
       substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-'
         || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(d, 17, 1)), 1) || substr(d, 18, 3)
         || '-' || substr(d, 21, 12) AS cli_uuid
FROM h
"""


@query("generic_keys", _UUID_SQL)
def generic_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", text("c_custkey").alias("cli_src_id"), F.lit("clients").alias("SOURCE_NOM"),
        F.lower("c_mktsegment").alias("data_owner_id"), F.lit("raw").alias("import_table"),
    )
    keyed = keys.add_generic_fields(rows, "cli_", _NAMESPACE, "10")
    return keyed.select("c_custkey", "cli_src_kind", "cli_src_name", "cli_src_table", "cli_src_priority", "cli_id", "cli_uuid")


_DEDUPE_SQL = """
SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, round(value, 6) AS value
FROM events WHERE value > 10 ORDER BY user_id, event_type, ts DESC, event_id DESC
"""


@query("dedupe_distinct_on", _DEDUPE_SQL)
def dedupe_distinct_on(spark, sf_dir):
    kept = dedupe.dedupe(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts desc, event_id desc", "value > 10")
    return kept.select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


@query("dedupe_agg", _DEDUPE_SQL)
def dedupe_agg(spark, sf_dir):
    kept = dedupe.dedupe_agg(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts desc, event_id desc", "value > 10")
    return kept.select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


@query("dedupe_expression", """
SELECT DISTINCT ON (user_id) user_id, event_id, event_type FROM events WHERE value > 1
ORDER BY user_id, floor(value / 10) DESC NULLS FIRST, nullif(event_type, 'click') ASC NULLS FIRST, event_id
""")
def dedupe_expression(spark, sf_dir):
    """An order of expressions, with commas in them and NULLs placed by name."""
    order = "floor(value / 10) desc, nullif(event_type, 'click') asc nulls first, event_id"
    return dedupe.dedupe(table(spark, sf_dir, "events"), "user_id", order, "value > 1").select("user_id", "event_id", "event_type")


_REPLACE_SQL = """
WITH batch AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01')
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM batch
UNION ALL
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') FROM orders
WHERE o_orderdate < TIMESTAMP '1998-06-01' AND o_custkey NOT IN (SELECT o_custkey FROM batch)
"""
_BEFORE = "o_orderdate < timestamp_ntz'1998-06-01'"


def _order_days(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("incremental_replace", _REPLACE_SQL)
def incremental_replace(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target = orders.filter(_BEFORE)
    batch = incremental.changed_since(orders, target, "o_orderdate")
    return _order_days(incremental.replace_by_key(target, batch, "o_custkey"))


@query("incremental_stored", _REPLACE_SQL)
def incremental_stored(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "orders")
    incremental.run_incremental(orders.filter(_BEFORE), path, "o_custkey", "o_orderdate")
    return _order_days(incremental.run_incremental(orders, path, "o_custkey", "o_orderdate"))


@query("incremental_partitioned", """
WITH batch AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01')
SELECT o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day FROM batch
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') FROM orders
WHERE o_orderdate < TIMESTAMP '1998-06-01'
  AND (o_orderstatus, o_orderpriority) NOT IN (SELECT (o_orderstatus, o_orderpriority) FROM batch)
""")
def incremental_partitioned(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "orders")
    groups = ["o_orderstatus", "o_orderpriority"]
    incremental.run_incremental(orders.filter(_BEFORE), path, groups, "o_orderdate", partitioned=True)
    done = incremental.run_incremental(orders, path, groups, "o_orderdate", partitioned=True)
    return done.select("o_orderkey", *groups, F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("incremental_full_refresh", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
""")
def incremental_full_refresh(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "orders")
    incremental.run_incremental(orders.filter(_BEFORE), path, "o_custkey", "o_orderdate")
    return _order_days(incremental.run_incremental(orders, path, "o_custkey", "o_orderdate", mode="full"))


# --- profile and metadata -----------------------------------------------------------------

_PROFILED = {
    "orders": {"o_orderkey": "", "o_custkey": "", "o_orderstatus": "", "o_totalprice": "DECIMAL(20,2)",
               "o_orderdate": "DATE", "o_orderpriority": ""},
    "customer": {"c_custkey": "", "c_name": "", "c_nationkey": "", "c_acctbal": "DECIMAL(20,2)", "c_mktsegment": ""},
    "nation": {"n_nationkey": "", "n_name": "", "n_regionkey": "", "n_gap": ""},
}


def _profile_sql() -> str:
    one = """
SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS table_rows, count(v) AS count_not_nulls,
  count(*) - count(v) AS count_nulls, round(count(v) / count(*), 6) AS pct_not_null,
  count(DISTINCT v) AS count_distinct_values, round(count(DISTINCT v) / count(*), 6) AS pct_unique,
  count(v) / count(*) > 0.9 AS is_recommended_not_nullable_column,
  count(DISTINCT v) / count(*) >= 0.9 AS is_recommended_unique_column,
  min(v) AS min_value, max(v) AS max_value, round(avg(try_cast(v AS DOUBLE)), 4) AS avg_value,
  (SELECT v FROM (SELECT v, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY v) ORDER BY n DESC, v DESC LIMIT 1) AS most_frequent_value,
  CAST(min(length(v)) AS INTEGER) AS min_length, CAST(max(length(v)) AS INTEGER) AS max_length, round(avg(length(v))) AS avr_length, {i} AS ordinal_position
FROM p"""
    parts = []
    for t, columns in _PROFILED.items():
        for i, (c, kind) in enumerate(columns.items(), 1):
            if c == "n_gap":
                source = "CASE WHEN n_nationkey % 5 = 0 THEN 'a' WHEN n_nationkey % 5 = 1 THEN 'b' END"
            else:
                source = f"CAST({c} AS {kind})" if kind else c
            inner = f"(WITH p AS (SELECT CAST({source} AS VARCHAR) AS v FROM {t}) {one.format(t=t, c=c, i=i)})"
            parts.append(f"SELECT * FROM {inner}")
    return "\nUNION ALL\n".join(parts)


def _profiled_frames(spark, sf_dir) -> dict[str, DataFrame]:
    frames = {}
    for name, columns in _PROFILED.items():
        df = table(spark, sf_dir, name)
        if name == "nation":
            key = F.col("n_nationkey") % 5
            df = df.withColumn("n_gap", F.when(key == 0, "a").when(key == 1, "b"))
        frames[name] = df.select(*[F.col(c).cast(k).alias(c) if k else F.col(c) for c, k in columns.items()])
    return frames


@query("column_profile", _profile_sql())
def column_profile(spark, sf_dir):
    done = profile.profile(spark, _profiled_frames(spark, sf_dir))
    return done.select(
        "table_name", "column_name", "table_rows", "count_not_nulls", "count_nulls",
        F.round("pct_not_null", 6).alias("pct_not_null"), "count_distinct_values",
        F.round("pct_unique", 6).alias("pct_unique"),
        "is_recommended_not_nullable_column", "is_recommended_unique_column",
        F.col("_min_value").alias("min_value"), F.col("_max_value").alias("max_value"),
        F.round("_avg_value", 4).alias("avg_value"), F.col("_most_frequent_value").alias("most_frequent_value"),
        F.col("_min_length").alias("min_length"), F.col("_max_length").alias("max_length"),
        F.col("_avr_length").alias("avr_length"), "ordinal_position",
    )


_APPROX_SQL = f"""
SELECT table_name, column_name, table_rows, count_not_nulls, count_nulls, min_value, max_value, avg_value, min_length, max_length,
  avr_length, ordinal_position, TRUE AS distinct_within, TRUE AS frequent_within, TRUE AS quartiles_within
FROM ({_profile_sql()})
"""


@query("column_profile_approx", _APPROX_SQL)
def column_profile_approx(spark, sf_dir):
    """The profile from merged sketches of two parts of each table, and whether it keeps its bounds (4 standard errors)."""
    frames = _profiled_frames(spark, sf_dir)
    parts = [
        profile.profile_sketches(spark, {n: df.filter((F.xxhash64(*df.columns) < 0) == one) for n, df in frames.items()})
        for one in (True, False)
    ]
    done = profile.profile_from_sketches(profile.merge_sketches(parts))
    counted = [
        profile.unpivot(df, 1).groupBy("column_number", "column_value").count().select(F.lit(n).alias("of"), "*") for n, df in frames.items()]
    cells = reduce(DataFrame.unionByName, counted).filter("column_value IS NOT NULL")
    here = (F.col("of") == F.col("table_name")) & (F.col("column_number") == F.col("ordinal_position"))
    number = F.col("column_value").try_cast("double")
    numbers = F.sum(F.when(number.isNotNull(), F.col("count")))

    def rank_fits(i: int, share: float) -> Column:
        """Whether the wanted share lies between that of smaller numbers and that of numbers up to the quartile."""
        edge, n = F.col("_quartiles")[i], F.col("count")
        below, up_to = F.sum(F.when(number < edge, n).otherwise(0)), F.sum(F.when(number <= edge, n).otherwise(0))
        return (below / numbers <= share + profile.RANK_ERROR) & (up_to / numbers >= share - profile.RANK_ERROR)

    exact = cells.join(F.broadcast(done.select("table_name", "ordinal_position", "_quartiles", "_most_frequent_value")), here)
    checks = exact.groupBy("table_name", "ordinal_position").agg(
        F.count(F.lit(1)).alias("values"), F.max("count").alias("most"),
        F.max(F.when(F.col("column_value") == F.col("_most_frequent_value"), F.col("count"))).alias("named"),
        F.coalesce(rank_fits(0, 0.25) & rank_fits(1, 0.5) & rank_fits(2, 0.75), numbers.isNull()).alias("quartiles_within"))
    slack = profile.FREQUENT_ERROR * F.col("table_rows")
    return done.join(checks, ["table_name", "ordinal_position"]).select(
        "table_name", "column_name", "table_rows", "count_not_nulls", "count_nulls", F.col("_min_value").alias("min_value"),
        F.col("_max_value").alias("max_value"), F.round("_avg_value", 4).alias("avg_value"), F.col("_min_length").alias("min_length"),
        F.col("_max_length").alias("max_length"), F.col("_avr_length").alias("avr_length"), "ordinal_position",
        (F.abs(F.col("count_distinct_values") - F.col("values")) <= F.greatest(F.lit(0.5), 4 * profile.DISTINCT_ERROR * F.col("values"))).alias("distinct_within"),
        (F.col("most") - F.coalesce("named", F.lit(0)) <= slack).alias("frequent_within"), "quartiles_within")


_NODE_SQL = """
WITH nodes AS (
  SELECT p_partkey, 'ventes_' || lower(p_type) || CASE p_partkey % 4 WHEN 0 THEN '_definition' WHEN 1 THEN '_sample_x'
           WHEN 2 THEN '_indicators' ELSE '' END AS name,
         p_partkey % 5 = 0 AS dict, p_partkey % 7 = 0 AS enr FROM part
), flagged AS (
  SELECT p_partkey, name, CAST(p_partkey % 4 = 0 AS INTEGER) AS definition, CAST(dict AS INTEGER) AS dictionary,
    CAST(p_partkey % 4 = 1 AS INTEGER) AS sample, CAST(enr AS INTEGER) AS enriched,
    CAST(p_partkey % 4 = 2 AS INTEGER) AS indicators,
    CASE WHEN p_partkey % 4 IN (0, 1) OR enr THEN split_part(name, '_', 2) END AS type
  FROM nodes
)
"""


def _nodes(spark, sf_dir) -> DataFrame:
    key = F.col("p_partkey")
    suffix = _cases(key % 4, ["_definition", "_sample_x", "_indicators", ""])
    tags = F.array_compact(F.array(F.when(key % 5 == 0, "dictionary"), F.when(key % 7 == 0, "enriched")))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("ventes_"), F.lower("p_type"), suffix).alias("name"), tags.alias("tags"),
        text(key).alias("node_json"),
    )


@query("meta_indicators", _NODE_SQL + """
SELECT CAST(p_partkey AS VARCHAR) AS node_json, name, 'ventes' AS use_case, type, definition, dictionary,
       0 AS normalization, sample, 0 AS expected, 0 AS unification, enriched, indicators FROM flagged
""")
def meta_indicators(spark, sf_dir):
    return meta.node_indicators(_nodes(spark, sf_dir), "ventes")


@query("meta_indicators_by_type", _NODE_SQL + """
SELECT 'ventes' AS use_case, type, CAST(sum(definition) AS BIGINT) AS definition, CAST(sum(dictionary) AS BIGINT) AS dictionary,
       CAST(0 AS BIGINT) AS normalization, CAST(sum(sample) AS BIGINT) AS sample, CAST(0 AS BIGINT) AS expected,
       CAST(0 AS BIGINT) AS unification, CAST(sum(enriched) AS BIGINT) AS enriched, CAST(sum(indicators) AS BIGINT) AS indicators
FROM flagged GROUP BY type
""")
def meta_indicators_by_type(spark, sf_dir):
    return meta.node_indicators_by_type(meta.node_indicators(_nodes(spark, sf_dir), "ventes"))


# --- spatial ------------------------------------------------------------------------------


@query("geo_reproject", """
WITH p AS (SELECT c_custkey, -5 + (c_custkey * 37 % 1400) / 100.0 AS lon, 41 + (c_custkey * 53 % 1000) / 100.0 AS lat FROM customer),
k AS (SELECT 0.0818191910428158 AS e, 0.7256077650532670 AS n, 11754255.426096 AS c, 12655612.049876 AS ys),
m AS (SELECT p.*, k.*, radians(lat) AS f FROM p, k),
r AS (SELECT *, c * exp(-n * ln(tan(pi() / 4 + f / 2) * power((1 - e * sin(f)) / (1 + e * sin(f)), e / 2))) AS rad,
             n * radians(lon - 3) AS g FROM m)
SELECT c_custkey, round(700000 + rad * sin(g), 2) AS x, round(ys - rad * cos(g), 2) AS y,
       round(lon, 6) AS lon, round(lat, 6) AS lat
FROM r
""")
def geo_reproject(spark, sf_dir):
    key = F.col("c_custkey")
    places = table(spark, sf_dir, "customer").select(
        "c_custkey", G.point(-5 + (key * 37 % 1400) / 100, 41 + (key * 53 % 1000) / 100, 4326).alias("geometry")
    )
    there = conform.reproject(places, "geometry", 2154)
    back = conform.reproject(there.withColumn("back", F.col("geometry")), "back", 4326)
    here, home = F.col("geometry.parts")[0][0][0], F.col("back.parts")[0][0][0]
    return back.select(
        "c_custkey", F.round(here["x"], 2).alias("x"), F.round(here["y"], 2).alias("y"),
        F.round(home["x"], 6).alias("lon"), F.round(home["y"], 6).alias("lat"),
    )


# An L of two arms per supplier; every tenth is four times as large, so areas overlap.
_AREA_SQL = """
areas AS (
  SELECT s_suppkey, s_nationkey, (s_suppkey % 40) * 1.5 AS x, (s_suppkey // 40) * 1.5 AS y,
         CASE WHEN s_suppkey % 10 = 0 THEN 4.0 ELSE 1.0 END AS k FROM supplier
)"""


def _areas(spark, sf_dir) -> DataFrame:
    key = F.col("s_suppkey")
    x, y = key % 40 * 1.5, F.floor(key / 40) * 1.5
    k = F.when(key % 10 == 0, 4.0).otherwise(1.0)
    corners = [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]
    ring = F.concat_ws(",", *[F.concat_ws(" ", text(x + k * a), text(y + k * b)) for a, b in corners])
    rows = table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("com_code"), F.col("s_name").alias("com_name"),
        text("s_nationkey").alias("reg_code"), text("s_nationkey").alias("data_owner_id"),
        F.concat(F.lit("POLYGON(("), ring, F.lit("))")).alias("geometry"),
    )
    return conform.parse_geometry(rows, "geometry", "wkt", 2154)


def _order_points(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("id"), F.col("o_orderdate").alias("last_changed"),
        G.point(key * 7 % 241 / 4, key * 11 % 37 / 4, 2154).alias("geometry"),
    )


_LINK_SQL = f"""
WITH {_AREA_SQL},
points AS (SELECT o_orderkey, o_orderdate, (o_orderkey * 7 % 241) / 4.0 AS px, (o_orderkey * 11 % 37) / 4.0 AS py FROM orders),
links AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(s_suppkey AS VARCHAR) AS com_code, CAST(s_nationkey AS VARCHAR) AS reg_code,
         o_orderdate
  FROM points JOIN areas ON (px > x AND px < x + 2 * k AND py > y AND py < y + k)
                         OR (px > x AND px < x + k AND py > y AND py < y + 2 * k)
)
"""


@query("commune_link", _LINK_SQL + """
SELECT id, com_code, reg_code, strftime(o_orderdate, '%Y-%m-%d') AS changed FROM links
""")
def commune_link(spark, sf_dir):
    links = link.link_within(
        _order_points(spark, sf_dir), _areas(spark, sf_dir), "id", "geometry", carry=("com_name", "reg_code"), shapes=False
    )
    return links.select("id", "com_code", "reg_code",
                        F.date_format(link.MARK_COLUMN, "yyyy-MM-dd").alias("changed"))


@query("commune_link_incremental", _LINK_SQL + """
SELECT id, com_code, strftime(o_orderdate, '%Y-%m-%d') AS changed FROM links
UNION ALL
SELECT 'INCREMENTAL_MARKER_DUMMY', 'INCREMENTAL_MARKER_DUMMY', strftime(max(o_orderdate), '%Y-%m-%d') FROM orders
""")
def commune_link_incremental(spark, sf_dir):
    """Links of a first run over older objects, brought up to date by a second one."""
    points, areas, path = _order_points(spark, sf_dir), _areas(spark, sf_dir), shared_dir(spark, "links")
    options = {"carry": ("com_name", "reg_code"), "shapes": False}
    models.commune_links(points.filter("last_changed < timestamp_ntz'1998-06-01'"), areas, path, "id", **options)
    done = models.commune_links(points, areas, path, "id", **options)
    return done.select("id", "com_code", F.date_format(link.MARK_COLUMN, "yyyy-MM-dd").alias("changed"))


@query("shape_link", f"""
WITH {_AREA_SQL},
lines AS (SELECT c_custkey, (c_custkey * 7 % 241) / 4.0 AS px, (c_custkey * 11 % 37) / 4.0 AS py FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(s_suppkey AS VARCHAR) AS com_code
FROM lines JOIN areas ON py >= y AND (
     (px > x AND px < x + k AND py + 0.5 <= y + 2 * k)
  OR (px = x + k AND py < y + k AND py + 0.5 <= y + 2 * k)
  OR (px > x + k AND px < x + 2 * k AND py + 0.5 <= y + k))
""")
def shape_link(spark, sf_dir):
    """Upright lines of half a unit within an area: they may touch its boundary but not follow it."""
    key = F.col("c_custkey")
    x, y = key * 7 % 241 / 4, key * 11 % 37 / 4
    wkt = F.format_string("LINESTRING(%s %s,%s %s)", text(x), text(y), text(x), text(y + 0.5))
    rows = table(spark, sf_dir, "customer").select(
        text(key).alias("id"), F.lit(None).cast("timestamp_ntz").alias("last_changed"), wkt.alias("geometry")
    )
    lines = conform.parse_geometry(rows, "geometry", "wkt", 2154)
    return link.link_within(lines, _areas(spark, sf_dir), "id", "geometry", carry=()).select("id", "com_code")


_HOLES_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(s_suppkey AS VARCHAR) AS com_code
FROM (SELECT c_custkey, c_custkey * 7 % 241 / 4.0 AS x1, c_custkey * 11 % 49 / 4.0 AS y1,
             c_custkey * 7 % 241 / 4.0 + (1 + c_custkey % 5) / 2.0 AS x2, c_custkey * 11 % 49 / 4.0 + (1 + c_custkey % 5) / 4.0 AS y2 FROM customer) s
JOIN (SELECT s_suppkey, s_suppkey % 40 * 1.5 AS x, s_suppkey // 40 * 1.5 AS y FROM supplier) a
  ON (x1 >= x AND x2 <= x + 3 AND y1 >= y AND y2 <= y + 3 AND (x2 <= x + 0.6 OR x1 >= x + 2.4 OR y2 <= y + 1.1 OR y1 >= y + 1.9))
  OR (x1 >= x + 3.5 AND x2 <= x + 4.5 AND y1 >= y AND y2 <= y + 1)
"""


@query("shape_link_holes", _HOLES_SQL)
def shape_link_holes(spark, sf_dir):
    """Rectangles within areas of two parts, the larger of which has a hole that rectangles cut and enclose."""
    key = F.col("c_custkey")
    area = F.col("s_suppkey")

    def box(x: Column, y: Column, w: Column | float, h: Column | float) -> Column:
        corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
        return F.concat(F.lit("("), F.concat_ws(",", *[F.concat_ws(" ", text(a), text(b)) for a, b in corners]), F.lit(")"))

    left, low = area % 40 * 1.5, F.floor(area / 40) * 1.5
    shape = F.concat(F.lit("MULTIPOLYGON(("), box(left, low, 3.0, 3.0), F.lit(","), box(F.round(left + 0.6, 1), F.round(low + 1.1, 1), 1.8, 0.8), F.lit("),("),
                     box(left + 3.5, low, 1.0, 1.0), F.lit("))"))
    areas = conform.parse_geometry(table(spark, sf_dir, "supplier").select(text(area).alias("com_code"), shape.alias("geometry")), "geometry", "wkt", 2154)
    rectangle = F.concat(F.lit("POLYGON("), box(key * 7 % 241 / 4, key * 11 % 49 / 4, (1 + key % 5) / 2, (1 + key % 5) / 4), F.lit(")"))
    rows = table(spark, sf_dir, "customer").select(text(key).alias("id"), F.lit(None).cast("timestamp_ntz").alias("last_changed"), rectangle.alias("geometry"))
    shapes = conform.parse_geometry(rows, "geometry", "wkt", 2154)
    return link.link_within(shapes, areas, "id", "geometry", carry=()).select("id", "com_code")


@query("perimeter_owner", _LINK_SQL + """
SELECT id, reg_code AS perimetre_data_owner_id FROM links
""")
def perimeter_owner(spark, sf_dir):
    perimeters = _areas(spark, sf_dir).withColumnRenamed("geometry", "geom")
    points = _order_points(spark, sf_dir).drop("last_changed")
    return link.tag_perimeter_owner(points, perimeters, "id", shapes=False)


@query("geometry_text", f"""
WITH {_AREA_SQL}
SELECT CAST(s_suppkey AS VARCHAR) AS com_code,
  'POLYGON((' || printf('%g %g,%g %g,%g %g,%g %g,%g %g,%g %g,%g %g', x, y, x + 2 * k, y, x + 2 * k, y + k, x + k, y + k,
     x + k, y + 2 * k, x, y + 2 * k, x, y) || '))' AS wkt,
  '{{"type":"Polygon","coordinates":[[' || printf('[%g,%g],[%g,%g],[%g,%g],[%g,%g],[%g,%g],[%g,%g],[%g,%g]', x, y, x + 2 * k, y,
     x + 2 * k, y + k, x + k, y + k, x + k, y + 2 * k, x, y + 2 * k, x, y) || ']]}}' AS geojson
FROM (SELECT s_suppkey, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(k AS DOUBLE) AS k FROM areas)
""")
def geometry_text(spark, sf_dir):
    areas = _areas(spark, sf_dir).select("com_code", F.col("geometry").alias("wkt"), F.col("geometry").alias("geojson"))
    return conform.render_geometry(conform.render_geometry(areas, "wkt", "wkt"), "geojson", "geojson")


def _communes(spark, sf_dir) -> DataFrame:
    """Customers as communes of their nation and region."""
    key = F.col("c_custkey")
    lon, lat = -5 + (key * 37 % 1400) / 100, 41 + (key * 53 % 1000) / 100
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text(key).alias("com_code"), F.col("c_name").alias("com_name"),
        text("n_nationkey").alias("dep_code"), F.col("n_name").alias("dep_name"),
        text("r_regionkey").alias("reg_code"), F.col("r_name").alias("reg_name"),
        (key % 2 == 0).alias("com_in_ctu"), F.when(key % 3 != 0, F.col("c_mktsegment")).alias("com_type"),
        F.array(lat, lon).alias("geo_point_2d"), G.point(lon, lat, 4326).alias("geometry"),
    )


@query("commune_enrich", """
WITH pop AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1),
     demo AS (SELECT s_suppkey, round(s_acctbal, 2) AS d FROM supplier)
SELECT CAST(c_custkey AS VARCHAR) AS com_code, n_name AS dep_name, n AS population_2019, d AS population_2014,
       round(-5 + (c_custkey * 37 % 1400) / 100.0, 6) AS lon, 2154 AS srid
FROM customer JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN pop ON o_custkey = c_custkey LEFT JOIN demo ON s_suppkey = c_custkey
""")
def commune_enrich(spark, sf_dir):
    population = models.population_typed(
        table(spark, sf_dir, "orders").filter("o_custkey % 3 <> 0").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
        .select(text("o_custkey").alias("Code"), text("n").alias("Population municipale 2019"))
    )
    demography = models.demography_typed(
        table(spark, sf_dir, "supplier").select(text("s_suppkey").alias("CODGEO"), text("s_acctbal").alias("Population"))
    )
    done = models.communes_enriched(_communes(spark, sf_dir), population, demography)
    return done.select(
        "com_code", "dep_name", F.col("Population municipale 2019").cast("double").alias("population_2019"),
        F.round(F.col("Population").cast("double"), 2).alias("population_2014"),
        F.round(F.col("geometry_center.parts")[0][0][0]["x"], 6).alias("lon"), F.col("geometry_center_2154.srid").alias("srid"),
    )


@query("perimeters_parsed", f"""
WITH {_AREA_SQL}
SELECT 'commun.apcom_raw_perimetre_' || s_suppkey % 3 AS import_table, 'o' || s_suppkey % 3 AS data_owner_id, 2154 AS srid,
       'POLYGON((' || printf('%g %g,%g %g,%g %g,%g %g,%g %g,%g %g,%g %g', x, y, x + 2 * k, y, x + 2 * k, y + k, x + k, y + k,
       x + k, y + 2 * k, x, y + 2 * k, x, y) || '))' AS geom
FROM (SELECT s_suppkey, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(k AS DOUBLE) AS k FROM areas)
""")
def perimeters_parsed(spark, sf_dir):
    """Outlines of three owners, each under another column name."""
    rows = conform.render_geometry(_areas(spark, sf_dir), "geometry", "wkt").withColumn(
        "owner", F.col("com_code").cast("long") % 3)
    columns = ("geom", "Geom", "geometrie")
    frames = {
        f"commun.apcom_raw_perimetre_{i}": rows.filter(F.col("owner") == i).select(F.col("geometry").alias(name), "com_name")
        for i, name in enumerate(columns)
    }
    at = F.lit("2022-01-01T00:00:00")
    known = rows.groupBy("owner").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("apcom").alias("CAS_USAGE"), F.lit("perimetre").alias("ROLE"), F.lit("perimetre").alias("SOURCE_NOM"),
        F.lit("prod").alias("TARGET"), F.lit("success").alias("status"), F.lit("commun").alias("schema"),
        F.concat(F.lit("apcom_raw_perimetre_"), text("owner")).alias("table"), F.lit("apcom").alias("use_case_prefix"),
        F.concat(F.lit("o"), text("owner")).alias("data_owner_id"), F.lit("Org").alias("org_name"),
        at.alias("last_changed"), at.alias("added"), at.alias("removed"), at.alias("imported"),
    )
    done = models.perimeters_parsed(spark, known, FrameTables(frames), "apcom")
    return done.select("import_table", "data_owner_id", F.col("geom.srid").alias("srid"), G.to_wkt(F.col("geom")).alias("geom"))


@query("regions_standard", """
SELECT CAST(c_custkey AS VARCHAR) AS reg_code, c_custkey % 4 = 0 AS renewed,
       round(-5 + (c_custkey * 37 % 1400) / 100.0, 6) AS lon, 4326 AS srid, 2154 AS shape_srid FROM customer
""")
def regions_standard(spark, sf_dir):
    """Regions stored with their centre and shape, a quarter of them renewed by a second run."""
    rows = _communes(spark, sf_dir).select(
        F.col("com_code").alias("reg_code"), "geo_point_2d", "geometry", F.lit(False).alias("renewed"),
        F.to_timestamp_ntz(F.lit("2021-01-01 00:00:00")).alias("last_changed"))
    newer = rows.filter(F.col("reg_code").cast("long") % 4 == 0).withColumns(
        {"renewed": F.lit(True), "last_changed": F.to_timestamp_ntz(F.lit("2022-01-01 00:00:00"))})
    path = shared_dir(spark, "regions")
    models.regions_standard(rows, path)
    done = models.regions_standard(newer, path)
    return done.select(
        "reg_code", "renewed", F.round(F.col("geometry_center.parts")[0][0][0]["x"], 6).alias("lon"),
        F.col("geometry_center.srid").alias("srid"), F.col("geometry_shape_2154.srid").alias("shape_srid"))


@query("population_stored", """
SELECT CAST(c_custkey AS VARCHAR) AS code, CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 100000 ELSE c_custkey % 5000 END AS DOUBLE) AS population FROM customer
""")
def population_stored(spark, sf_dir):
    """Population by commune code, of which a third is renewed by a second run."""
    key = F.col("c_custkey")

    def counted(people: Column, at: str) -> DataFrame:
        rows = table(spark, sf_dir, "customer").select(
            key, text(key).alias(models.POPULATION_KEY), text(people).alias(models.POPULATION), F.to_timestamp_ntz(F.lit(at)).alias("last_changed"))
        return rows

    path = shared_dir(spark, "population")
    models.population_standard(models.population_typed(counted(key % 5000, "2021-01-01 00:00:00").drop("c_custkey")), path)
    newer = counted(key + 100000, "2022-01-01 00:00:00").filter("c_custkey % 3 = 0").drop("c_custkey")
    done = models.population_standard(models.population_typed(newer), path)
    return done.select(F.col(models.POPULATION_KEY).alias("code"), F.col(f"`{models.POPULATION}`").cast("double").alias("population"))


@query("perimeters", """
WITH newer AS (SELECT * FROM supplier WHERE s_suppkey % 5 = 0)
SELECT CAST(s_nationkey AS VARCHAR) AS data_owner_id, s_name AS name, 'apcom' AS use_case FROM newer
UNION ALL
SELECT CAST(s_nationkey AS VARCHAR), s_name, 'apcom' FROM supplier
WHERE s_suppkey % 5 <> 0 AND s_nationkey NOT IN (SELECT s_nationkey FROM newer)
""")
def perimeters(spark, sf_dir):
    """Owners that send newer outlines get all their outlines replaced."""
    rows = _areas(spark, sf_dir).select(
        "data_owner_id", F.col("com_name").alias("name"), F.col("geometry").alias("geom"), F.lit("apcom").alias("CAS_USAGE"),
        F.when(F.col("com_code").cast("long") % 5 == 0, F.to_timestamp_ntz(F.lit("2022-02-02 00:00:00")))
        .otherwise(F.to_timestamp_ntz(F.lit("2021-01-01 00:00:00"))).alias("last_changed"),
    )
    path = shared_dir(spark, "perimeters")
    models.perimeters_standard(rows.filter("last_changed < timestamp_ntz'2022-01-01'"), path)
    done = models.perimeters_standard(rows, path)
    return done.select("data_owner_id", "name", F.col("CAS_USAGE").alias("use_case"))


# --- publication --------------------------------------------------------------------------


@query("csv_projection", """
SELECT CAST(event_id AS BIGINT) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, event_type, props, round(value, 6) AS value,
       CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS paire,
       '[' || event_id || ',' || user_id || ']' AS liste,
       'POINT(' || (event_id % 100) || ' ' || (event_id % 50) || '.5)' AS geom
FROM events
""")
def csv_projection(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("evt_id"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("evt_ts"),
        F.col("event_type").alias("evt_event__type"), "props", F.round("value", 6).alias("value"),
        (F.col("event_id") % 2 == 0).alias("paire"), F.array("event_id", "user_id").alias("liste"),
        G.point(F.col("event_id") % 100, F.col("event_id") % 50 + 0.5, 2154).alias("geom"),
    )
    frame = publish.to_csv_frame(publish.drop_prefix(events, "evt"), wkt=True)
    return frame.withColumnRenamed("event__type", "event_type")


def _order_lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("publish_manifest", """
SELECT 'commandes' AS relation, o_orderstatus AS "partition", count(*) AS rows, CAST(sum(o_orderkey) AS VARCHAR) AS checksum,
       'Données normalisées' AS title, TRUE AS private,
       CASE o_orderstatus WHEN 'F' THEN 'skip' WHEN 'O' THEN 'update' ELSE 'create' END AS action
FROM orders GROUP BY o_orderstatus
""")
def publish_manifest(spark, sf_dir):
    lines = _order_lines(spark, sf_dir)
    before = lines.filter("o_orderstatus = 'F' or (o_orderstatus = 'O' and o_orderkey % 3 = 0)")
    previous = publish.build_manifest(before, "commandes", "o_orderstatus", checksum=F.col("o_orderkey"))
    now = publish.build_manifest(lines, "commandes", "o_orderstatus", previous, checksum=F.col("o_orderkey"))
    return now.select("relation", "partition", "rows", "checksum", "title", "private", "action")


@query("publish_csv", """
SELECT o_orderkey, o_orderpriority, o_orderstatus AS "partition" FROM orders
""")
def publish_csv(spark, sf_dir):
    """Two runs, the second of which writes only what changed, read back from the files."""
    lines, path = _order_lines(spark, sf_dir), shared_dir(spark, "csv")
    publish.publish(lines.filter("o_orderstatus = 'F' or o_orderkey % 3 = 0"), path, "commandes", "o_orderstatus")
    publish.publish(lines, path, "commandes", "o_orderstatus")
    done = spark.read.csv(path, header=True).filter("resource_name = 'commandes'")
    return done.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority", "partition")


@query("publish_conflict", """
WITH runs AS (
  SELECT 0 AS run, 'commandes' AS resource_name, 'create' AS action, o_orderstatus AS "partition", count(*) AS rows FROM orders GROUP BY ALL
  UNION ALL
  SELECT 1, 'commandes', CASE o_orderstatus WHEN 'F' THEN 'skip' WHEN 'O' THEN 'update' ELSE 'delete' END, o_orderstatus,
         count(*) FILTER (WHERE o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderkey % 3 = 0)) FROM orders GROUP BY ALL
  UNION ALL
  SELECT 2, '2024-01-01_commandes', 'create', o_orderstatus, count(*) FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)
SELECT run, resource_name, action, "partition", rows FROM runs
UNION ALL
SELECT run, resource_name, 'published', "partition", rows FROM runs WHERE run = 2 OR (run = 1 AND action <> 'delete')
""")
def publish_conflict(spark, sf_dir):
    """Three runs: all orders; one status less and another one changed; more columns. Then what lies in the files."""
    lines, path = _order_lines(spark, sf_dir), shared_dir(spark, "conflict")
    fewer = lines.filter("o_orderstatus = 'F' or (o_orderstatus = 'O' and o_orderkey % 3 = 0)")
    wider = lines.filter("o_orderstatus <> 'P'").withColumn("urgent", F.col("o_orderpriority") == "1-URGENT")
    publish.publish(lines, path, "commandes", "o_orderstatus")
    publish.publish(fewer, path, "commandes", "o_orderstatus")
    publish.publish(wider, path, "commandes", "o_orderstatus", stamp="2024-01-01")
    columns = ["resource_name", "action", "partition", "rows"]
    noted = spark.read.parquet(f"{path}/_manifest/commandes").select("run", *columns)
    found = spark.read.csv(path, header=True).groupBy("resource_name", "partition").agg(F.count(F.lit(1)).alias("rows"))
    run = F.when(F.col("resource_name") == "commandes", 1).otherwise(2)
    return noted.union(found.withColumns({"run": run, "action": F.lit("published")}).select("run", *columns))


@query("jsonld_entities", """
SELECT 'urn:commune:' || c_custkey AS id, 'Commune' AS type, 'Point' AS location_type, CAST(n_nationkey AS VARCHAR) AS dep_code,
       n_name AS dep_name, r_name AS reg_name, c_name AS com_name,
       CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE '' END AS com_in_ctu,
       CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE '' END AS com_type, CAST(NULL AS VARCHAR) AS loose_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def jsonld_entities(spark, sf_dir):
    entities = jsonld.to_jsonld(
        _communes(spark, sf_dir).drop("geo_point_2d"), "Commune", "urn:commune:", "http://context/commune.jsonld"
    )
    lines = jsonld.to_json_lines(entities)
    paths = {
        "id": "$.id", "type": "$.type", "location_type": "$.location.value.type", "dep_code": "$.dep_code.value",
        "dep_name": "$.dep_code.dep_name.value", "reg_name": "$.reg_code.reg_name.value", "com_name": "$.com_name.value",
        "com_in_ctu": "$.com_in_ctu.value", "com_type": "$.com_type.value", "loose_name": "$.dep_name.value",
    }
    return lines.select(*[F.get_json_object("value", p).alias(n) for n, p in paths.items()])


# --- files --------------------------------------------------------------------------------


@query("delimited_files", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'Été;' || c_name AS nom, c_mktsegment AS segment FROM customer
""")
def delimited_files(spark, sf_dir):
    """One resource as UTF-8 and Latin-1 files with a quoted separator in its values."""
    rows = table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("id"), F.concat(F.lit("Été;"), "c_name").alias("nom"), F.col("c_mktsegment").alias("segment")
    )
    path = shared_dir(spark, "delimited")
    for folder, encoding, rest in (("a", "UTF-8", 0), ("b", "ISO-8859-1", 1)):
        rows.filter(F.col("id").cast("long") % 2 == rest).write.csv(
            f"{path}/{folder}", header=True, sep=";", encoding=encoding
        )
    return files.read_delimited(spark, [f"{path}/a", f"{path}/b"])


@query("geojson_files", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nom, round(CAST(c_custkey % 90 AS DOUBLE), 6) AS x FROM customer
""")
def geojson_files(spark, sf_dir):
    place = G.to_geojson(G.point(F.col("c_custkey") % 90, F.lit(45.5), 4326))
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("nom"))),
        F.lit(',"geometry":'), place, F.lit("},"),
    )
    path = shared_dir(spark, "geojson")
    table(spark, sf_dir, "customer").select(feature.alias("value")).write.text(path)
    done = files.read_geojson(spark, path)
    return done.select("id", "nom", F.round(F.col("geometry.parts")[0][0][0]["x"], 6).alias("x"))


@query("delimited_breaks", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'Un "mot"' || chr(10) || 'puis; ' || c_name AS nom, c_mktsegment AS segment FROM customer
""")
def delimited_breaks(spark, sf_dir):
    """Values with line breaks, quotes and separators in quotes, in files that are read as they need to be."""
    nom = F.concat(F.lit('Un "mot"\npuis; '), "c_name")
    rows = table(spark, sf_dir, "customer").select(text("c_custkey").alias("id"), nom.alias("nom"), F.col("c_mktsegment").alias("segment"))
    path = shared_dir(spark, "breaks")
    rows.write.csv(path, header=True, sep=";", escape='"')
    return files.read_delimited(spark, path)


@query("delimited_texts", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS text, source FROM documents
""")
def delimited_texts(spark, sf_dir):
    """Whole documents as values of delimited text: most lines are inside quotes."""
    path = shared_dir(spark, "texts")
    rows = table(spark, sf_dir, "documents").select(text("doc_id").alias("doc_id"), "text", "source")
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.read_delimited(spark, path)


def _collections(features: DataFrame, by: str, path: str, gap: str = " ", head: Column | None = None, tail: Column | None = None) -> None:
    """One collection for each value of a column: the features, commas between them, under a head and over a tail."""
    head = F.lit('{"type": "FeatureCollection", "features": [') if head is None else head
    tail = F.lit('], "name": "all"}') if tail is None else tail
    # Head and tail go with the first and the last feature, in the task that the window gives them: no union of plans that
    # Spark takes for partitioned alike, and reads in different partitions.
    order = Window.partitionBy(by).orderBy("id")
    rows = features.withColumns({"place": F.row_number().over(order), "end": F.lead(F.lit(True)).over(order).isNull()})
    first, last = F.col("place") == 1, F.col("end")
    feature = F.concat(F.when(first, "").otherwise(", "), "feature")
    value = F.concat_ws(gap, F.when(first, head), feature, F.when(last, tail))
    rows = rows.select(by, "place", value.alias("value")).filter("value <> ''").sortWithinPartitions(by, "place")
    rows.select(by, "value").write.partitionBy(by).option("lineSep", gap).text(path)


def _customer_features(spark, sf_dir, pretty: bool = False) -> DataFrame:
    x = (F.col("c_custkey") % 90).cast("double")
    ring = F.array(*[F.array(x + dx, F.lit(y)) for dx, y in ((0, 40.0), (1, 40.0), (0, 41.0), (0, 40.0))])
    names = F.struct(text("c_custkey").alias("id"), F.concat(F.lit('"Été", {'), "c_name").alias("nom"))
    feature = F.struct(
        F.lit("Feature").alias("type"), names.alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    options = {"pretty": "true"} if pretty else {}
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment", F.to_json(feature, options).alias("feature"))


_COLLECTION_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, '"Été", {' || c_name AS nom,
       'POLYGON((' || x || ' 40,' || (x + 1) || ' 40,' || x || ' 41,' || x || ' 40))' AS wkt
FROM (SELECT *, c_custkey % 90 AS x FROM customer)
"""


@query("geojson_collection", _COLLECTION_SQL)
def geojson_collection(spark, sf_dir):
    """A collection on one line for each nation, cut at its features."""
    path = shared_dir(spark, "collection")
    _collections(_customer_features(spark, sf_dir), "c_nationkey", path)
    return files.read_geojson(spark, path).select("id", "nom", G.to_wkt(F.col("geometry")).alias("wkt"))


@query("geojson_pretty", _COLLECTION_SQL)
def geojson_pretty(spark, sf_dir):
    """A collection for each market segment, every member on a line of its own."""
    path = shared_dir(spark, "pretty")
    _collections(_customer_features(spark, sf_dir, pretty=True), "c_mktsegment", path, "\n")
    return files.read_geojson(spark, path).select("id", "nom", G.to_wkt(F.col("geometry")).alias("wkt"))


@query("import_bad_rows", """
SELECT c_mktsegment AS segment, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'insert' ELSE 'loaded' END AS outcome,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 0 ELSE CAST(count(*) AS BIGINT) END AS features,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 0 ELSE CAST(sum(c_custkey) AS BIGINT) END AS total
FROM customer GROUP BY c_mktsegment
""")
def import_bad_rows(spark, sf_dir):
    """Of the collections of five segments one breaks off, one holds a broken feature and one is an error page."""
    segment, path, raw = F.col("c_mktsegment"), shared_dir(spark, "bad"), shared_dir(spark, "raw")
    features = _customer_features(spark, sf_dir)
    broken = (segment == "BUILDING") & (F.col("id") == F.min("id").over(Window.partitionBy(segment)))
    features = features.withColumn("feature", F.when(broken, F.replace("feature", F.lit('"nom":'), F.lit('"nom":?'))).otherwise(F.col("feature")))
    features = features.withColumn("feature", F.when(segment == "FURNITURE", F.concat(F.lit("<p>"), text("id"), F.lit("</p>"))).otherwise(F.col("feature")))
    head = F.when(segment == "FURNITURE", "<html>").otherwise('{"type": "FeatureCollection", "features": [')
    _collections(features, "c_mktsegment", path, head=head, tail=F.when(segment != "AUTOMOBILE", "]}"))
    plan = features.select(segment.alias("resource_id")).distinct().select(
        "resource_id", F.lit("geojson").alias("format"), F.concat(F.lit(f"{path}/c_mktsegment="), "resource_id").alias("source_file_path"),
        F.lit("appuiscommuns").alias("schema"), F.lower("resource_id").alias("table"), F.lit("success").alias("status"), F.lit("import").alias("step"))
    outcomes = files.load_resources(spark, plan, raw)
    failed = outcomes.select("resource_id", F.col("step").alias("outcome"))
    stored = spark.read.parquet(f"{raw}/appuiscommuns/*").groupBy(F.upper(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)).alias("resource_id")).agg(
        F.count(F.lit(1)).alias("features"), F.sum(F.col("id").cast("long")).alias("total"))
    done = plan.select("resource_id").join(failed, "resource_id", "left").join(stored, "resource_id", "left")
    return done.select(
        F.col("resource_id").alias("segment"), F.coalesce("outcome", F.lit("loaded")).alias("outcome"),
        F.coalesce("features", F.lit(0)).cast("bigint").alias("features"), F.coalesce("total", F.lit(0)).cast("bigint").alias("total"))


@query("import_end_to_end", """
SELECT 'appuiscommuns.apcom_raw_commandes_' || lower(o_orderstatus) AS import_table, CAST(o_orderkey AS VARCHAR) AS numero,
       CAST(o_custkey AS VARCHAR) AS client, lower(o_orderstatus) AS data_owner_id FROM orders
UNION ALL
SELECT 'error', count(DISTINCT o_orderstatus) || '', 'unsupported format', NULL FROM orders
""")
def import_end_to_end(spark, sf_dir):
    """Files of three owners are catalogued, planned, loaded, reported and unioned."""
    orders, files_at, raw = table(spark, sf_dir, "orders"), shared_dir(spark, "files"), shared_dir(spark, "raw")
    statuses = ("F", "O", "P")
    for status in statuses:
        orders.filter(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").alias("numero"), F.col("o_custkey").alias("client")
        ).write.csv(f"{files_at}/{status}", header=True, sep=";")
    at = F.to_timestamp_ntz(F.lit("2022-01-01 00:00:00"))
    owner = F.col("o_orderstatus")
    known = orders.groupBy(owner).agg(F.count(F.lit(1)).alias("n"))
    resources = known.withColumn("format", F.explode(F.array(F.lit("csv"), F.lit("pdf")))).select(
        F.concat_ws("-", owner, "format").alias("id"), F.concat_ws(".", owner, "format").alias("name"), owner.alias("ds_id"),
        owner.alias("ds_name"), owner.alias("ds_title"), at.alias("ds_metadata_created"), at.alias("ds_metadata_modified"),
        F.lit(None).cast("timestamp_ntz").alias("last_modified"), owner.alias("org_id"), owner.alias("org_name"),
        owner.alias("org_title"), F.lit("a@b").alias("u_email"), F.concat(F.lit(f"{files_at}/"), owner).alias("url"),
        F.lit("apcom").alias("cas_usage"), F.lit("source").alias("role"),
        F.when(F.col("format") == "csv", "commandes").otherwise("autre").alias("source_nom"),
        F.lit(None).cast("string").alias("target"), owner.alias("siren"), "format",
    )
    state = spark.createDataFrame([], "resource_key string, timestamp string, status string")
    outcomes = files.load_resources(spark, imports.plan_imports(resources, state), raw)
    report = imports.plan_imports(resources, state, outcomes=outcomes)
    done = union.union_by_name(spark, report, ParquetTables(spark, raw), "commandes", "apcom")
    failed = report.filter("status = 'error'").agg(F.count(F.lit(1)).alias("n"), F.max("messages").alias("m"))
    return done.select("import_table", "numero", "client", "data_owner_id").unionByName(
        failed.select(F.lit("error").alias("import_table"), text("n").alias("numero"),
                      F.get_json_object("m", "$[0].text").alias("client"), F.lit(None).cast("string").alias("data_owner_id")))
