import datetime
import json

import pytest
from pyspark.sql import functions as F

from concordat.names import REPORT_TAIL, Names
from concordat.operators import catalog, imports, registry

N = Names("ABC_")
DAY = datetime.datetime(2022, 4, 21, 7, 22, 5)
CATALOG = (
    "id string, name string, ds_id string, ds_name string, ds_title string, ds_metadata_created timestamp_ntz, "
    "ds_metadata_modified timestamp_ntz, last_modified timestamp_ntz, org_id string, org_name string, org_title string, "
    "u_email string, url string, abc_cas_usage string, abc_role string, abc_source_nom string, abc_target string, "
    "abc_siren string, format string"
)


def resource(id, name="r.csv", use_case="apcom", role="source", source="osm", target=None, siren="123", fmt="CSV",
             modified=DAY, org="org-abcd"):
    return (id, name, f"d{id}", f"ds{id}", "T", DAY, modified, None, org, "la-ville-du-sud", "V", "m@x", f"/f/{id}",
            use_case, role, source, target, siren, fmt)


@pytest.fixture(scope="module")
def state(spark):
    key = lambda i, step: f"la-ville-du-sud/ds{i}/r.csv/{i}/{step}/prod"
    stamp = "2022-04-21T07:22:05"
    rows = [
        (key("unchanged", "download"), stamp, "success"), (key("unchanged", "insert"), stamp, "success"),
        (key("newer", "insert"), "2020-01-01T00:00:00", "success"), (key("failed", "download"), stamp, "too big"),
        (key("nodate", "insert"), None, "success"), (key("gone", "insert"), stamp, "success"),
    ]
    return spark.createDataFrame(rows, "resource_key string, timestamp string, status string")


@pytest.fixture(scope="module")
def report(spark, state):
    rows = [
        resource("valid", siren="S1"), resource("nocase", use_case="nope", siren="S2"),
        resource("blankrole", role=" ", siren="S3"), resource("kpi", role="kpi"),
        resource("inferred", name="mes_reparations_2022.csv", source=" ", siren="S4"),
        resource("nosource", source=None, siren="S5"), resource("archived", target="archive", siren="S6"),
        resource("nosiren", siren=" ", org="ORG-é"), resource("twin1", siren="S7"), resource("twin2", siren="S-7"),
        resource("unchanged", siren="S8"), resource("newer", siren="S9"), resource("nodate", siren="S10", modified=None),
        resource("pdf", fmt="pdf", siren="S11"), resource("failed", siren="S12"), resource("broken", siren="S13"),
        resource("byname", name="x.GeoJSON", fmt=None, siren="S14"), resource("unreachable", siren="S15"),
    ]
    outcomes = spark.createDataFrame(
        [("broken", "insert", 'bad "quote"'), ("unreachable", "download", "404")], "resource_id string, step string, error string")
    plan = imports.plan_imports(
        spark.createDataFrame(rows, CATALOG), state, outcomes=outcomes, run_start="2022-05-01T00:00:00", names=N)
    return {"plan": plan, "rows": {r.resource_id: r for r in plan.collect()}}


def test_report_columns(report):
    assert report["plan"].columns == [*N.fields, *REPORT_TAIL]
    assert len(report["plan"].columns) == 28
    assert "kpi" not in report["rows"]
    valid = report["rows"]["valid"]
    assert valid.removed == "2100-01-01T00:00:00" and valid.start == "2022-05-01T00:00:00"
    assert valid.last_changed == valid.added == "2022-04-21T07:22:05"


@pytest.mark.parametrize(
    "id, status, step, table, text",
    [
        ("valid", "success", "read_delimited", "apcom_raw_osm_s1", None),
        ("nocase", "error", "prepare", None, "undefined ABC_CAS_USAGE"),
        ("blankrole", "success", "read_delimited", "apcom_raw_osm_s3", None),
        ("inferred", "success", "read_delimited", "apcom_raw_reparations_s4", None),
        ("nosource", "error", "prepare", None, "missing ABC_SOURCE_NOM"),
        ("archived", "skipped", "prepare", None, "is archive so skipped import"),
        ("nosiren", "success", "read_delimited", "apcom_raw_osm_orgdusud", None),
        ("twin1", "success", "read_delimited", "apcom_raw_osm_s7", None),
        ("twin2", "error", "prepare", "apcom_raw_osm_s7", "schema and table duplicate appuiscommuns.apcom_raw_osm_s7"),
        ("unchanged", "success", "no change, skipped", "apcom_raw_osm_s8",
         "no change, already imported at 2022-04-21T07:22:05"),
        ("newer", "success", "read_delimited", "apcom_raw_osm_s9", None),
        ("nodate", "success", "read_delimited", "apcom_raw_osm_s10", None),
        ("pdf", "error", "prepare", "apcom_raw_osm_s11", "unsupported format"),
        ("failed", "error", "prepare", None, "while downloading, too big"),
        ("broken", "error", "read_delimited", "apcom_raw_osm_s13", "bad 'quote'"),
        ("byname", "success", "read_geojson", "apcom_raw_osm_s14", None),
        ("unreachable", "error", "prepare", None, "while downloading, 404"),
    ],
)
def test_outcome(report, id, status, step, table, text):
    row = report["rows"][id]
    assert (row.status, row.step, row.table) == (status, step, table)
    assert [m["text"] for m in json.loads(row.messages)] == ([text] if text else [])


def test_state_after_the_run(report, state):
    after = {r.resource_key: (r.timestamp, r.status) for r in imports.next_state(state, report["plan"], names=N).collect()}
    key = lambda i, step, name="r.csv": f"la-ville-du-sud/ds{i}/{name}/{i}/{step}/prod"
    stamp = "2022-04-21T07:22:05"
    assert after[key("valid", "insert")] == (stamp, "success")
    assert after[key("newer", "insert")] == (stamp, "success")
    assert after[key("unreachable", "download")] == (stamp, "404")
    assert after[key("gone", "insert")] == (stamp, "success")
    assert key("broken", "insert") not in after and key("archived", "download") not in after
    assert key("twin2", "insert") not in after


def test_known_state_is_not_changed(spark, state):
    rows = [resource("unchanged"), resource("newer"), resource("nodate", modified=None), resource("fresh")]
    df = spark.createDataFrame(rows, CATALOG).withColumn("last_changed", F.col("ds_metadata_modified"))
    got = {r.id: r.changed for r in imports.has_changed(df, state, "insert").collect()}
    assert got == {"unchanged": False, "newer": True, "nodate": True, "fresh": True}


def test_metrics_and_owners(spark):
    rows = [("success", "a", "A2", "apcom"), ("error", "a", "A1", "apcom"), ("skipped", "b", "B", "apcom"), (None, "b", "B", "x")]
    df = spark.createDataFrame(rows, "status string, data_owner_id string, org_name string, ABC_CAS_USAGE string")
    flags = [(r.success, r.skipped, r.error) for r in registry.import_status_metrics(df).collect()]
    assert flags == [(1, 0, 0), (0, 0, 1), (0, 1, 0), (0, 0, 0)]
    owners = sorted(map(tuple, registry.data_owners(df, "apcom", N).collect()))
    assert owners == [("a", "A1", 2), ("b", "B", 1)]


def test_owner_files(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("02", 2), ("01", 3)], "data_owner_id string, n int")
    registry.split_by_owner(df, str(tmp_path / "t"))
    stored = spark.read.schema(df.schema).parquet(str(tmp_path / "t"))
    assert sorted(r.n for r in registry.owner_view(stored, "01").collect()) == [1, 3]


def test_catalog_filters_and_first_values(spark):
    day = lambda n: datetime.datetime(2022, 1, n)
    resource_ = spark.createDataFrame(
        [("r1", "a", None, "p1", "active"), ("r2", "b", day(9), "p1", "active"), ("r3", "c", day(2), "p1", "deleted"),
         ("r4", "d", day(2), "p2", "active"), ("r5", "e", day(2), "p3", "active")],
        "id string, name string, last_modified timestamp_ntz, package_id string, state string")
    package = spark.createDataFrame(
        [("p1", "o1", "active"), ("p2", "o2", "active"), ("p3", "o1", "active")], "id string, owner_org string, state string"
    ).select("*", F.col("id").alias("name"), F.lit("t").alias("title"), F.lit("u").alias("creator_user_id"),
             F.lit(day(1)).cast("timestamp_ntz").alias("metadata_created"), F.lit(day(5)).cast("timestamp_ntz").alias("metadata_modified"))
    extra = spark.createDataFrame(
        [("p1", " ABC_CAS_USAGE ", " apcom "), ("p1", "ABC_ROLE", "z"), ("p1", "ABC_ROLE", "a"), ("p2", "ABC_CAS_USAGE", "x"),
         ("p3", "ABC_ROLE", "no use case")], "package_id string, key string, value string")
    organisation = spark.createDataFrame([("o1", "n1", True), ("o2", "n2", False)], "id string, name string, is_organization boolean")
    org_extra = spark.createDataFrame([("o1", "ABC_SIREN", " 12 "), ("o2", "ABC_SIREN", "3")], "group_id string, key string, value string")
    user = spark.createDataFrame([("u", "m", "n")], "id string, email string, name string")
    done = catalog.resource_catalog(
        resource_, package, extra, organisation.withColumn("title", F.lit("T")), org_extra, user, N)
    got = sorted((r.id, r.abc_cas_usage, r.abc_role, r.abc_target, r.abc_siren, r.last_changed.day) for r in done.collect())
    assert got == [("r1", "apcom", "a", None, " 12 ", 5), ("r2", "apcom", "a", None, " 12 ", 9)]


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "w")], "id string, at int, v string")
    assert sorted(r.v for r in catalog.latest_by_key(df, "id", "at").collect()) == ["w", "y"]


def test_iso_text(spark):
    stamps = [DAY, DAY.replace(microsecond=500000), datetime.datetime(2021, 3, 28, 2, 30), None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, at timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        got = [r.v for r in df.select("i", catalog.iso(F.col("at")).alias("v")).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The third stamp does not exist in that zone, and is kept as written.
    assert got == [s.isoformat() if s else None for s in stamps]
