"""Readers: no row is lost or mangled without an error."""

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from concordat.functions.casts import to_date, to_timestamp
from concordat.operators.dedupe import dedupe
from concordat.operators.link import CARRIED, MARK_COLUMN, MARKER, marked
from concordat.plans.queries import _collections
from concordat.sources.files import load_resources, read_delimited, read_geojson
from concordat.sources.raw import ParquetTables
from concordat.sources.records import open_line, quoted_records

FEATURES = [
    {"type": "Feature", "properties": {"nom": f"n{i}", "geometry": "p"}, "geometry": {"type": "Point", "coordinates": [i, 45.0]}}
    for i in range(3)
]
COLLECTION = {"type": "FeatureCollection", "features": FEATURES}


@pytest.mark.parametrize("text", [
    json.dumps(COLLECTION),
    json.dumps(COLLECTION, indent=2),
    '{"type": "FeatureCollection",\n"features": [\n' + ",\n".join(map(json.dumps, FEATURES)) + "\n]\n}",
    "\n".join(map(json.dumps, FEATURES)),
])
def test_every_layout_of_a_collection_loads(spark, tmp_path, text):
    (tmp_path / "a.geojson").write_text(text)
    rows = read_geojson(spark, str(tmp_path / "a.geojson")).orderBy("nom").collect()
    assert [r["nom"] for r in rows] == ["n0", "n1", "n2"]
    assert rows[0]["geometry__property"] == "p" and rows[0]["geometry"] is not None


def test_a_broken_feature_is_an_outcome(spark, tmp_path):
    (tmp_path / "b.geojson").write_text(json.dumps(FEATURES[0]) + '\n{"type": "Feature", "prop\n')
    plan = spark.createDataFrame(
        [("r1", "geojson", str(tmp_path / "b.geojson"), "s", "t", "success", "import")],
        "resource_id string, format string, source_file_path string, schema string, table string, status string, step string")
    failed = load_resources(spark, plan, str(tmp_path / "raw")).collect()
    assert [(r["resource_id"], r["step"]) for r in failed] == [("r1", "insert")]


LAYOUTS = {
    "one line": json.dumps(COLLECTION), "no spaces": json.dumps(COLLECTION, separators=(",", ":")), "pretty": json.dumps(COLLECTION, indent=2),
    "by line": '{"type": "FeatureCollection", "features": [\n' + ",\n".join(map(json.dumps, FEATURES)) + '\n], "name": "n"}\n',
    "list": json.dumps(FEATURES), "sequence": "\x1e" + "\n\x1e".join(map(json.dumps, FEATURES)) + "\n",
}


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def _breaks(seed: int, rows: int):
    """Rows of an id, any text and a value whose quotes open nothing, and them as delimited text with a header of two lines."""
    r = random.Random(seed)
    made = []
    for i in range(rows):
        length = r.choice([0, 3, 12, 400 if i % 40 == 0 else 5])
        made.append((str(i), "".join(r.choice(["a", "é", '"', "\n", ";", ",", "x y", '""', "\n\n"]) for _ in range(length)), r.choice(["p", '5" pipe', "", 'q"r'])))
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if re.search('[";\n]', v) else v
    lines = [f"{a};{quoted(b)};{c}" for a, b, c in made]
    return made, '"id";nom;"la\nst"\n' + "\n".join(lines) + "\n"


@pytest.mark.parametrize("size", ["128m", "700b", "97b"])
@pytest.mark.parametrize("charset", ["utf-8-sig", "latin-1"])
def test_breaks_in_quotes_are_found_across_splits(spark, tmp_path, small_splits, size, charset):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    wanted, text = _breaks(3, 200)
    (tmp_path / "a.csv").write_bytes(text.encode(charset))
    (tmp_path / "b.csv").write_bytes(text.replace("\n", "\r\n").encode(charset))
    done = read_delimited(spark, str(tmp_path))
    assert done.columns == ["id", "nom", "la\nst"]
    empty = [tuple(v or None for v in row) for row in wanted] * 2
    assert sorted(map(tuple, done.collect()), key=str) == sorted(empty, key=str)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan


def test_records_with_blank_lines_open_ends_and_extra_fields(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('\n \na,b\n1,"x\n\ny"\n\n  \n2,"x"y"z\n3\n4,"never\nclosed\n')
    records = [tuple(r) for r in quoted_records(spark, [str(path)], ",").collect()]
    assert sorted(records) == sorted([("a,b", True), ('1,"x\n\ny"', False), ('2,"x"y"z', False), ("3", False), ('4,"never\nclosed', False)])
    path.write_text("")
    assert quoted_records(spark, [str(path)], ",").count() == 0
    path.write_text('a,b\n1,"x\ny",3\n')
    with pytest.raises(Exception, match="more fields than the header"):
        read_delimited(spark, str(path)).collect()


@pytest.mark.parametrize("line,opens", [
    ("a;b", False), ('"a', True), ('"a"', False), ('a"b', False), ('a;"b', True), ('a;"b""', True), ('a;"b"""', False),
    ('"a"x"y;"b', True), ('"a;b', True), ('"a;"b', False), ("", False), ('"', True), ('""', False), ('"' + 'x""' * 200000, True)])
def test_lines_that_end_inside_quotes(spark, line, opens):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(F.col("value").rlike(open_line(";"))).first()[0] is opens


TRICKY = [
    {"properties": {"nom": f'n{i} \\" }}}},{{"type": "Feature" [', "geometry": "{", "more": {"type": "Feature", "l": [{"a": i}, {"a": 1}]}},
     "geometry": {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [i, 45.0]}, {"type": "Point", "coordinates": [i, 46.0]}]}}
    for i in range(60)
]


@pytest.mark.parametrize("first", ["type", "id", "properties"])
@pytest.mark.parametrize("indent", [None, 1])
def test_a_collection_is_cut_at_features(spark, tmp_path, small_splits, first, indent):
    features = [{first: {"type": "Feature", "id": str(i)}.get(first, f["properties"]), "type": "Feature", **f} for i, f in enumerate(TRICKY)]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "name": "x", "features": features, "crs": {"a": [1]}}, indent=indent))
    done = read_geojson(spark, str(tmp_path / "a.geojson"))
    rows = done.collect()
    assert sorted(r["nom"] for r in rows) == sorted(f["properties"]["nom"] for f in features)
    assert {json.loads(r["more"])["l"][0]["a"] for r in rows} == set(range(60))
    if first == "type":
        assert done.select(F.spark_partition_id()).distinct().count() > 10


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_in_small_splits(spark, tmp_path, small_splits, layout):
    (tmp_path / "a.geojson").write_text("\ufeff" * (layout == "one line") + LAYOUTS[layout])
    (tmp_path / "b.geojson").write_text("")
    assert sorted(r["nom"] for r in read_geojson(spark, str(tmp_path)).collect()) == ["n0", "n1", "n2"]


BROKEN = {
    "cut off in a feature": json.dumps(COLLECTION)[:150], "cut off after one": json.dumps(COLLECTION)[: json.dumps(COLLECTION).index("}}, {") + 3],
    "pretty and cut off": json.dumps(COLLECTION, indent=2)[:300], "no tail": json.dumps(COLLECTION)[:-2],
    "one bad feature": json.dumps(COLLECTION).replace('{"nom": "n1"', '{"nom": n1'), "one that is none": json.dumps(COLLECTION).replace('"Feature", "properties": {"nom": "n1"', '"Point", "properties": {"nom": "n1"'),
    "something else": '{"error": "not found"}', "a page": "<!DOCTYPE html>\n<html><body>Not found</body></html>", "text behind": json.dumps(COLLECTION) + " and more",
    "two documents": json.dumps(COLLECTION) * 2, "features missing": '{"type": "FeatureCollection"}', "bad line": LAYOUTS["sequence"].replace('"n2"', "n2"),
}


@pytest.mark.parametrize("kind", BROKEN)
def test_malformed_geojson_is_an_outcome_and_stores_nothing(spark, tmp_path, kind):
    (tmp_path / "b.geojson").write_text(BROKEN[kind])
    plan = spark.createDataFrame(
        [("r1", "geojson", str(tmp_path / "b.geojson"), "s", "t", "success", "import")],
        "resource_id string, format string, source_file_path string, schema string, table string, status string, step string")
    failed = load_resources(spark, plan, str(tmp_path / "raw")).collect()
    assert [(r["resource_id"], r["step"]) for r in failed] == [("r1", "insert")]
    assert "b.geojson" in failed[0]["error"]
    assert not (tmp_path / "raw").exists()


def test_a_collection_without_features_is_no_error(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type": "FeatureCollection", "features": []}')
    assert read_geojson(spark, str(tmp_path / "a.geojson")).count() == 0


def test_quoted_breaks_and_headers_in_any_order(spark, tmp_path):
    folder = tmp_path / "données brutes"
    folder.mkdir()
    (folder / "a.csv").write_text('id;nom\n1;"x\ny"\n2;z\n')
    (folder / "b.csv").write_bytes("nom;id\né;3\n".encode("latin-1"))
    rows = read_delimited(spark, str(folder)).orderBy("id").collect()
    assert [(r["id"], r["nom"]) for r in rows] == [("1", "x\ny"), ("2", "z"), ("3", "é")]


def test_extra_fields_fail_and_missing_ones_are_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;nom\n1\n")
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path / "a.csv")).collect()] == [("1", None)]
    (tmp_path / "b.csv").write_text("id;nom\n1;a;b\n")
    with pytest.raises(Exception, match="more fields"):
        read_delimited(spark, str(tmp_path / "b.csv")).collect()


def test_names_of_stored_tables_are_decoded(spark, tmp_path):
    key = "uc.p_raw_réseau eau+_o1"
    spark.range(2).write.parquet(str(tmp_path / "uc" / "p_raw_réseau eau+_o1"))
    (frame,) = ParquetTables(spark, str(tmp_path)).open([key])
    assert {r["import_table"] for r in frame.collect()} == {key}


def test_dates_with_zones_and_short_fields(spark):
    texts = ["2021-01-02T10:00:00Z", "2021-01-02T10:00:00+02:00", "2/1/2021", "2021-1-2", "2021-01-02", "1/23/4"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    formats = ('YYYY-MM-DD"T"HH24:mi:ss.SSS', "DD/MM/YYYY HH24:mi:ss.SSS")
    rows = df.select(to_date(F.col("t"), formats).alias("d"), to_timestamp(F.col("t"), formats).alias("s")).collect()
    day, noon = datetime.date(2021, 1, 2), datetime.datetime(2021, 1, 2, 10)
    assert [r["d"] for r in rows] == [day] * 5 + [None]
    assert [r["s"] for r in rows[:2]] == [noon, noon]


def test_dedupe_orders_by_expressions(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, 1), (2, None, None)], "k int, a int, b int")
    rows = dedupe(df, "k", "coalesce(a, b) desc nulls last, b").orderBy("k").collect()
    assert [(r["k"], r["a"], r["b"]) for r in rows] == [(1, None, 5), (2, None, None)]


def test_links_to_areas_without_a_name_are_no_markers(spark):
    carried = ", ".join(f"{c} string" for c in CARRIED)
    rows = [("o1", "a1", *[None] * len(CARRIED), None), (MARKER, MARKER, *[None] * len(CARRIED), datetime.datetime(2021, 1, 1))]
    links = spark.createDataFrame(rows, f"object_id string, com_code string, {carried}, {MARK_COLUMN} timestamp_ntz")
    assert [r["object_id"] for r in links.filter(~marked(links)).collect()] == ["o1"]


def test_a_collection_is_one_file_whatever_partitions_are_coalesced(spark, tmp_path):
    """The rows of a value, its head and its tail differ in size, and so in how Spark puts their partitions together."""
    rows = spark.range(4000).select("id", (F.col("id") % 7).alias("by"), F.format_string(
        '{"type":"Feature","properties":{"id":"%d"},"geometry":{"type":"Point","coordinates":[1.0,2.0]}}', "id").alias("feature"))
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        _collections(rows, "by", str(tmp_path / "all"))
    finally:
        for name in sizes:
            spark.conf.unset(name)
    files = sorted((tmp_path / "all").glob("by=*/part-*"))
    assert [f.parent.name for f in files] == [f"by={i}" for i in range(7)]
    found = [json.loads(f.read_text()) for f in files]
    assert [[int(x["properties"]["id"]) for x in c["features"]] for c in found] == [list(range(i, 4000, 7)) for i in range(7)]
    assert read_geojson(spark, str(tmp_path / "all")).count() == 4000
