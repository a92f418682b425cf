"""Publication, JSON-LD, files and the streaming twin."""

import json

import pytest
from pyspark.sql import functions as F

from concordat.functions import geometry as G
from concordat.operators import catalog, imports, jsonld, publish
from concordat.sources import files
from concordat.streaming import upsert


def test_csv_frame(spark):
    df = spark.sql("""select 'é' as x_nom, 1.5D as n, true as b, date'2021-01-02' as d, array(1, 2) as a,
        timestamp_ntz'20222-03-04 05:06:07' as ts, named_struct('k', 1) as s, 'POINT(1 2)' as w, 'txt' as geo_text""")
    df = df.withColumn("x_geom", G.from_wkt(F.col("w"), 2154)).withColumn("geom", F.col("x_geom")).drop("w")
    row = publish.to_csv_frame(df, wkt=True, prefix_regex="^x_(?=n)").first()
    assert (row.nom, row.n, row.b, row.d, row.a, row.s) == ("é", 1.5, "true", "2021-01-02", "[1,2]", '{"k":1}')
    assert row.ts.endswith("20222-03-04T05:06:07") and row.geo_text == "txt"
    assert row.geom == "POINT(1 2)"
    assert publish.to_csv_frame(df).first().geom == '{"type":"Point","coordinates":[1,2]}'
    with pytest.raises(ValueError):
        publish.to_csv_frame(df, prefix_regex="^x_")
    with pytest.raises(ValueError):
        publish.drop_prefix(spark.sql("select 1 as a_b, 2 as b"), "a")


def test_publish_writes_only_changes(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n int, owner string")
    actions = lambda m: {r.partition: (r.rows, r.action, r.resource_name) for r in m.collect()}
    assert actions(publish.publish(first, path, "t", "owner")) == {"a": (2, "create", "t"), "b": (1, "create", "t")}
    stamp = lambda part: {f.name: f.stat().st_mtime_ns for f in (tmp_path / "out" / "resource_name=t" / f"partition={part}").glob("part*")}
    before = stamp("a")
    second = first.filter("n <> 3").union(spark.createDataFrame([(4, "b"), (5, "c")], first.schema))
    got = actions(publish.publish(second, path, "t", "owner"))
    assert got == {"a": (2, "skip", "t"), "b": (1, "update", "t"), "c": (1, "create", "t")}
    assert stamp("a") == before
    read = lambda: sorted(int(r.n) for r in spark.read.csv(path, header=True).filter("resource_name = 't'").collect())
    assert read() == [1, 2, 4, 5]
    # Other columns: a sibling resource, and what was published stays.
    wider = second.withColumn("more", F.lit("x"))
    got = actions(publish.publish(wider, path, "t", "owner", stamp="2022-01-01T00:00:00"))
    assert got["a"] == (2, "create", "2022-01-01T00:00:00_t")
    assert read() == [1, 2, 4, 5]


def test_gone_and_interrupted_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    rows = lambda *pairs: spark.createDataFrame(pairs, "n int, owner string")
    actions = lambda m: {r.partition: (r.rows, r.action, r.resource_name) for r in m.collect()}
    read = lambda: sorted(int(r.n) for r in spark.read.csv(path, header=True).collect())
    publish.publish(rows((1, "01"), (2, "1"), (3, None), (4, "x y/é")), path, "t", "owner")
    got = actions(publish.publish(rows((2, "1"), (3, None)), path, "t", "owner"))
    assert got == {"01": (0, "delete", "t"), "1": (1, "skip", "t"), "": (1, "skip", "t"), "x y/é": (0, "delete", "t")}
    assert read() == [2, 3]
    # What was deleted is not named again, and is new when it is back.
    got = actions(publish.publish(rows((1, "01"), (2, "1")), path, "t", "owner"))
    assert got == {"01": (1, "create", "t"), "1": (1, "skip", "t"), "": (0, "delete", "t")} and read() == [1, 2]

    # A run that stops after its files are written, with the manifest as it was.
    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(publish, "_remove", stop)
        for _ in range(2):
            with pytest.raises(RuntimeError):
                publish.publish(rows((5, "01"), (7, "new")), path, "t", "owner")
    # Content as the manifest knows it, other than the files: it is written again, not skipped.
    got = actions(publish.publish(rows((1, "01"), (2, "1")), path, "t", "owner"))
    assert got == {"01": (1, "update", "t"), "1": (1, "update", "t"), "new": (0, "delete", "t")} and read() == [1, 2]
    assert {a for _, a, _ in actions(publish.publish(rows((1, "01"), (2, "1")), path, "t", "owner")).values()} == {"skip"}


def test_large_partitions_are_spread(spark, tmp_path):
    df = spark.range(0, 40000, 1, 8).select("id", F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("owner"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    try:
        publish.publish(df, str(tmp_path / "out"), "t", "owner")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    count = lambda part: len(list((tmp_path / "out" / "resource_name=t" / f"partition={part}").glob("part*")))
    assert count("small") <= 2 and count("big") >= 3


def test_titles_and_visibility():
    assert publish.title("kpi", "prod") == "Indicateurs"
    assert publish.title("plateforme", "test") == "DONNEES D'EXEMPLE - plateforme"
    assert not publish.is_private("kpi", "prod") and not publish.is_private("echange", "exemple")
    assert publish.is_private("echange", "prod")


def test_jsonld(spark):
    df = spark.sql("""select '31573' as com_code, 'Verfeil' as com_name, '76' as reg_code, 'Occitanie' as reg_name,
        false as com_in_ctu, true as com_is_mountain_area, cast(null as string) as ept_code, cast(null as string) as ept_name,
        'VERFEIL' as com_name_upper, '005' as com_aav2020_code, 'alone' as lone_name, 1 as _id, 'POLYGON((1 2,3 4,5 6,1 2))' as w""")
    df = df.withColumn("geometry", G.from_wkt(F.col("w"), 4326)).drop("w")
    entities = jsonld.to_jsonld(df, "Commune", "urn:c:", "http://c/commune.jsonld")
    got = json.loads(jsonld.to_json_lines(entities).first().value)
    value = lambda v: {"type": "Property", "value": v}
    assert got == {
        "id": "urn:c:31573", "type": "Commune", "@context": "http://c/commune.jsonld",
        "location": {"type": "GeoProperty", "value": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [5, 6], [1, 2]]]}},
        "com_code": value("31573"), "com_name": value("Verfeil"),
        "reg_code": {**value("76"), "reg_name": value("Occitanie")},
        "com_in_ctu": value(""), "com_is_mountain_area": value(True),
        "ept_code": {**value(""), "ept_name": value("")},
        "com_name_upper": value("VERFEIL"), "com_aav2020_code": value("005"),
    }
    kept = jsonld.to_jsonld(df, "Commune", "urn:c:", "x", legacy_falsy=False)
    assert json.loads(jsonld.to_json_lines(kept).first().value)["com_in_ctu"]["value"] is False
    context = jsonld.jsonld_context(df, "Commune", "https://ontology/apcom")["@context"]
    assert context["Commune"] == "https://ontology/apcom#Commune"
    assert context["reg_name"] == "https://ontology/apcom/commune#reg_name" and "_id" not in context


@pytest.mark.parametrize("header, sep", [("a;b;c", ";"), ("a,b", ","), ('"x;y;z",b', ","), ("a\tb", "\t"), ("a|b|c", "|"), ("alone", ";")])
def test_separator(header, sep):
    assert files.sniff_separator(header) == sep


def test_delimited_encodings_and_mark(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿nom;valeur\nété;1\n\"a;b\"\"c\";\n".encode())
    (tmp_path / "latin.csv").write_bytes("nom;valeur\nété;007\n".encode("latin-1"))
    one = files.read_delimited(spark, str(tmp_path / "bom.csv"))
    assert one.columns == ["nom", "valeur"]
    assert sorted(map(tuple, one.collect())) == [('a;b"c', None), ("été", "1")]
    two = files.read_delimited(spark, [str(tmp_path / "bom.csv"), str(tmp_path / "latin.csv")])
    assert sorted(r.valeur for r in two.filter("nom = 'été'").collect()) == ["007", "1"]
    lines = tmp_path / "multi.csv"
    lines.write_text('a,b\n"x\ny",2\n')
    assert files.read_delimited(spark, str(lines), multi_line=True).first().a == "x\ny"


@pytest.mark.parametrize("layout", ["lines", "document"])
def test_geojson(spark, tmp_path, layout):
    features = [
        {"type": "Feature", "properties": {"nom": "a", "n": 1, "o": {"k": [1]}}, "geometry": {"type": "Point", "coordinates": [3, 46.5]}},
        {"type": "Feature", "properties": {"nom": "b"}, "geometry": {
            "type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"nom": "c"}, "geometry": None},
    ]
    path = tmp_path / "f.geojson"
    path.write_text('{"type":"FeatureCollection","features":[\n' + ",\n".join(json.dumps(f) for f in features) + "\n]}")
    rows = files.read_geojson(spark, str(path), layout)
    assert rows.columns == ["n", "nom", "o", "geometry"]
    got = {r.nom: r for r in rows.withColumn("wkt", G.to_wkt(F.col("geometry"))).collect()}
    assert (got["a"].n, got["a"].o, got["a"].wkt) == ("1", '{"k":[1]}', "POINT(3 46.5)")
    assert got["b"].wkt.startswith("MULTIPOLYGON(((0 0,1 0") and got["c"].geometry is None


def test_import_run_end_to_end(spark, tmp_path):
    from tests.test_registry import CATALOG, N, resource
    from concordat.operators import union
    from concordat.sources.raw import ParquetTables
    (tmp_path / "good.csv").write_text("nom;valeur\nx;1\n")
    row = lambda i, path: (*resource(i, siren=f"S{i}")[:12], str(tmp_path / path), *resource(i, siren=f"S{i}")[13:])
    rows = spark.createDataFrame([row("1", "good.csv"), row("2", "missing.csv")], CATALOG)
    state = spark.createDataFrame([], "resource_key string, timestamp string, status string")
    plan = imports.plan_imports(rows, state, names=N)
    root = str(tmp_path / "raw")
    outcomes = files.load_resources(spark, plan, root, names=N)
    assert [(r.resource_id, r.step) for r in outcomes.collect()] == [("2", "download")]
    report = imports.stamp_run(imports.plan_imports(rows, state, outcomes=outcomes, names=N), "s", "e")
    assert {r.resource_id: r.status for r in report.collect()} == {"1": "success", "2": "error"}
    done = union.union_by_name(spark, report, ParquetTables(spark, root), "osm", "apcom", names=N)
    assert [(r.nom, r.valeur, r.data_owner_id) for r in done.collect()] == [("x", "1", "s1")]


def test_stream_equals_batch_in_any_file_order(spark, tmp_path):
    schema = "id string, at int, v string"
    rows = [("a", 1, "old"), ("a", 5, "new"), ("b", 2, "b"), ("c", 3, "c1"), ("c", 3, "c2"), ("a", 4, "late")]
    everything = spark.createDataFrame(rows, schema)
    wanted = sorted(map(tuple, catalog.latest_by_key(everything, "id", ["at", "v"]).collect()))
    assert wanted == [("a", 5, "new"), ("b", 2, "b"), ("c", 3, "c2")]
    for name, order in (("up", rows), ("down", rows[::-1])):
        landing, store = tmp_path / name / "landing", str(tmp_path / name / "store")
        for i, r in enumerate(order):
            spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(str(landing / f"d{i // 3}"))
            if i in (2, 5):
                changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", True).parquet(str(landing))
                upsert.stream_latest_by_key(changes, store, "id", ["at", "v"], f"{store}-progress").awaitTermination()
                if i == 2:
                    upsert.compact(spark, store, "id", ["at", "v"])
        assert sorted(map(tuple, upsert.read_latest(spark, store, "id", ["at", "v"]).select("id", "at", "v").collect())) == wanted
