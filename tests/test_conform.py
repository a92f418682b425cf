import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import geometry as G
from concordat.operators import conform as C
from concordat.operators import dictionary as D
from concordat.types import GEOMETRY

TARGET = T.StructType([
    T.StructField("eaupotcan_materiau", T.StringType()),
    T.StructField("eaupotcan_datePose", T.DateType()),
    T.StructField("eaupotcan_diametre", T.DecimalType(38, 10)),
    T.StructField("eaupotcan_enService", T.BooleanType()),
    T.StructField("geometry", GEOMETRY),
])
DICTIONARY = [
    ("materiau", "mat_source", None, "canalisations"),
    ("materiau", "Fonte", "01", "canalisations"),
    ("materiau", "Inconnu", "99", "canalisations"),
    ("mode", "Inconnu", "00", "canalisations"),
]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(DICTIONARY, "Champs string, Valeur string, Code string, SOURCE_NOM string")


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [
            ("Fonte", "2021-01-02T10:00:00.123", " 12,5", "Oui", "POINT(1 2)", "x"),
            ("Inconnu", "02/01/2021 00:00:00.000", "100", "non", "bad", "y"),
            ("Autre", "", None, None, None, None),
        ],
        "mat_source string, datepose string, diametre string, enService string, geom string, reste string",
    )


def test_conform_to_target(spark, raw, words):
    mapping = D.build_mapping(TARGET.names, D.read_renames(words, "canalisations", ["materiau"]))
    assert mapping["eaupotcan_materiau"] == "mat_source"
    done = C.conform(raw, [TARGET], defined_only=True, complete=True, mapping=mapping, wkt=True, dictionary=words)
    assert done.columns == TARGET.names
    day = datetime.date(2021, 1, 2)
    rows = done.withColumn("geometry", G.to_wkt(F.col("geometry"))).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([
        ("01", day, None, True, "POINT(1 2)"),
        ("99", day, Decimal(100), False, None),
        (None, None, None, None, None),
    ], key=str)


def test_conform_never_raises_on_any_text(spark):
    junk = ["", " ", "é", "NaN", "1e999", "99999999999999999999999999999999999999999", "2021-13-45", "POINT(", "{", "\u0000",
            "-", "+", ".", "1.", "0x10", "truefalse", "POLYGON((1 2,3 4,1 2))", "2021-02-30T99:99:99", None]
    df = spark.createDataFrame([(j,) for j in junk], "c string")
    kinds = ["int", "bigint", "double", "decimal(38,10)", "date", "timestamp_ntz", "boolean", "string"]
    target = T.StructType([T.StructField(f"k{i}", T.DataType.fromDDL(k)) for i, k in enumerate(kinds)])
    target.add("geometry", GEOMETRY)
    mapping = {name: "c" for name in target.names}
    for wkt in (True, False):
        rows = C.conform(df, [target], defined_only=True, complete=True, mapping=mapping, wkt=wkt, best_geometry=("c",))
        assert len(rows.collect()) == len(junk)


def test_labels_shared_by_fields(spark, words):
    df = spark.createDataFrame([("Inconnu",), ("Fonte",), ("?",)], "materiau string")
    own = D.translate_codes(df, words, ["materiau"])
    assert sorted(str(r[0]) for r in own.collect()) == ["01", "99", "None"]
    fanned = D.translate_codes(df, words, ["materiau"], match_field=False)
    assert sorted(str(r[0]) for r in fanned.collect()) == ["00", "01", "99", "None"]


def test_translation_without_broadcast(spark, words, monkeypatch):
    import concordat.operators.dictionary as module
    monkeypatch.setattr(module, "sized", lambda lookup: lookup.hint("merge"))
    df = spark.createDataFrame([("Inconnu", 1), ("Fonte", 2)], "materiau string, n int")
    done = D.translate_codes(df, words, ["materiau"])
    assert done.columns == ["materiau", "n"]
    assert sorted(map(tuple, done.collect())) == [("01", 2), ("99", 1)]


def test_missing_columns_left_out_or_completed(spark):
    df = spark.createDataFrame([("1",)], "a string")
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.BooleanType())])
    assert C.conform(df, [target]).columns == ["a"]
    full = C.conform(df, [target], complete=True, debug=True)
    assert full.columns == ["a", "a__src", "b", "b__src"]
    assert tuple(full.first()) == (1, "1", None, None)


def test_other_columns_follow_and_first_model_wins(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    one = T.StructType([T.StructField("a", T.IntegerType())])
    two = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    done = C.conform(df, [one, two])
    assert [(f.name, f.dataType.simpleString()) for f in done.schema] == [("a", "int"), ("b", "bigint"), ("c", "string")]


def test_names_differing_by_case_and_odd_characters(spark):
    df = spark.createDataFrame([("low", "up", "dot")], ["nom", "Nom", "a.b c"])
    target = T.StructType([T.StructField(n, T.StringType()) for n in ("x_Nom", "x_autre")])
    done = C.conform(df, [target], defined_only=True, complete=True, mapping={"x_Nom": "Nom", "x_autre": "a.b c"})
    assert tuple(done.first()) == ("up", "dot")
    lower = C.conform(spark.createDataFrame([("low",)], ["nom"]), [target], defined_only=True, complete=True, mapping={"x_Nom": "NOM"})
    assert lower.first()["x_Nom"] == "low"


def test_without_target_geometry_is_renamed(spark):
    df = spark.createDataFrame([("POINT(3 46.5)", "a")], "w string, nom string")
    df = df.select(G.from_wkt(F.col("w"), 4326).alias("geo_shape"), "nom")
    done = C.conform(df, srid=2154)
    assert done.columns == ["geometry", "nom"]
    assert done.select(G.to_wkt(F.col("geometry"), 3)).first()[0] == "POINT(700000 6600000)"


def test_best_geometry_column(spark):
    text, shape = T.StringType(), GEOMETRY
    schema = lambda **kinds: T.StructType([T.StructField(k, v) for k, v in kinds.items()])
    assert C.best_geometry_column(schema(geometrie=text, geom=text), C.BEST_GEOMETRY) == "geom"
    assert C.best_geometry_column(schema(geom=text, geometrie=shape), C.BEST_GEOMETRY) == "geometrie"
    assert C.best_geometry_column(schema(autre=text), C.BEST_GEOMETRY) is None


def test_uuid_columns_are_strict(spark):
    good = spark.createDataFrame([("0A1B2C3D-0000-5000-8000-000000000000",), (None,)], "x_Id string")
    target = T.StructType([T.StructField("x_Id", T.StringType())])
    rows = C.conform(good, [target], uuid_pattern="(_Id|_Ref)$").collect()
    assert [r[0] for r in rows] == ["0a1b2c3d-0000-5000-8000-000000000000", None]
    with pytest.raises(Exception, match="invalid uuid"):
        C.conform(spark.createDataFrame([("nope",)], "x_Id string"), [target], uuid_pattern="_Id$").collect()


def test_arrays_pass_through(spark):
    df = spark.createDataFrame([([48.5, 3.0],)], "geo_point_2d array<double>")
    assert C.conform(df).first()[0] == [48.5, 3.0]


def test_strict_types(spark):
    df = spark.createDataFrame([("12",), (None,)], "`Population municipale 2019` string")
    done = C.strict_types(df, {"Population municipale 2019": "decimal(38,10)"})
    assert sorted((r[0] for r in done.collect()), key=str) == [Decimal(12), None]
    bad = spark.createDataFrame([("12 hab",)], "p string")
    with pytest.raises(Exception, match="does not fit"):
        C.strict_types(bad, {"p": "int"}).collect()


def test_cast_report_adds_up(spark):
    df = spark.createDataFrame([("1",), ("x",), (" ",), (None,), ("2",), ("y",)], "c string")
    row = C.cast_report(df, {"c": "int"}).first()
    assert tuple(row) == ("c", 6, 2, 2, 2, "x")


def test_definition_and_example(spark):
    example = spark.createDataFrame([("POLYGON((3.8 48.5,3.8 48.6,3.9 48.6,3.8 48.5))",)], "geom string")
    parsed = C.read_example_perimeters(example)
    assert parsed.first()["geom"]["srid"] == 2154
    empty = C.definition(parsed)
    assert empty.count() == 0 and empty.schema == parsed.schema


def test_geometry_jobs(spark):
    df = spark.createDataFrame([('{"type":"Point","coordinates":[3,46.5]}',)], "g string")
    there = C.parse_geometry(df, "g", "geojson", 2154)
    assert C.render_geometry(C.reproject(there, "g", 4326), "g", "geojson").first()[0] == (
        '{"type":"Point","coordinates":[3,46.5]}')
    with pytest.raises(ValueError):
        C.parse_geometry(df, "g", "kml", 4326)
