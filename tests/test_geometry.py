import json
import random

import pytest
from pyspark.sql import functions as F

from concordat.functions import geometry as G

VALID = [
    "POINT(1 2)",
    "LINESTRING(0 0,1 1.5,2 0)",
    "POLYGON((3.8 48.5,3.8 48.6,3.9 48.6,3.8 48.5))",
    "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1))",
    "MULTIPOINT((1 2),(3 4))",
    "MULTILINESTRING((0 0,1 1),(2 2,3 3,4 2))",
    "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5),(5.2 5.1,5.8 5.1,5.8 5.7,5.2 5.1)))",
    "POLYGON EMPTY",
]


def one_column(spark, rows, *expressions):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    return [tuple(r)[1:] for r in df.select("i", *expressions).orderBy("i").collect()]


def test_wkt_round_trip(spark):
    got = one_column(spark, VALID, G.to_wkt(G.from_wkt(F.col("c"), 4326)))
    assert [g[0] for g in got] == VALID


def test_geojson_round_trip(spark):
    as_json = G.to_geojson(G.from_wkt(F.col("c"), 4326))
    got = one_column(spark, VALID[:-1], as_json, G.to_wkt(G.from_geojson(as_json, 4326)))
    assert [g[1] for g in got] == VALID[:-1]
    assert json.loads(got[6][0])["coordinates"][1][1][0] == [5.2, 5.1]
    assert json.loads(got[4][0]) == {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}


@pytest.mark.parametrize(
    "text, expected",
    [
        (" point ( +1. .5 ) ", "POINT(1 0.5)"),
        ("POINT Z (1 2 3)", "POINT(1 2)"),
        ("MULTIPOINT(1 2, 3 4)", "MULTIPOINT((1 2),(3 4))"),
        ("POINT(1e3 -2.5E-1)", "POINT(1000 -0.25)"),
        ("bad", None),
        ("", None),
        (None, None),
        ("POINT(1)", None),
        ("POINT(a b)", None),
        ("POLYGON((0 0,1 1,0 1))", None),
        ("POLYGON((0 0,1 1,0 0))", None),
        ("POLYGON(0 0,1 1,0 1,0 0)", None),
        ("LINESTRING(0 0)", None),
        ("POLYGON((0 0,1 1,0 1,0 0)", None),
    ],
)
def test_wkt_reading(spark, text, expected):
    assert one_column(spark, [text], G.to_wkt(G.from_wkt(F.col("c"), 2154))) == [(expected,)]


def test_geojson_failures_and_srid(spark):
    got = one_column(
        spark,
        ['{"type":"Point","coordinates":[3,46.5]}', "{", '{"type":"Blob","coordinates":[1,2]}', None],
        G.to_wkt(G.from_geojson(F.col("c"), 2154), 3),
        G.from_geojson(F.col("c"), 2154)["srid"],
    )
    assert got == [("POINT(700000 6600000)", 2154), (None, None), (None, None), (None, None)]


def test_lambert93_vectors(spark):
    vectors = [
        (3.0, 46.5, 700000.000, 6600000.000),
        (2.3522, 48.8566, 652469.023, 6862035.259),
        (1.646424, 43.67888, 590828.476, 6287585.050),
        (-4.4861, 48.3904, 146632.979, 6836262.327),
        (7.7521, 48.5734, 1050362.695, 6840899.647),
    ]
    df = spark.createDataFrame(vectors, "lon double, lat double, x double, y double")
    there = G.transform(G.point(F.col("lon"), F.col("lat"), 4326), 2154)
    back = G.vertices(G.transform(there, 4326))[0]
    rows = df.select("*", G.vertices(there)[0].alias("p"), back.alias("b")).collect()
    for r in rows:
        assert abs(r.p.x - r.x) < 1e-3 and abs(r.p.y - r.y) < 1e-3
        assert abs(r.b.x - r.lon) < 1e-9 and abs(r.b.y - r.lat) < 1e-9


SQUARE_WITH_HOLE = "POLYGON((0 0,10 0,10 10,0 10,0 0),(4 4,6 4,6 6,4 6,4 4))"
NOTCHED = "POLYGON((0 0,10 0,10 10,6 10,6 5,4 5,4 10,0 10,0 0))"


@pytest.mark.parametrize(
    "area, inner, expected",
    [
        (SQUARE_WITH_HOLE, "POINT(1 1)", True),
        (SQUARE_WITH_HOLE, "POINT(5 5)", False),
        (SQUARE_WITH_HOLE, "POINT(0 5)", False),
        (SQUARE_WITH_HOLE, "POINT(10 10)", False),
        (SQUARE_WITH_HOLE, "POINT(4 5)", False),
        (SQUARE_WITH_HOLE, "POINT(2 4)", True),
        (SQUARE_WITH_HOLE, "POINT(11 4)", False),
        (SQUARE_WITH_HOLE, "LINESTRING(1 1,2 2)", True),
        (SQUARE_WITH_HOLE, "LINESTRING(1 1,9 9)", False),
        (SQUARE_WITH_HOLE, "LINESTRING(0 0,10 0)", False),
        (SQUARE_WITH_HOLE, "LINESTRING(0 0,3 3)", True),
        (SQUARE_WITH_HOLE, "LINESTRING(3 5,7 5)", False),
        (SQUARE_WITH_HOLE, "POLYGON((1 1,3 1,3 3,1 1))", True),
        (SQUARE_WITH_HOLE, "POLYGON((3 3,7 3,7 7,3 7,3 3))", False),
        (SQUARE_WITH_HOLE, SQUARE_WITH_HOLE, True),
        (NOTCHED, "LINESTRING(2 10,8 10)", False),
        (NOTCHED, "LINESTRING(0 10,10 10)", False),
        (NOTCHED, "POLYGON((0 0,10 0,10 10,0 10,0 0))", False),
        (NOTCHED, "POLYGON((1 1,9 1,9 4,1 4,1 1))", True),
        (NOTCHED, "MULTIPOINT((1 1),(10 10))", True),
        (NOTCHED, "MULTIPOINT((0 0),(10 10))", False),
    ],
)
def test_contains(spark, area, inner, expected):
    df = spark.createDataFrame([(area, inner)], "a string, b string")
    got = df.select(G.contains(G.from_wkt(F.col("a"), 2154), G.from_wkt(F.col("b"), 2154))).first()[0]
    assert got is expected


def test_point_position_against_winding_number(spark):
    rng = random.Random(5)
    star = [(5, 0), (6, 4), (10, 4), (7, 6), (8, 10), (5, 7), (2, 10), (3, 6), (0, 4), (4, 4), (5, 0)]
    wkt = "POLYGON((" + ",".join(f"{x} {y}" for x, y in star) + "))"
    pts = [(rng.uniform(-1, 11), rng.uniform(-1, 11)) for _ in range(300)]

    def winding(x, y):
        turns = 0
        for (x1, y1), (x2, y2) in zip(star, star[1:]):
            side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if y1 <= y < y2 and side > 0:
                turns += 1
            elif y2 <= y < y1 and side < 0:
                turns -= 1
        return turns != 0

    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "i int, x double, y double")
    area = G.edges(G.from_wkt(F.lit(wkt), 4326))
    got = df.select("i", G.strictly_inside(area, F.col("x"), F.col("y")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [winding(x, y) for x, y in pts]
