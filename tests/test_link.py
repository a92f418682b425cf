import datetime
import random

import pytest
from pyspark.sql import functions as F

from concordat.functions import geometry as G
from concordat.operators import link
from concordat.plans import models

T0 = datetime.datetime(2022, 1, 1)


def wkt_areas(spark, rows):
    df = spark.createDataFrame(rows, "com_code string, wkt string")
    return df.select("com_code", F.concat(F.lit("N"), "com_code").alias("com_name"),
                     G.from_wkt(F.col("wkt"), 4326).alias("geometry"))


def objects(spark, rows):
    df = spark.createDataFrame(rows, "id string, wkt string, last_changed timestamp_ntz")
    return df.select("id", "last_changed", G.from_wkt(F.col("wkt"), 4326).alias("geometry"))


def random_polygon(rng, size):
    """A star-shaped ring, so that it does not cross itself."""
    import math
    cx, cy = rng.uniform(0, 50), rng.uniform(0, 50)
    n = rng.randint(4, 30)
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    pts = [(cx + size * rng.uniform(0.3, 1) * math.cos(t), cy + size * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]
    return "POLYGON((" + ",".join(f"{x!r} {y!r}" for x, y in [*pts, pts[0]]) + "))"


@pytest.mark.parametrize("salts", [None, 1, 3])
def test_links_equal_all_pairs(spark, salts):
    rng = random.Random(11)
    areas = wkt_areas(spark, [(str(i), random_polygon(rng, rng.choice([0.2, 1, 3, 20]))) for i in range(60)]).cache()
    rows = [(str(i), f"POINT({rng.uniform(-5, 55)!r} {rng.uniform(-5, 55)!r})", T0) for i in range(400)]
    # A crowd in one place, and two objects without a usable geometry.
    rows += [(f"c{i}", "POINT(25.125 25.0625)", T0) for i in range(200)] + [("n1", None, T0), ("n2", "bad", T0)]
    points = objects(spark, rows).cache()
    got = link.link_within(points, areas, "id", "geometry", carry=(), salts=salts)
    pairs = points.crossJoin(areas.withColumnRenamed("geometry", "outline"))
    p = F.col("geometry.parts")[0][0][0]
    every = pairs.filter(G.strictly_inside(G.edges(F.col("outline")), p["x"], p["y"])).select("id", "com_code")
    found = [(r.id, r.com_code) for r in got.select("id", "com_code").collect()]
    expected = sorted((r.id, r.com_code) for r in every.collect())
    assert len(expected) > 300
    assert sorted(found) == expected


@pytest.mark.parametrize("salts", [None, 2])
def test_shapes_equal_all_pairs(spark, salts):
    rng = random.Random(12)
    areas = wkt_areas(spark, [(str(i), random_polygon(rng, rng.choice([3, 20]))) for i in range(25)]).cache()
    rows = [(f"p{i}", random_polygon(rng, 0.5), T0) for i in range(60)]
    for i in range(60):
        x, y = rng.uniform(0, 50), rng.uniform(0, 50)
        rows.append((f"l{i}", f"LINESTRING({x!r} {y!r},{x + rng.uniform(-1, 1)!r} {y + 1!r})", T0))
    shapes = objects(spark, rows).cache()
    got = link.link_within(shapes, areas, "id", "geometry", carry=(), salts=salts)
    pairs = shapes.crossJoin(areas.withColumnRenamed("geometry", "outline"))
    every = pairs.filter(G.contains(F.col("outline"), F.col("geometry"))).select("id", "com_code")
    expected = sorted((r.id, r.com_code) for r in every.collect())
    assert len(expected) > 20
    assert sorted((r.id, r.com_code) for r in got.collect()) == expected


def _box(x, y, w, h):
    return f"({x} {y},{x + w} {y},{x + w} {y + h},{x} {y + h},{x} {y})"


@pytest.mark.parametrize("salts", [None, 2])
def test_shapes_that_touch_holes_and_parts(spark, salts):
    """Whole coordinates, so that shapes follow boundaries, meet corners and enclose holes all the time."""
    rng = random.Random(21)
    areas = []
    for i in range(25):
        x, y, w, h = rng.randint(0, 20), rng.randint(0, 20), rng.randint(6, 12), rng.randint(6, 12)
        holes = [_box(x + 2, y + 2, 2, 2)] + ([_box(x + 4, y + 4, w - 5, h - 5)] if rng.random() < 0.5 else [])
        rings = ",".join([_box(x, y, w, h), *(holes if rng.random() < 0.7 else [])])
        areas.append((str(i), f"MULTIPOLYGON((({rings[1:-1]})),({_box(x + w + 1, y, 3, 3)}))" if rng.random() < 0.4 else f"POLYGON({rings})"))
    rows = []
    for i in range(150):
        x, y, w, h = rng.randint(0, 28), rng.randint(0, 28), rng.randint(1, 5), rng.randint(1, 5)
        kinds = [
            f"POLYGON({_box(x, y, w, h)})", f"POLYGON({_box(x, y, w + 2, h + 2)},{_box(x + 1, y + 1, 1, 1)})", f"LINESTRING({x} {y},{x + w} {y},{x + w} {y + h})",
            f"LINESTRING({x} {y},{x + w} {y + h})", f"MULTIPOINT({x} {y},{x + w} {y + h})", f"MULTILINESTRING(({x} {y},{x + 1} {y}),({x + 2} {y},{x + 2} {y + h}))",
            f"MULTIPOLYGON(({_box(x, y, 1, 1)}),({_box(x + 2, y, 1, 1)}))",
        ]
        rows += [(f"{i}-{k}", wkt, T0) for k, wkt in enumerate(kinds)]
    rows += rows[:50]  # objects that repeat are linked each
    found, shapes = wkt_areas(spark, areas).cache(), objects(spark, rows).cache()
    got = link.link_within(shapes, found, "id", "geometry", carry=("com_name",), salts=salts)
    pairs = shapes.crossJoin(found.withColumnRenamed("geometry", "outline"))
    every = pairs.filter(G.contains(F.col("outline"), F.col("geometry"))).select("id", "com_code", "com_name")
    expected = sorted(map(tuple, every.collect()))
    assert len(expected) > 200
    assert sorted(tuple(r)[:3] for r in got.collect()) == expected


def test_a_crowded_cell_is_split_and_only_its_areas_are_copied(spark, monkeypatch):
    monkeypatch.setattr(link, "CROWD", 50)
    monkeypatch.setattr(link, "BROADCAST_BYTES", 0)
    areas = wkt_areas(spark, [(str(i), f"POLYGON({_box(i, 0, 1, 1)})") for i in range(40)])
    rows = [(f"c{i}", "POINT(3.5 0.5)", T0) for i in range(900)] + [(f"o{i}", f"POINT({i % 40 + 0.25} 0.5)", T0) for i in range(100)]
    got = link.link_within(objects(spark, rows), areas, "id", "geometry", carry=(), shapes=False)
    assert sorted((r.id, r.com_code) for r in got.collect()) == sorted([(f"c{i}", "3") for i in range(900)] + [(f"o{i}", str(i % 40)) for i in range(100)])
    cells = spark.createDataFrame([(0, n, 0, "a") for n in range(40)], "level int, cx long, cy long, com_code string")
    placed = spark.createDataFrame([(0, 3, 0, str(i)) for i in range(900)] + [(0, i % 40, 0, str(i)) for i in range(100)], "level int, cx long, cy long, oid string")
    _, copied = link._shared_out(placed, cells)
    assert {r.cx: r.shares for r in copied.collect()} == {n: 19 if n == 3 else 1 for n in range(40)}


def test_holes_boundaries_and_overlaps(spark):
    areas = wkt_areas(spark, [
        ("ring", "POLYGON((0 0,10 0,10 10,0 10,0 0),(4 4,6 4,6 6,4 6,4 4))"),
        ("over", "MULTIPOLYGON(((5 5,15 5,15 15,5 15,5 5)),((100 100,101 100,101 101,100 101,100 100)))"),
        ("none", None),
    ])
    points = objects(spark, [
        ("hole", "POINT(4.5 4.5)", T0), ("edge", "POINT(10 2)", T0), ("both", "POINT(8 8)", T0),
        ("one", "POINT(1 1)", T0), ("out", "POINT(50 50)", T0), ("far", "POINT(100.5 100.5)", T0),
    ])
    got = link.link_within(points, areas, "id", "geometry", carry=("com_name",))
    assert sorted((r.id, r.com_code) for r in got.collect()) == [
        ("both", "over"), ("both", "ring"), ("far", "over"), ("one", "ring"),
    ]


def test_no_areas(spark):
    areas = wkt_areas(spark, [("a", None)])
    points = objects(spark, [("x", "POINT(1 1)", T0)])
    assert link.link_within(points, areas, "id", "geometry", carry=()).count() == 0


def test_incremental_links(spark, tmp_path):
    areas = wkt_areas(spark, [("a", "POLYGON((0 0,1 0,1 1,0 1,0 0))"), ("b", "POLYGON((2 0,3 0,3 1,2 1,2 0))")])
    later = T0 + datetime.timedelta(days=1)
    first = objects(spark, [("stay", "POINT(0.5 0.5)", T0), ("move", "POINT(0.5 0.6)", T0), ("leave", "POINT(0.4 0.4)", T0)])
    second = objects(spark, [
        ("stay", "POINT(0.5 0.5)", T0), ("move", "POINT(2.5 0.5)", later), ("leave", "POINT(9 9)", later),
        ("late", "POINT(0.1 0.1)", T0),
    ])
    path, options = str(tmp_path / "links"), {"carry": ("com_name",)}
    models.commune_links(first, areas, path, "id", **options)
    done = models.commune_links(second, areas, path, "id", **options)
    # "late" carries the old watermark, so a strict comparison does not take it.
    assert sorted((r.id, r.com_code) for r in models.links_only(done).collect()) == [("move", "b"), ("stay", "a")]
    marker = done.filter("com_name is null").collect()
    assert [(r.id, r.com_code, r[link.MARK_COLUMN]) for r in marker] == [(link.MARKER, link.MARKER, later)]
    full = models.commune_links(second, areas, path, "id", mode="full", **options)
    assert sorted(r.id for r in models.links_only(full).collect()) == ["late", "move", "stay"]


def test_owner_tagging(spark):
    perimeters = wkt_areas(spark, [("o1", "POLYGON((0 0,1 0,1 1,0 1,0 0))")]).select(
        F.col("com_code").alias("data_owner_id"), F.col("geometry").alias("geom"))
    points = objects(spark, [("in", "POINT(0.5 0.5)", T0), ("out", "POINT(5 5)", T0)])
    got = link.tag_perimeter_owner(points, perimeters, "id")
    assert [tuple(r) for r in got.collect()] == [("in", "o1")]


def test_shapes_and_areas_of_one_file_are_spread(spark):
    """Both sides make more work than their bytes tell; shapes beyond an area's box are dropped before the exact test."""
    areas = wkt_areas(spark, [("a", "POLYGON((0 0,4 0,4 4,0 4,0 0))"), ("b", "POLYGON((3 3,9 3,9 9,3 9,3 3))")]).coalesce(1)
    rows = [("in", "LINESTRING(1 1,2 2)", T0), ("touches", "LINESTRING(2 2,4 4)", T0), ("leaves", "LINESTRING(2 2,4.5 2)", T0),
            ("both", "POLYGON((3.2 3.2,3.8 3.2,3.8 3.8,3.2 3.2))", T0), ("point", "POINT(3.5 3.5)", T0), ("none", None, T0)]
    links = link.link_within(objects(spark, rows).coalesce(1), areas, "id", "geometry", carry=())
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["com_code"]) for r in links.collect()) == [
        ("both", "a"), ("both", "b"), ("in", "a"), ("point", "a"), ("point", "b"), ("touches", "a")]
    assert plan.count("RoundRobinPartitioning(8)") == 3  # areas for points, areas for shapes, shapes
