"""Geometry as nested arrays of points, and the maths on them as native expressions.

A geometry is ``struct<srid, type, parts>`` (see ``concordat.types``). All rings of a polygon
sit in one part; the rings of its holes need no mark, because containment counts crossings
over all rings.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat.types import GEOMETRY, PARTS

# Type names as text and JSON spell them.
KINDS = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")

_NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
_WKT_PAIR = rf"({_NUMBER})\s+({_NUMBER})(?:\s+{_NUMBER}){{0,2}}"
_JSON_PAIR = rf"\[\s*({_NUMBER})\s*,\s*({_NUMBER})(?:\s*,\s*{_NUMBER}){{0,2}}\s*\]"
_XY = '{"x":$1,"y":$2}'
_JSON_OPTIONS = {"allowNumericLeadingZeros": "true"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a value inside an expression, so that it is planned and computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _kind(word: Column) -> Column:
    names = F.create_map(*[F.lit(v) for kind in KINDS for v in (kind.upper(), kind)])
    return F.try_element_at(names, F.upper(word))


def _nest(kind: Column, body: Column, point_is_bare: bool) -> Column:
    """Wrap coordinate text so that every type reads as parts of rings of points."""
    each_point = F.regexp_replace(body, r"\{([^{}]*)\}", r"[[{$1}]]")
    if not point_is_bare:
        # Text may put each point of a multipoint in its own parentheses.
        each_point = F.regexp_replace(F.regexp_replace(body, r"\[(\{[^{}]*\})\]", "$1"),
                                      r"\{([^{}]*)\}", r"[[{$1}]]")
    each_line = F.regexp_replace(body, r"\[([^\[\]]*)\]", r"[[$1]]")
    point = F.concat(F.lit("[[["), body, F.lit("]]]")) if point_is_bare else F.concat(F.lit("[["), body, F.lit("]]"))
    bracketed_points = each_point if point_is_bare else F.regexp_replace(each_point, r"^(?!\[\[\[)(.*)$", "[$1]")
    return (
        F.when(kind == "Point", point)
        .when(kind == "LineString", F.concat(F.lit("[["), body, F.lit("]]")))
        .when(kind == "Polygon", F.concat(F.lit("["), body, F.lit("]")))
        .when(kind == "MultiPoint", bracketed_points)
        .when(kind == "MultiLineString", each_line)
        .otherwise(body)
    )


def _valid(kind: Column, parts: Column) -> Column:
    """No hole in the coordinates, enough points per line, rings closed."""
    polygon = kind.endswith("Polygon")
    least = F.when(polygon, 4).when(kind.endswith("LineString"), 2).otherwise(1)

    def ring_ok(ring: Column) -> Column:
        complete = F.forall(ring, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
        closed = ~polygon | (F.element_at(ring, 1) == F.element_at(ring, -1))
        return ring.isNotNull() & (F.size(ring) >= least) & complete & closed

    return F.forall(parts, lambda part: (F.size(part) > 0) & F.forall(part, ring_ok))


def _assemble(kind: Column, parts: Column, srid: int) -> Column:
    made = F.struct(F.lit(srid).alias("srid"), kind.alias("type"), parts.alias("parts")).cast(GEOMETRY)
    return let(
        made,
        lambda g: F.when(
            g["type"].isNotNull() & g["parts"].isNotNull() & F.coalesce(_valid(g["type"], g["parts"]), F.lit(False)),
            g,
        ),
    )


def from_wkt(c: Column, srid: int) -> Column:
    """Parse well-known text and assign ``srid``; text that does not parse gives NULL."""
    text = F.trim(c)
    body = F.regexp_extract(text, r"(?is)^[a-z]+\s*(?:ZM|Z|M)?\s*(\(.*\))$", 1)
    read = F.struct(
        _kind(F.regexp_extract(text, r"(?i)^((?:MULTI)?(?:POINT|LINESTRING|POLYGON))\b", 1)).alias("kind"),
        text.rlike(r"(?i)^[a-z]+\s+(?:(?:ZM|Z|M)\s+)?EMPTY$").alias("empty"),
        let(body, _json_numbers).alias("body"),
    )

    def build(r: Column) -> Column:
        json = F.translate(F.regexp_replace(r["body"], _WKT_PAIR, _XY), "()", "[]")
        nested = let(json, lambda j: _nest(r["kind"], j, point_is_bare=False))
        parts = F.when(r["empty"], F.array().cast(PARTS)).otherwise(F.from_json(nested, PARTS, _JSON_OPTIONS))
        return _assemble(r["kind"], parts, srid)

    return let(read, build)


def _json_numbers(body: Column) -> Column:
    """Respell numbers JSON lacks: a leading plus, a bare leading or trailing point."""
    plain = F.regexp_replace(body, r"(?<![eE])\+", "")
    plain = F.regexp_replace(plain, r"(?<!\d)\.(?=\d)", "0.")
    plain = F.regexp_replace(plain, r"(?<=\d)\.(?!\d)", "")
    return F.when(body.rlike(r"\+|(?<!\d)\.|\.(?!\d)"), plain).otherwise(body)


def from_geojson(c: Column, srid: int) -> Column:
    """Parse a GeoJSON geometry, which is in longitude and latitude, and reproject it to ``srid``."""

    def build(r: Column) -> Column:
        json = F.regexp_replace(r["coordinates"], _JSON_PAIR, _XY)
        nested = let(json, lambda j: _nest(_kind(r["type"]), j, point_is_bare=True))
        return _assemble(_kind(r["type"]), F.from_json(nested, PARTS, _JSON_OPTIONS), 4326)

    read = F.from_json(c, "type string, coordinates string")
    return transform(let(read, build), srid, source_srid=4326)


def point(x: Column, y: Column, srid: int) -> Column:
    """A point, or NULL when either coordinate is missing."""
    ring = F.array(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    made = F.struct(
        F.lit(srid).alias("srid"), F.lit("Point").alias("type"), F.array(F.array(ring)).alias("parts")
    ).cast(GEOMETRY)
    return F.when(x.isNotNull() & y.isNotNull(), made)


def point_from_lat_lon(lat_lon: Column, srid: int = 4326) -> Column:
    """Point of a two-element array that holds latitude first."""
    return point(F.try_element_at(lat_lon, F.lit(2)), F.try_element_at(lat_lon, F.lit(1)), srid)


def set_srid(geometry: Column, srid: int) -> Column:
    return F.when(geometry.isNotNull(), geometry.withField("srid", F.lit(srid)))


# --- reprojection -------------------------------------------------------------------------

# The public definition of EPSG:2154 on the GRS80 ellipsoid.
_A = 6378137.0
_INVERSE_FLATTENING = 298.257222101
_LAT_ORIGIN, _LON_ORIGIN = 46.5, 3.0
_PARALLELS = (44.0, 49.0)
_FALSE_EASTING, _FALSE_NORTHING = 700000.0, 6600000.0


def _conic() -> tuple[float, float, float, float]:
    """Excentricity, cone exponent, radius constant and northing of the cone's apex."""
    flat = 1 / _INVERSE_FLATTENING
    e = math.sqrt(2 * flat - flat * flat)

    def isometric(lat: float) -> float:
        s = math.sin(lat)
        return math.atanh(s) - e * math.atanh(e * s)

    def parallel_radius(lat: float) -> float:
        return _A * math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)

    low, high = (math.radians(p) for p in _PARALLELS)
    n = math.log(parallel_radius(low) / parallel_radius(high)) / (isometric(high) - isometric(low))
    c = parallel_radius(low) / n * math.exp(n * isometric(low))
    apex = _FALSE_NORTHING + c * math.exp(-n * isometric(math.radians(_LAT_ORIGIN)))
    return e, n, c, apex


_E, _N, _C, _APEX = _conic()


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    s = F.sin(F.radians(lat))
    radius = _C * F.exp(-_N * (F.atanh(s) - _E * F.atanh(_E * s)))
    angle = _N * F.radians(lon - _LON_ORIGIN)
    return _FALSE_EASTING + radius * F.sin(angle), _APEX - radius * F.cos(angle)


def inverse_lambert93(x: Column, y: Column) -> tuple[Column, Column]:
    east, south = x - _FALSE_EASTING, _APEX - y
    isometric = -F.ln(F.hypot(east, south) / _C) / _N
    # The fixed point converges by the square of the excentricity per step.
    lat = 2 * F.atan(F.exp(isometric)) - math.pi / 2
    for _ in range(6):
        lat = 2 * F.atan(F.exp(isometric + _E * F.atanh(_E * F.sin(lat)))) - math.pi / 2
    return _LON_ORIGIN + F.degrees(F.atan2(east, south)) / _N, F.degrees(lat)


_PROJECTIONS: dict[tuple[int, int], Callable[[Column, Column], tuple[Column, Column]]] = {
    (4326, 2154): lambert93,
    (2154, 4326): inverse_lambert93,
}


def _map_points(parts: Column, f: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    def moved(p: Column) -> Column:
        x, y = f(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, moved)))


def transform(geometry: Column, to_srid: int, source_srid: int | None = None) -> Column:
    """Reproject between 4326 and 2154; other pairs of systems give NULL.

    When ``source_srid`` is known the plan holds only the formula needed.
    """
    if source_srid == to_srid:
        return geometry
    known = [source_srid] if source_srid is not None else sorted({a for a, b in _PROJECTIONS if b == to_srid})
    if not known or any((srid, to_srid) not in _PROJECTIONS for srid in known):
        raise ValueError(f"no projection from {source_srid or 'any system'} to {to_srid}")

    def moved(g: Column) -> Column:
        result = F.when(g["srid"] == to_srid, g)
        for srid in known:
            there = F.struct(
                F.lit(to_srid).alias("srid"),
                g["type"].alias("type"),
                _map_points(g["parts"], _PROJECTIONS[srid, to_srid]).alias("parts"),
            ).cast(GEOMETRY)
            result = result.when(g["srid"] == srid, there)
        return result

    return let(geometry, moved)


# --- rendering ----------------------------------------------------------------------------


def _digits(value: Column, places: int) -> Column:
    """Plain decimal text without an exponent or trailing zeros."""
    fixed = F.round(value, places).try_cast(f"decimal(38,{places})").cast("string")
    return F.coalesce(F.regexp_replace(fixed, r"\.?0+$", ""), value.cast("string"))


def _join(items: Column, left: str, right: str, separator: str) -> Column:
    return F.concat(F.lit(left), F.array_join(items, separator), F.lit(right))


def to_wkt(geometry: Column, places: int = 15) -> Column:
    return let(geometry, lambda g: _wkt(g, places))


def _wkt(geometry: Column, places: int) -> Column:
    kind, parts = geometry["type"], geometry["parts"]

    def points(ring: Column) -> Column:
        pair = lambda p: F.concat(_digits(p["x"], places), F.lit(" "), _digits(p["y"], places))
        return _join(F.transform(ring, pair), "(", ")", ",")

    def text(rings: Column) -> Column:
        return (
            F.when(F.size(rings) == 0, F.lit(" EMPTY"))
            .when(kind.isin("Point", "LineString"), F.get(F.get(rings, F.lit(0)), F.lit(0)))
            .when(kind == "Polygon", _join(F.get(rings, F.lit(0)), "(", ")", ","))
            .when(kind == "MultiPolygon",
                  _join(F.transform(rings, lambda part: _join(part, "(", ")", ",")), "(", ")", ","))
            .otherwise(_join(F.flatten(rings), "(", ")", ","))
        )

    body = let(F.transform(parts, lambda part: F.transform(part, points)), text)
    return F.when(geometry.isNotNull(), F.concat(F.upper(kind), body))


def to_geojson(geometry: Column, places: int = 9) -> Column:
    return let(geometry, lambda g: _geojson(g, places))


def _geojson(geometry: Column, places: int) -> Column:
    kind, parts = geometry["type"], geometry["parts"]

    def pair(p: Column) -> Column:
        return F.concat(F.lit("["), _digits(p["x"], places), F.lit(","), _digits(p["y"], places), F.lit("]"))

    def text(rings: Column) -> Column:
        points = F.flatten(F.flatten(rings))
        lines = F.transform(F.flatten(rings), lambda ring: _join(ring, "[", "]", ","))
        polygons = F.transform(
            rings,
            lambda part: _join(F.transform(part, lambda ring: _join(ring, "[", "]", ",")), "[", "]", ","),
        )
        return (
            F.when(F.size(rings) == 0, F.lit("[]"))
            .when(kind == "Point", F.get(points, F.lit(0)))
            .when(kind == "MultiPoint", _join(points, "[", "]", ","))
            .when(kind == "LineString", F.get(lines, F.lit(0)))
            .when(kind == "MultiLineString", _join(lines, "[", "]", ","))
            .when(kind == "Polygon", F.get(polygons, F.lit(0)))
            .otherwise(_join(polygons, "[", "]", ","))
        )

    pairs = F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, pair)))
    return F.when(
        geometry.isNotNull(),
        F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), let(pairs, text), F.lit("}")),
    )


# --- containment --------------------------------------------------------------------------


def vertices(geometry: Column) -> Column:
    return F.flatten(F.flatten(geometry["parts"]))


def edges(geometry: Column) -> Column:
    """All segments of all rings, as ``struct<x1,y1,x2,y2>`` that run upwards (``y1 <= y2``)."""

    def of_ring(ring: Column) -> Column:
        def segment(p: Column, i: Column) -> Column:
            q = F.get(ring, i + 1)
            up = p["y"] <= q["y"]
            ends = {"x1": ("x", 0), "y1": ("y", 0), "x2": ("x", 1), "y2": ("y", 1)}
            return F.struct(
                *[F.when(up, (p, q)[k][a]).otherwise((q, p)[k][a]).alias(n) for n, (a, k) in ends.items()]
            )

        return F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), segment)

    return F.flatten(F.transform(F.flatten(geometry["parts"]), of_ring))


def bounds(geometry: Column) -> dict[str, Column]:
    xs = F.transform(vertices(geometry), lambda p: p["x"])
    ys = F.transform(vertices(geometry), lambda p: p["y"])
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)}


def _turn(e: Column, x: Column, y: Column) -> Column:
    """Positive when (x, y) lies left of the upward segment, zero when on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _on_segment(e: Column, x: Column, y: Column) -> Column:
    return (
        (e["y1"] <= y)
        & (y <= e["y2"])
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & (_turn(e, x, y) == 0)
    )


def _odd_crossings(segments: Column, x: Column, y: Column) -> Column:
    """A ray from (x, y) towards growing x meets an odd number of segments.

    No division, so horizontal segments need no special case.
    """
    crossed = F.filter(segments, lambda e: (e["y1"] <= y) & (y < e["y2"]) & (_turn(e, x, y) > 0))
    return F.size(crossed) % 2 == 1


def on_boundary(segments: Column, x: Column, y: Column) -> Column:
    return F.exists(segments, lambda e: _on_segment(e, x, y))


def strictly_inside(segments: Column, x: Column, y: Column) -> Column:
    """Inside the area drawn by ``segments`` and not on its boundary."""
    return _odd_crossings(segments, x, y) & ~on_boundary(segments, x, y)


def covers_point(segments: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return _odd_crossings(segments, x, y) | on_boundary(segments, x, y)


def _cuts(segment: Column, area_vertices: Column) -> Column:
    """Points of a segment to probe: halfway between its ends and the area vertices it touches."""
    return let(segment, lambda e: _middles(e, area_vertices))


def _middles(segment: Column, area_vertices: Column) -> Column:
    dx, dy = segment["x2"] - segment["x1"], segment["y2"] - segment["y1"]
    length = dx * dx + dy * dy
    touching = F.filter(area_vertices, lambda v: _on_segment(segment, v["x"], v["y"]))
    at = F.transform(
        touching,
        lambda v: F.try_divide((v["x"] - segment["x1"]) * dx + (v["y"] - segment["y1"]) * dy, length),
    )
    ends = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), at)))

    def halves(stops: Column) -> Column:
        return F.transform(
            F.slice(stops, 1, F.size(stops) - 1), lambda t, i: (t + F.get(stops, i + 1)) / 2
        )

    return F.transform(
        let(ends, halves),
        lambda t: F.struct((segment["x1"] + t * dx).alias("x"), (segment["y1"] + t * dy).alias("y")),
    )


def contains(area: Column, inner: Column) -> Column:
    """The polygonal ``area`` contains ``inner``: nothing outside, and not only on the boundary.

    Shapes are probed at their vertices and between the places where they touch the area,
    and may not cross its boundary nor enclose a hole of it.
    """

    def test(s: Column) -> Column:
        area_edges, area_vertices = s["area_edges"], s["area_vertices"]
        inner_edges, probes = s["inner_edges"], s["probes"]
        all_covered = F.forall(probes, lambda p: covers_point(area_edges, p["x"], p["y"]))
        crossing = F.exists(inner_edges, lambda b: F.exists(area_edges, lambda a: _proper_cross(a, b)))
        some_inside = F.exists(probes, lambda p: strictly_inside(area_edges, p["x"], p["y"]))
        hole_enclosed = F.exists(area_vertices, lambda v: strictly_inside(inner_edges, v["x"], v["y"]))
        return (
            (F.size(probes) > 0)
            & all_covered
            & ~crossing
            & F.when(s["polygon"], ~hole_enclosed).otherwise(some_inside)
        )

    def with_probes(s: Column) -> Column:
        cuts = F.flatten(F.transform(s["inner_edges"], lambda e: _cuts(e, s["area_vertices"])))
        return let(s.withField("probes", F.concat(s["inner_vertices"], cuts)), test)

    shapes = F.struct(
        edges(area).alias("area_edges"),
        vertices(area).alias("area_vertices"),
        edges(inner).alias("inner_edges"),
        vertices(inner).alias("inner_vertices"),
        inner["type"].endswith("Polygon").alias("polygon"),
    )
    return let(shapes, with_probes)


def _proper_cross(a: Column, b: Column) -> Column:
    """The interiors of two segments meet in one point."""
    return (_turn(a, b["x1"], b["y1"]) * _turn(a, b["x2"], b["y2"]) < 0) & (
        _turn(b, a["x1"], a["y1"]) * _turn(b, a["x2"], a["y2"]) < 0
    )
