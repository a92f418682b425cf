"""Link objects to the areas that contain them, without comparing every pair.

Areas are cut into the cells of a grid whose step fits their size; an object falls into one
cell per step in use. Joining on the cell leaves few candidates, which the exact test decides.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import geometry as G
from concordat.operators.incremental import EPOCH, since

# Area columns carried onto the link so that most uses need no further join.
CARRIED = ("com_name", "epci_code", "epci_name", "dep_code", "dep_name", "reg_code", "reg_name")
# Fixed value: key of the row that carries the watermark of a link table.
MARKER = "INCREMENTAL_MARKER_DUMMY"
MARK_COLUMN = "translated_last_changed"
# An area spans at most this many cells of its own step in each direction, plus one.
_SPAN = 8
_STEP = 4
# Areas in cells are broadcast up to this size, counting so much per row and per point.
BROADCAST_BYTES = 128 << 20
# Objects of a cell that one share of it takes, and what names a cell.
CROWD = 20_000
_CELL = ["level", "cx", "cy"]
_ROW_BYTES, _POINT_BYTES = 256, 16


def marked(links: DataFrame) -> Column:
    """Whether a row is the one that carries the watermark: its ids are the marker, whatever an area is called."""
    object_id, area_id = (F.coalesce(F.col(f"`{c}`").cast("string") == MARKER, F.lit(False)) for c in links.columns[:2])
    return object_id & area_id


def link_watermark(links: DataFrame | None) -> datetime.datetime:
    if links is None:
        return EPOCH
    found = links.filter(marked(links)).agg(F.max(MARK_COLUMN)).first()[0]
    return EPOCH if found is None else found


def _size_power() -> Column:
    """Size of an area rounded up to a power of two; NULL for a single point."""
    size = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return F.when(size > 0, F.ceil(F.log2(size))).cast("int")


class _Grid(NamedTuple):
    cell: float
    level_of: dict[int, int]
    bytes_bound: int


def _grid(areas: DataFrame, cell: float | None) -> _Grid:
    """Base step, the level of each size, and a bound on the size of all area cells.

    It all comes from the histogram of area sizes. Sizes are powers of two, so only a few dozen
    counts reach the driver.
    """
    histogram = areas.groupBy(_size_power().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("edges")).alias("edges")
    ).collect()
    counts = {r["p"]: r["n"] for r in histogram if r["p"] is not None}
    if cell is None:
        seen, median = 0, 0
        for p in sorted(counts):
            seen, median = seen + counts[p], p
            if seen * 2 >= sum(counts.values()):
                break
        cell = 2.0**median / _SPAN
    level_of = {p: max(0, math.ceil(math.log(2.0**p / (cell * _SPAN), _STEP) - 1e-9)) for p in counts}
    # No ring has more points than twice its segments, nor an area more cells than its span squared.
    per_area = sum(_ROW_BYTES * r["n"] + 2 * _POINT_BYTES * (r["edges"] or 0) for r in histogram)
    return _Grid(cell, level_of, per_area * (_SPAN + 1) ** 2)


def _levels(level_of: dict[int, int]) -> list[int]:
    return sorted({0, *level_of.values()})


def _step(level: Column, levels: Sequence[int], cell: float) -> Column:
    result = F.lit(cell * _STEP ** levels[-1])
    for n in levels[:-1]:
        result = F.when(level == n, F.lit(cell * _STEP**n)).otherwise(result)
    return result


def _at(value: Column, step: Column) -> Column:
    return F.floor(value / step)


def _area_cells(areas: DataFrame, cell: float, level_of: dict[int, int], whole_shapes: bool) -> DataFrame:
    """One row per area and cell, with the segments that can decide a point of that cell.

    ``edges`` is NULL where every point of the cell is inside.
    """
    level = F.lit(0)
    if level_of:
        table = F.create_map(*[F.lit(v) for item in level_of.items() for v in item])
        level = F.coalesce(F.try_element_at(table, _size_power()), level)
    levels = _levels(level_of)
    placed = areas.withColumn("level", level).withColumn("step", _step(F.col("level"), levels, cell))
    step = F.col("step")
    rows = placed.withColumn("cy", F.explode(F.sequence(_at(F.col("ymin"), step), _at(F.col("ymax"), step))))
    band = lambda e: (_at(e["y1"], step) <= F.col("cy")) & (_at(e["y2"], step) >= F.col("cy"))
    rows = rows.withColumn("edges", F.filter("edges", band))
    cells = rows.withColumn("cx", F.explode(F.sequence(_at(F.col("xmin"), step), _at(F.col("xmax"), step))))
    # A ray towards growing x meets nothing that ends left of the cell.
    cells = cells.withColumn(
        "edges", F.filter("edges", lambda e: _at(F.greatest(e["x1"], e["x2"]), step) >= F.col("cx"))
    )
    # A cell no segment comes near is either wholly inside or has nothing to do with the area.
    margin = step * 1e-6
    left, right = F.col("cx") * step - margin, (F.col("cx") + 1) * step + margin
    low, high = F.col("cy") * step - margin, (F.col("cy") + 1) * step + margin
    near = F.exists(
        "edges",
        lambda e: (e["y1"] <= high) & (e["y2"] >= low)
        & (F.least(e["x1"], e["x2"]) <= right) & (F.greatest(e["x1"], e["x2"]) >= left),
    )
    middle = G.strictly_inside(F.col("edges"), (F.col("cx") + 0.5) * step, (F.col("cy") + 0.5) * step)
    cells = cells.withColumn("cut", near).filter(F.col("cut") | middle)
    if whole_shapes:
        return cells.drop("step", "edges", "cut")
    return cells.withColumn("edges", F.when(F.col("cut"), F.col("edges"))).drop("step", "cut")


def _spread(rows: DataFrame) -> DataFrame:
    """The rows in as many tasks as a shuffle has: a small file of them makes work out of proportion to its bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _measure(cells: DataFrame, whole_shapes: bool) -> int:
    points = F.size(G.vertices(F.col("outline"))) if whole_shapes else 2 * F.greatest(F.size("edges"), F.lit(0))
    found = cells.agg(F.count(F.lit(1)).alias("rows"), F.sum(points).alias("points")).first()
    return _ROW_BYTES * found["rows"] + _POINT_BYTES * (found["points"] or 0)


def _meet(
    placed: DataFrame, cells: DataFrame, bytes_bound: int, whole_shapes: bool, salts: int | None
) -> DataFrame:
    """Objects and the areas of their cell.

    The cells are broadcast when the bound on their size, or else their measured size, allows. Otherwise both sides are
    shuffled on the cell and a share of it. The objects of every cell are counted first: a cell with more than CROWD of
    them is split into as many shares as hold CROWD each, and only the areas of such cells are copied. ``salts`` gives
    every cell so many shares instead. Spark's own estimate knows nothing of the cells an area makes, so it does not decide.
    """
    if salts is None and (bytes_bound <= BROADCAST_BYTES or _measure(cells, whole_shapes) <= BROADCAST_BYTES):
        return placed.join(F.broadcast(cells), _CELL)
    if salts is None:
        placed, cells = _shared_out(placed, cells)
    else:
        placed, cells = (df.withColumn("shares", F.lit(salts)) for df in (placed, cells))
    placed = placed.withColumn("share", F.pmod(F.xxhash64("oid", "px", "py"), F.col("shares")).cast("int"))
    cells = cells.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    return placed.drop("shares").join(cells.drop("shares").hint("merge"), [*_CELL, "share"])


def _shared_out(placed: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number of shares of their cell, from the counts of objects, which are added up before a shuffle."""
    crowds = placed.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("crowd")).where(F.col("crowd") > CROWD)
    shares = crowds.select(*_CELL, F.ceil(F.col("crowd") / CROWD).cast("int").alias("shares"))
    return tuple(df.join(shares, _CELL, "left").withColumn("shares", F.coalesce("shares", F.lit(1))) for df in (placed, cells))


def link_within(
    objects: DataFrame,
    areas: DataFrame,
    object_id: str,
    geometry: str,
    *,
    area_id: str = "com_code",
    area_geometry: str = "geometry",
    carry: Sequence[str] = CARRIED,
    last_changed: str = "last_changed",
    order_by: Sequence[str] | None = None,
    cell: float | None = None,
    salts: int | None = None,
    shapes: bool = True,
    since_mark: datetime.datetime | None = None,
    marker: bool = False,
) -> DataFrame:
    """All pairs of an object and an area that contains it; the boundary does not count as inside.

    - Objects may be points or, with ``shapes``, lines and polygons that must lie inside whole.
      Set ``shapes=False`` for tables known to hold only points, and half of the plan goes away.
    - ``since_mark`` takes only objects changed later, and ``marker`` adds the row that carries the
      watermark of all objects to the next run (see ``link_watermark``).
    - ``salts`` forces a shuffled join that spreads the objects of a cell over so many shares, by a
      hash of their id and place. By default small area tables are broadcast instead.

    Each pair occurs once: an area has one grid step and an object one cell of that step.
    """
    found_in = objects if since_mark is None else since(objects, since_mark, last_changed)
    box = F.col("box")
    # No filter on missing geometry here: it would be pushed down and parse the text a second
    # time, while a missing box makes no cell and a missing place joins with none.
    outlines = (
        _spread(areas.select(area_id, *carry, F.col(area_geometry).alias("outline")))
        .withColumn("edges", G.edges(F.col("outline")))
        .withColumn("box", F.struct(*[c.alias(n) for n, c in G.bounds(F.col("outline")).items()]))
        .select("*", *[box[n].alias(n) for n in ("xmin", "xmax", "ymin", "ymax")])
        .drop("box")
    )
    grid = _grid(outlines, cell)
    cell, levels = grid.cell, _levels(grid.level_of)

    shape = F.col("shape")
    anchor = F.get(F.get(F.get(shape["parts"], F.lit(0)), F.lit(0)), F.lit(0))
    placed = (
        found_in.select(F.col(object_id).alias("oid"), F.col(last_changed).alias("stamp"),
                        F.col(geometry).alias("shape"))
        .withColumns({"px": anchor["x"], "py": anchor["y"]})
        .withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels])))
    )
    step = _step(F.col("level"), levels, cell)
    placed = placed.withColumns({"cx": _at(F.col("px"), step), "cy": _at(F.col("py"), step)})

    kept = [area_id, *carry]
    links = None
    is_point = shape["type"] == "Point"
    for whole in ([False, True] if shapes else [False]):
        cells = _area_cells(outlines if whole else outlines.drop("outline"), cell, grid.level_of, whole)
        some = placed.filter(~is_point) if whole else (placed.filter(is_point) if shapes else placed)
        if whole:
            some = _spread(some).withColumn("reach", F.struct(*[c.alias(n) for n, c in G.bounds(shape).items()]))
        near = _meet(some if whole else some.drop("shape"), cells, grid.bytes_bound, whole, salts).filter(
            F.col("px").between(F.col("xmin"), F.col("xmax")) & F.col("py").between(F.col("ymin"), F.col("ymax"))
        )
        if whole:
            # Shapes that reach beyond the area's box are told without a look at its outline.
            fits = (F.col("reach.xmax") <= F.col("xmax")) & F.col("reach.ymin").between(F.col("ymin"), F.col("ymax"))
            fits = fits & (F.col("reach.xmin") >= F.col("xmin")) & (F.col("reach.ymax") <= F.col("ymax"))
            near = near.filter(fits).filter(G.contains(F.col("outline"), F.col("shape")))
        else:
            near = near.filter(
                F.col("edges").isNull() | G.strictly_inside(F.col("edges"), F.col("px"), F.col("py"))
            )
        pairs = near.select(F.col("oid").alias(object_id), *kept, F.col("stamp").alias(MARK_COLUMN))
        links = pairs if links is None else links.unionByName(pairs)
    if marker:
        links = links.unionByName(_marker_row(objects, links, object_id, area_id, last_changed))
    return links.orderBy(*order_by) if order_by else links


def _marker_row(
    objects: DataFrame, links: DataFrame, object_id: str, area_id: str, last_changed: str
) -> DataFrame:
    columns = []
    for field in links.schema:
        if field.name in (object_id, area_id):
            if field.dataType.typeName() != "string":
                raise ValueError(f"{field.name} must be text in a table with a marker row")
            columns.append(F.lit(MARKER).alias(field.name))
        elif field.name == MARK_COLUMN:
            columns.append(F.max(last_changed).alias(MARK_COLUMN))
        else:
            columns.append(F.max(F.lit(None).cast(field.dataType)).alias(field.name))
    return objects.agg(*columns)


def tag_perimeter_owner(
    df: DataFrame, perimeters: DataFrame, row_id: str, geometry: str = "geometry", outline: str = "geom", **options
) -> DataFrame:
    """``(row id, perimetre_data_owner_id)`` for each perimeter that contains the row."""
    stamped = df.withColumn("__stamp", F.lit(None).cast("timestamp_ntz"))
    links = link_within(
        stamped, perimeters, row_id, geometry, area_id="data_owner_id", area_geometry=outline,
        carry=(), last_changed="__stamp", **options,
    )
    return links.select(row_id, F.col("data_owner_id").alias("perimetre_data_owner_id"))
