"""Exact areas of polygons on a quadtree of square cells, in array expressions.

A shape is a list of parts, each a ring of points (closed or open, in either
direction) that adds to the shape or, as a hole, takes away from it; rings that
add may overlap, so the buffers around several entrances are one shape. A point
belongs to the shape where its winding number is positive.

Covering. A shape is cut into root cells of ``root`` metres; a cell that a border
crosses is cut into four, down to ``root / 2**levels``. Cells inside the shape
stay large, so a covering has about as many rows as the border is long, not as
the area is wide. Each cell carries the edges that cross it and, for everything
to its left, the steps of the winding number along its left side; both shrink
with the cell.

Areas. A border cell is cut into slabs at every height where an edge begins,
ends, leaves the cell or meets another edge. Within a slab all borders are
straight and do not meet, so the covered length at half height times the height
is the slab's exact area. Two shapes share area where cells of one contain
cells of the other; only where both have a border in the same cell are edges of
both laid over each other.

No Python runs in a task, and no cell of one shape meets a cell of another but
through an equi-join on the cell's number at one of its levels.

Defined results: a shape without parts, or whose rings enclose nothing, has no
cells; null shapes have none; points may repeat.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import safe_div

ROOT, LEVELS = 1600.0, 4
EDGE = "struct<xl:double,yl:double,xh:double,yh:double,d:int>"
STEP = "struct<y:double,d:int>"
AREA = "decimal(28,9)"  # sums of areas do not depend on the order of rows


def disc(x: Column, y: Column, radius: float, segments: int = 64) -> Column:
    """The part that approximates a disc by a ring of ``segments`` points on its border."""
    points = [F.struct((x + radius * math.cos(2 * math.pi * i / segments)).alias("x"), (y + radius * math.sin(2 * math.pi * i / segments)).alias("y")) for i in range(segments)]
    return part(F.array(*points))


def part(points: Column, hole: bool = False) -> Column:
    return F.struct(F.lit(hole).alias("hole"), points.alias("points"))


def ring_area(points: Column) -> Column:
    """Signed area of a ring: positive if it runs counter-clockwise. Taken from the first point, which keeps the terms small."""
    n = F.size(points)
    first = F.get(points, F.lit(0))
    at = lambda i: F.get(points, i % n)
    cross = lambda p, q: (p["x"] - first["x"]) * (q["y"] - first["y"]) - (q["x"] - first["x"]) * (p["y"] - first["y"])
    return F.aggregate(F.transform(points, lambda p, i: cross(p, at(i + 1))), F.lit(0.0), lambda a, v: a + v) / 2


def part_edges(p: Column) -> Column:
    """The part's edges, lower end first, with what the winding number gains where a line to the right crosses each."""
    points = p["points"]
    n = F.size(points)
    sign = F.when(ring_area(points) > 0, 1).otherwise(-1) * F.when(p["hole"], -1).otherwise(1)

    def edge(a, i):
        b = F.get(points, (i + 1) % n)
        low, high = F.when(a["y"] < b["y"], a).otherwise(b), F.when(a["y"] < b["y"], b).otherwise(a)
        d = F.when(a["y"] > b["y"], sign).when(a["y"] < b["y"], -sign).otherwise(0)
        return F.struct(low["x"].alias("xl"), low["y"].alias("yl"), high["x"].alias("xh"), high["y"].alias("yh"), d.cast("int").alias("d"))

    return F.filter(F.transform(points, edge), lambda e: e["d"] != 0)


def _x(e: Column, y: Column) -> Column:
    """Where an edge is at a height; its ends exactly."""
    between = e["xl"] + (e["xh"] - e["xl"]) * ((y - e["yl"]) / (e["yh"] - e["yl"]))
    return F.when(y <= e["yl"], e["xl"]).when(y >= e["yh"], e["xh"]).otherwise(between)


def _within(v: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.least(v, high), low)


def _sum(values: Column, start) -> Column:
    return F.aggregate(values, start, lambda a, v: a + v)


def _narrowed(cells: DataFrame) -> DataFrame:
    """Cells (with their parent's ``edges`` and ``steps``) with their own, their state, and without those outside."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))

    def side(e, pick):
        low, high = F.greatest(e["yl"], y0), F.least(e["yh"], y1)
        return pick(_x(e, low), _x(e, high))

    reach = F.filter("edges", lambda e: (e["yh"] > y0) & (e["yl"] < y1))
    cells = cells.withColumn("edges", reach)
    left = F.filter("edges", lambda e: side(e, F.greatest) <= x0)
    gone = F.flatten(F.transform(left, lambda e: F.array(
        F.struct(F.greatest(e["yl"], y0).alias("y"), e["d"].alias("d")), F.struct(F.least(e["yh"], y1).alias("y"), (-e["d"]).alias("d")))))
    held = F.transform("steps", lambda s: F.struct(_within(s["y"], y0, y1).alias("y"), s["d"].alias("d")))
    cells = cells.withColumn("steps", F.concat(held, gone)).withColumn("edges", F.filter("edges", lambda e: (side(e, F.greatest) > x0) & (side(e, F.least) < x1)))
    heights = F.array_sort(F.array_distinct(F.transform("steps", lambda s: s["y"])))
    total = lambda y: _sum(F.transform(F.filter("steps", lambda s: s["y"] == y), lambda s: s["d"]), F.lit(0))
    cells = cells.withColumn("steps", F.filter(F.transform(heights, lambda y: F.struct(y.alias("y"), total(y).cast("int").alias("d"))), lambda s: s["d"] != 0))
    first = F.get("steps", F.lit(0))
    whole = (F.size("steps") == 2) & (first["y"] == y0) & (first["d"] > 0) & (F.get("steps", F.lit(1))["y"] == y1)
    cells = cells.withColumn("inside", (F.size("edges") == 0) & whole)
    return cells.filter((F.size("edges") > 0) | (F.size("steps") > 0))


def covered_area(x0, y0, x1, y1, a_edges, a_steps, b_edges=None, b_steps=None) -> Column:
    """Exact area that a shape, or two shapes at once, cover of a box."""
    alone = b_edges is None
    tagged = F.transform(a_edges, lambda e: F.struct(e.alias("e"), e["d"].alias("a"), F.lit(0).alias("b")))
    steps = a_steps
    if not alone:
        tagged = F.concat(tagged, F.transform(b_edges, lambda e: F.struct(e.alias("e"), F.lit(0).alias("a"), e["d"].alias("b"))))
        steps = F.concat(a_steps, b_steps)
    slope = lambda e: (e["xh"] - e["xl"]) / (e["yh"] - e["yl"])

    def meet(t, u):
        e, f = t["e"], u["e"]
        return F.try_divide(f["xl"] - e["xl"] - slope(f) * (f["yl"] - e["yl"]), slope(e) - slope(f)) + e["yl"]

    def reaches(t):
        e = t["e"]
        side = lambda x: F.try_divide(x - e["xl"], slope(e)) + e["yl"]
        return F.array(e["yl"], e["yh"], side(x0), side(x1))

    heights = F.concat(
        F.array(y0, y1), F.transform(steps, lambda s: s["y"]), F.flatten(F.transform(tagged, reaches)),
        F.flatten(F.transform(tagged, lambda t: F.transform(tagged, lambda u: meet(t, u)))),
    )
    cuts = F.array_sort(F.array_distinct(F.filter(heights, lambda y: (y >= y0) & (y <= y1))))
    slabs = F.transform(F.slice(cuts, 1, F.size(cuts) - 1), lambda y, i: F.struct(y.alias("low"), F.get(cuts, i + 1).alias("high")))

    def gained(some, y):
        return _sum(F.transform(F.filter(some, lambda s: s["y"] <= y), lambda s: s["d"]), F.lit(0))

    def length(y):
        crossed = F.filter(tagged, lambda t: (t["e"]["yl"] <= y) & (y < t["e"]["yh"]))
        met = F.array_sort(F.transform(crossed, lambda t: F.struct(_within(_x(t["e"], y), x0, x1).alias("x"), t["a"].alias("a"), t["b"].alias("b"))))
        ends = F.concat(met, F.array(F.struct(x1.alias("x"), F.lit(0).alias("a"), F.lit(0).alias("b"))))
        start = F.struct(
            x0.alias("x"), gained(a_steps, y).cast("int").alias("a"),
            (F.lit(1) if alone else gained(b_steps, y)).cast("int").alias("b"), F.lit(0.0).alias("sum"),
        )
        walked = F.aggregate(ends, start, lambda s, m: F.struct(
            m["x"].alias("x"), (s["a"] + m["a"]).cast("int").alias("a"), (s["b"] + m["b"]).cast("int").alias("b"),
            (s["sum"] + F.when((s["a"] > 0) & (s["b"] > 0), m["x"] - s["x"]).otherwise(0.0)).alias("sum")))
        return walked["sum"]

    return _sum(F.transform(slabs, lambda s: length((s["low"] + s["high"]) / 2) * (s["high"] - s["low"])), F.lit(0.0))


CELL = ["level", "qx", "qy"]


def covering(shapes: DataFrame, key: str, root: float = ROOT, levels: int = LEVELS, parts: str = "parts") -> DataFrame:
    """(key, level, qx, qy, inside, area, edges, steps): the quadtree cells of each shape, cells of size ``root / 2**level``.

    Narrow: a shape's cells are made from its own row, level by level.
    """
    edges = F.flatten(F.transform(parts, part_edges))
    rows = shapes.filter(F.col(parts).isNotNull()).select(F.col(key), edges.alias("edges")).filter(F.size("edges") > 0)
    span = lambda c, fn: fn(F.transform("edges", lambda e: c(e)))
    low, high = lambda f, g: F.floor(F.least(f, g) / root), lambda f, g: F.ceil(F.greatest(f, g) / root)
    rows = rows.withColumns({
        "_xa": low(span(lambda e: e["xl"], F.array_min), span(lambda e: e["xh"], F.array_min)),
        "_xb": high(span(lambda e: e["xl"], F.array_max), span(lambda e: e["xh"], F.array_max)),
        "_ya": F.floor(span(lambda e: e["yl"], F.array_min) / root), "_yb": F.ceil(span(lambda e: e["yh"], F.array_max) / root),
    })
    rows = rows.withColumn("qx", F.explode(F.sequence("_xa", F.greatest(F.col("_xa"), F.col("_xb") - 1))))
    rows = rows.withColumn("qy", F.explode(F.sequence("_ya", F.greatest(F.col("_ya"), F.col("_yb") - 1))))
    cells = rows.select(key, F.lit(0).alias("level"), "qx", "qy", "edges", F.lit([]).cast(f"array<{STEP}>").alias("steps"), F.lit(False).alias("inside"))
    cells = _narrowed(_boxed(cells, root))
    for _ in range(levels):
        # a cell inside stays as it is; any other becomes four
        four = [F.struct((F.col("level") + 1).alias("level"), (F.col("qx") * 2 + i).alias("qx"), (F.col("qy") * 2 + j).alias("qy")) for i in (0, 1) for j in (0, 1)]
        itself = F.array(F.struct("level", "qx", "qy"))
        cells = cells.withColumn("_c", F.explode(F.when(F.col("inside"), itself).otherwise(F.array(*four))))
        cells = _narrowed(_boxed(cells.select(key, "_c.level", "_c.qx", "_c.qy", "edges", "steps", "inside"), root))
    box = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    area = F.when(F.col("inside"), (box[2] - box[0]) * (box[3] - box[1])).otherwise(covered_area(*box, F.col("edges"), F.col("steps")))
    return cells.withColumn("area", area.cast(AREA)).filter("area > 0").select(key, *CELL, "inside", "area", "edges", "steps")


def _boxed(cells: DataFrame, root: float) -> DataFrame:
    size = F.lit(root) / F.pow(F.lit(2.0), F.col("level"))
    return cells.withColumns({"x0": F.col("qx") * size, "y0": F.col("qy") * size, "x1": (F.col("qx") + 1) * size, "y1": (F.col("qy") + 1) * size})


def _with_ancestors(cells: DataFrame, strict: bool) -> DataFrame:
    """A row for each cell at or (``strict``) above the cell: (_l, _x, _y)."""
    up = F.sequence(F.lit(0), F.col("level"))
    up = F.filter(up, lambda n: n < F.col("level")) if strict else up
    above = {f"_{c}": F.expr(f"shiftright(q{c}, level - _l)") for c in "xy"}
    return cells.withColumn("_l", F.explode(up)).withColumns(above)


def shared_areas(a: DataFrame, a_key: str, b: DataFrame, b_key: str, root: float = ROOT) -> DataFrame:
    """(a_key, b_key, shared): area that each two shapes of two coverings (of one ``root``) have in common."""
    names = ["inside", "area", "edges", "steps"]
    a = a.select(F.col(a_key), *CELL, *[F.col(c).alias(f"a_{c}") for c in names])
    b = b.select(F.col(b_key), *CELL, *[F.col(c).alias(f"b_{c}") for c in names])

    def pairs(small, big, strict):
        own = [F.col(c).alias(f"_{c}") for c in CELL]
        large = big.select(*own, *[c for c in big.columns if c not in CELL])
        on = [F.col("_l") == F.col("_level"), F.col("_x") == F.col("_qx"), F.col("_y") == F.col("_qy")]
        met = _with_ancestors(small, strict).join(large, reduce(lambda p, q: p & q, on))
        return met.select(a_key, b_key, *CELL, *[f"{s}_{c}" for s in "ab" for c in names])

    met = _boxed(pairs(a, b, strict=False).unionByName(pairs(b, a, strict=True)), root)
    both = covered_area(*[F.col(c) for c in ("x0", "y0", "x1", "y1")], F.col("a_edges"), F.col("a_steps"), F.col("b_edges"), F.col("b_steps"))
    # a cell inside one shape gives what the other covers of the smaller cell
    area = F.when(F.col("a_inside") & F.col("b_inside"), F.least("a_area", "b_area")).when(F.col("b_inside"), F.col("a_area")).when(F.col("a_inside"), F.col("b_area"))
    met = met.withColumn("shared", F.coalesce(area, both.cast(AREA)))
    return met.groupBy(a_key, b_key).agg(F.sum("shared").cast(AREA).alias("shared")).filter("shared > 0")


def total_areas(cells: DataFrame, key: str) -> DataFrame:
    return cells.groupBy(key).agg(F.sum("area").cast(AREA).alias("area"))


def clipped_weights(catchments: DataFrame, tracts: DataFrame, root: float = ROOT) -> DataFrame:
    """Shared area of each station's catchment and each tract, with the share of the catchment and of the tract.

    Both are coverings: ``catchments`` by ``station_complex_id``, ``tracts`` by ``geo_id``.
    """
    buffers = total_areas(catchments, "station_complex_id").select(F.col("station_complex_id").alias("_s"), F.col("area").alias("buffer_area"))
    whole = total_areas(tracts, "geo_id").select(F.col("geo_id").alias("_g"), F.col("area").alias("tract_area"))
    shared = shared_areas(catchments, "station_complex_id", tracts, "geo_id", root)
    j = shared.join(buffers, F.col("station_complex_id") == F.col("_s")).join(whole, F.col("geo_id") == F.col("_g"))
    ratio = lambda c: safe_div(F.col("shared").cast("double"), F.col(c).cast("double"))
    return j.select(
        "station_complex_id", "geo_id", F.col("shared").cast("double").alias("intersect_area"), F.col("buffer_area").cast("double").alias("buffer_area"),
        F.col("tract_area").cast("double").alias("tract_area"), ratio("buffer_area").alias("catchment_weight"), ratio("tract_area").alias("tract_coverage_pct"),
    )
