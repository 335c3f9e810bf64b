"""Quadtree coverings and exact shared areas against shoelace areas and convex clipping."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from stationflow.operators import geometry as geo

PART = "struct<hole:boolean,points:array<struct<x:double,y:double>>>"


def shoelace(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def clip(ring, by):
    """Convex ``ring`` cut by convex counter-clockwise ``by`` (Sutherland-Hodgman)."""
    out = ring
    for (ax, ay), (bx, by_) in zip(by, by[1:] + by[:1], strict=True):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by_ - ay) * (p[0] - ax)  # noqa: B023, E731
        new = []
        for p, q in zip(out, out[1:] + out[:1], strict=True):
            s, t = side(p), side(q)
            if s >= 0:
                new.append(p)
            if (s > 0 > t) or (s < 0 < t):
                new.append(tuple(p[i] + (q[i] - p[i]) * s / (s - t) for i in (0, 1)))
        out = new
        if not out:
            return []
    return out


def disc(x, y, r, n=32):
    return [(x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)) for i in range(n)]


def star(rnd, x, y, r, n):
    return [(x + r * f * math.cos(2 * math.pi * i / n), y + r * f * math.sin(2 * math.pi * i / n)) for i in range(n) for f in [rnd.uniform(0.5, 1)]]


def shapes(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} string, parts array<{PART}>")


def solid(*rings):
    return [(False, r) for r in rings]


@pytest.fixture(scope="module")
def polygons():
    """Parts (hole, ring) by name, and their areas."""
    rnd = random.Random(11)
    square = [(0.0, 0.0), (1600.0, 0.0), (1600.0, 1600.0), (0.0, 1600.0)]
    outer, hole, island = star(rnd, 777.7, -333.3, 1500, 40), star(rnd, 777.7, -333.3, 600, 25), star(rnd, 777.7, -333.3, 200, 9)
    made = {
        "cell": ([(False, square)], 1600.0**2),
        "backwards": ([(False, square[::-1])], 1600.0**2),
        "triangle": ([(False, [(10.0, 10.0), (10.0, 2000.5), (1999.1, 20.2)])], None),
        "hole and island": ([(False, outer), (True, hole), (False, island)], shoelace(outer) - shoelace(hole) + shoelace(island)),
        "hole the other way": ([(False, outer[::-1]), (True, hole)], shoelace(outer) - shoelace(hole)),
        "two": ([(False, star(rnd, 0, 0, 100, 7)), (False, star(rnd, 9000.0, 50.0, 900, 11))], None),
        "closed ring": ([(False, [*square, square[0]])], 1600.0**2),
        "point": ([(False, [(5.0, 5.0)])], 0.0),
        "flat": ([(False, [(5.0, 5.0), (50.0, 5.0), (25.0, 5.0)])], 0.0),
        "many points": ([(False, disc(3000.0, 3000.0, 1234.5, 400))], None),
    }
    return {k: (p, abs(sum(shoelace(r) for _, r in p)) if a is None else a) for k, (p, a) in made.items()}


def test_covering_has_the_polygons_area(spark, polygons):
    df = shapes(spark, [*((k, p) for k, (p, _) in polygons.items()), ("null", None), ("empty", [])], "geo_id")
    cells = geo.covering(df, "geo_id").cache()
    got = {r.geo_id: float(r.area) for r in geo.total_areas(cells, "geo_id").collect()}
    want = {k: a for k, (_, a) in polygons.items() if a > 0}
    assert got.keys() == want.keys()
    for k, a in want.items():
        assert got[k] == pytest.approx(a, rel=1e-9), k
    # each place once: no cell is given twice, none lies in a larger one of its shape
    own = cells.select("geo_id", *geo.CELL)
    assert own.distinct().count() == own.count()
    above = geo._with_ancestors(own, strict=True).select("geo_id", F.col("_l").alias("level"), F.col("_x").alias("qx"), F.col("_y").alias("qy"))
    assert above.join(own, ["geo_id", *geo.CELL]).count() == 0
    # far fewer rows than 25 m cells have
    assert cells.count() < sum(want.values()) / 25**2 / 8


def test_whole_cells_stay_large(spark, polygons):
    cells = geo.covering(shapes(spark, [("cell", polygons["cell"][0])], "geo_id"), "geo_id").collect()
    assert [(r.level, r.qx, r.qy, r.inside) for r in cells] == [(0, 0, 0, True)]


def test_shared_areas_of_convex_shapes(spark):
    rnd = random.Random(5)
    discs = {f"a{i}": disc(rnd.uniform(0, 3000), rnd.uniform(0, 3000), rnd.uniform(50, 900)) for i in range(12)}
    boxes = {}
    for i in range(8):
        x, y, w, h = rnd.uniform(0, 2000), rnd.uniform(0, 2000), rnd.uniform(100, 1500), rnd.uniform(100, 1500)
        boxes[f"b{i}"] = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    boxes["b8"] = [(0.0, 0.0), (6400.0, 0.0), (6400.0, 6400.0), (0.0, 6400.0)]  # whole cells on every side
    boxes["b9"] = discs["a3"]  # the very same border
    a = geo.covering(shapes(spark, [(k, solid(r)) for k, r in discs.items()], "a"), "a")
    b = geo.covering(shapes(spark, [(k, solid(r)) for k, r in boxes.items()], "b"), "b")
    got = {(r.a, r.b): float(r.shared) for r in geo.shared_areas(a, "a", b, "b").collect()}
    want = {(i, j): shoelace(c) for i, r in discs.items() for j, s in boxes.items() if len(c := clip(r, s)) > 2}
    want = {k: v for k, v in want.items() if v > 1e-6}
    assert {k for k, v in got.items() if v > 1e-6} == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-5), k


def test_buffers_of_several_entrances_and_tracts_with_holes(spark):
    """The union of two discs within a tract with a hole: by inclusion and exclusion."""
    one, two = disc(700, 800, 500), disc(1200, 900, 400)
    box, hole = [(100.0, 100.0), (1500.0, 100.0), (1500.0, 1300.0), (100.0, 1300.0)], disc(900, 850, 150)

    def union(by):
        both = clip(clip(one, two), by)
        return shoelace(clip(one, by)) + shoelace(clip(two, by)) - (shoelace(both) if both else 0)

    wide = [(-9e3, -9e3), (9e3, -9e3), (9e3, 9e3), (-9e3, 9e3)]
    c = geo.covering(shapes(spark, [("s", solid(one, two))], "station_complex_id"), "station_complex_id")
    t = geo.covering(shapes(spark, [("t", [(False, box), (True, hole)])], "geo_id"), "geo_id")
    (r,) = geo.clipped_weights(c, t).collect()
    assert r.buffer_area == pytest.approx(union(wide), rel=1e-9)
    assert r.tract_area == pytest.approx(shoelace(box) - shoelace(hole), rel=1e-9)
    assert r.intersect_area == pytest.approx(union(box) - union(hole), rel=1e-9)
    assert r.catchment_weight == pytest.approx(r.intersect_area / r.buffer_area) and r.tract_coverage_pct == pytest.approx(r.intersect_area / r.tract_area)


def test_disc_helper(spark):
    made = spark.createDataFrame([(700.0, 800.0)], "x double, y double").select(geo.disc(F.col("x"), F.col("y"), 500.0, 32).alias("p")).first().p
    assert [tuple(q) for q in made.points] == [pytest.approx(q) for q in disc(700, 800, 500)] and not made.hole


def test_coverings_and_joins_run_no_python(spark, polygons):
    df = geo.covering(shapes(spark, [("x", polygons["triangle"][0])], "geo_id"), "geo_id")
    plan = geo.shared_areas(df.withColumnRenamed("geo_id", "a"), "a", df, "geo_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
