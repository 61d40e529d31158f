import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from sensoria.checks.geometry import edges_to_wkb
from sensoria.functions.projection import utm_to_degrees
from sensoria.operators import geo


def ring_bytes(points, order="<"):
    closed = points + points[:1]
    data = struct.pack(f"{order}I", len(closed))
    for x, y in closed:
        data += struct.pack(f"{order}dd", x, y)
    return data


def polygon_bytes(rings, order="<"):
    head = struct.pack(f"{order}BII", 1 if order == "<" else 0, 3, len(rings))
    return head + b"".join(ring_bytes(ring, order) for ring in rings)


def multipolygon_bytes(polygons, order="<"):
    head = struct.pack(f"{order}BII", 1 if order == "<" else 0, 6, len(polygons))
    return head + b"".join(polygon_bytes(rings, order) for rings in polygons)


L_SHAPE = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]
SHELL = [(10.0, 0.0), (16.0, 0.0), (16.0, 6.0), (10.0, 6.0)]
HOLE = [(12.0, 2.0), (14.0, 2.0), (14.0, 4.0), (12.0, 4.0)]
FAR = [(20.0, 0.0), (22.0, 0.0), (22.0, 2.0), (20.0, 2.0)]


@pytest.fixture(scope="module")
def edges(spark):
    shapes = spark.createDataFrame(
        [
            ("L", bytearray(polygon_bytes([L_SHAPE], ">"))),
            ("H", bytearray(multipolygon_bytes([[SHELL, HOLE], [FAR]]))),
            ("none", None),
        ],
        "z string, geometry binary",
    )
    return geo.polygon_edges(shapes, "z").cache()


def test_edges(edges):
    counts = {
        (r.z, r.part, r.ring): r.n
        for r in edges.groupBy("z", "part", "ring").agg(F.count("*").alias("n")).collect()
    }
    assert counts == {("L", 0, 0): 6, ("H", 0, 0): 4, ("H", 0, 1): 4, ("H", 1, 0): 4}


@pytest.mark.parametrize("cell", [0.01, 0.7, 2.0, 100.0])
def test_containment(spark, edges, cell):
    expected = {
        (1.0, 1.0): "L",
        (1.0, 3.9): "L",
        (3.0, 1.0): "L",
        (3.0, 3.0): None,  # the notch of the L
        (0.0, 1.0): None,  # on an edge
        (2.0, 3.0): None,  # on an inner edge
        (2.0, 2.0): None,  # on the reflex vertex
        (4.0, 0.0): None,  # on a vertex
        (11.0, 2.0): "H",  # level with a vertex of the hole
        (13.0, 3.0): None,  # in the hole
        (12.0, 3.0): None,  # on the hole's edge
        (21.0, 1.0): "H",  # the second part
        (18.0, 1.0): None,
        (-5.0, 1.0): None,
    }
    points = spark.createDataFrame(list(expected), "LONGITUD double, LATITUD double")
    found = geo.locate_points(points, edges, "z", cell=cell).collect()
    assert {(r.LONGITUD, r.LATITUD): r.z for r in found} == expected


def test_points_without_position_stay(spark, edges):
    points = spark.createDataFrame([(None, None)], "LONGITUD double, LATITUD double")
    assert [r.z for r in geo.locate_points(points, edges, "z").collect()] == [None]


def test_cover_of_cells(spark, edges):
    """Inner cells carry no edges, none is a border cell too, and both cover the polygon."""
    cover = geo.cell_cover(edges, "z", 0.3).cache()
    assert cover.groupBy("_zona", "fila", "columna").count().filter("count > 1").isEmpty()
    assert cover.filter("size(_lados) = 0").isEmpty()
    inner = {(r._zona, r.columna, r.fila) for r in cover.filter("_lados IS NULL").collect()}
    border = {(r._zona, r.columna, r.fila) for r in cover.filter("_lados IS NOT NULL").collect()}
    wide = {("L", column, row) for column in range(1, 13) for row in range(1, 6)}
    tall = {("L", column, row) for column in range(1, 6) for row in range(1, 13)}
    assert {cell for cell in inner if cell[0] == "L"} == wide | tall
    assert {("L", 13, 2), ("L", 6, 9), ("L", 0, 0)} <= border
    assert ("H", 43, 10) not in inner | border  # in the hole
    assert ("H", 37, 10) in inner and ("H", 69, 3) in inner
    # edges left of a cell are not its own
    lists = {(r._zona, r.columna, r.fila): len(r._lados) for r in cover.dropna().collect()}
    assert lists["H", 53, 10] == 1 and lists["H", 33, 10] == 4


def test_centroids(edges):
    found = {r.z: (r.CX, r.CY) for r in geo.polygon_centroids(edges, "z").collect()}
    assert found["L"] == pytest.approx((20 / 12, 20 / 12))
    area = 36 - 4 + 4
    center = ((36 * 13 - 4 * 13 + 4 * 21) / area, (36 * 3 - 4 * 3 + 4) / area)
    assert found["H"] == pytest.approx(center)


def test_wkt(edges):
    found = {r.z: r.GEOMETRY_WKT for r in geo.polygon_wkt(edges, "z").collect()}
    assert found["L"] == "POLYGON ((0 0, 4 0, 4 2, 2 2, 2 4, 0 4, 0 0))"
    assert found["H"] == (
        "MULTIPOLYGON (((10 0, 16 0, 16 6, 10 6, 10 0), (12 2, 14 2, 14 4, 12 4, 12 2)), "
        "((20 0, 22 0, 22 2, 20 2, 20 0)))"
    )


def test_wkb_round_trip(edges):
    again = geo.polygon_edges(edges_to_wkb(edges, "z"), "z")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, edges.collect()))


def test_projection_control_points(spark):
    df = spark.createDataFrame(
        [(500000.0, 4474257.0), (440290.458, 4474257.382)], "e double, n double"
    )
    lon, lat = utm_to_degrees(F.col("e"), F.col("n"))
    first, second = df.select(lon.alias("lon"), lat.alias("lat")).collect()
    assert first.lon == -3.0
    assert (second.lat, second.lon) == pytest.approx((40.4168, -3.7038), abs=1e-6)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_containment_matches_brute_force_on_ragged_outlines(spark, threshold):
    """Random stars, and points of which a third share one place."""
    chance = random.Random(11)
    stars, rows = {}, []
    for number in range(6):
        cx, cy = chance.uniform(0, 3), chance.uniform(0, 3)
        corners = []
        for step in range(40):
            angle, radius = 2 * math.pi * step / 40, chance.uniform(0.2, 0.8)
            corners.append((cx + radius * math.cos(angle), cy + radius * math.sin(angle)))
        stars[str(number)] = corners
        rows.append((str(number), bytearray(polygon_bytes([corners]))))
    points = [
        (i, 1.5, 1.5) if i % 3 == 0 else (i, chance.uniform(-1, 4), chance.uniform(-1, 4))
        for i in range(1500)
    ]

    def contains(corners, x, y):
        inside = False
        for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                inside = not inside
        return inside

    expected = set()
    for i, x, y in points:
        hits = [name for name, corners in stars.items() if contains(corners, x, y)]
        expected |= {(i, name) for name in hits or [None]}

    edges = geo.polygon_edges(spark.createDataFrame(rows, "z string, geometry binary"), "z")
    df = spark.createDataFrame(points, "i int, LONGITUD double, LATITUD double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = geo.locate_points(df, edges, "z", cell=0.1).select("i", "z").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert len(found) == len(expected)
    assert {tuple(row) for row in found} == expected
