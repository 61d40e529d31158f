"""Geometry."""

from pyspark.sql import functions as F

from sensoria.checks.fixtures import Inputs
from sensoria.checks.geometry import edges_to_wkb
from sensoria.checks.registry import check
from sensoria.functions.projection import (
    BETA,
    CENTRAL_MERIDIAN,
    DELTA,
    FALSE_EASTING,
    SCALE,
    _RADIUS,
    utm_to_degrees,
)
from sensoria.operators import geo
from sensoria.operators.cleaning import inside_region


def _edges_sql(view: str) -> str:
    return f"""
        SELECT COD_DIS, 0 AS part, 0 AS ring, 0 AS seq, x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2
        FROM {view}
        UNION ALL SELECT COD_DIS, 0, 0, 1, x1, y0, x1, y1 FROM {view}
        UNION ALL SELECT COD_DIS, 0, 0, 2, x1, y1, x0, y1 FROM {view}
        UNION ALL SELECT COD_DIS, 0, 0, 3, x0, y1, x0, y0 FROM {view}"""


def _degrees_sql(east: str, north: str, source: str, keep: str) -> str:
    """The inverse projection spelled out for the oracle."""
    b, d = BETA, DELTA
    xi = f"({north} / {SCALE * _RADIUS!r})"
    eta = f"(({east} - {FALSE_EASTING}) / {SCALE * _RADIUS!r})"
    return f"""
        SELECT {keep}, {CENTRAL_MERIDIAN} + degrees(atan(sinh(e) / cos(x))) AS lon,
               degrees(c + {d[0]!r} * sin(2 * c) + {d[1]!r} * sin(4 * c)
                       + {d[2]!r} * sin(6 * c)) AS lat
        FROM (SELECT *, asin(sin(x) / cosh(e)) AS c FROM (
          SELECT *,
            {xi} - {b[0]!r} * sin(2 * {xi}) * cosh(2 * {eta})
                 - {b[1]!r} * sin(4 * {xi}) * cosh(4 * {eta})
                 - {b[2]!r} * sin(6 * {xi}) * cosh(6 * {eta}) AS x,
            {eta} - {b[0]!r} * cos(2 * {xi}) * sinh(2 * {eta})
                  - {b[1]!r} * cos(4 * {xi}) * sinh(4 * {eta})
                  - {b[2]!r} * cos(6 * {xi}) * sinh(6 * {eta}) AS e
          FROM {source}))"""


@check("polygon_edges", _edges_sql("v_box_utm"), decimals=None)
def _(inputs: Inputs):
    shapes = edges_to_wkb(inputs.box_edges("v_box_utm"), "COD_DIS")
    return geo.polygon_edges(shapes, "COD_DIS")


_METRES = """(SELECT c_custkey, 400000 + (c_acctbal + 1000) * CAST(9 AS DOUBLE) AS este,
                     4400000 + (c_custkey % 1000) * CAST(150 AS DOUBLE) AS norte
              FROM customer)"""


@check(
    "reproject_utm_wgs84",
    "SELECT c_custkey, ROUND(lon, 8) AS longitud, ROUND(lat, 8) AS latitud FROM ("
    + _degrees_sql("este", "norte", _METRES, "c_custkey")
    + ")",
    decimals=8,
)
def _(inputs: Inputs):
    metres = inputs.table("customer").select(
        "c_custkey",
        (F.lit(400000) + (F.col("c_acctbal") + 1000) * F.lit(9.0)).alias("este"),
        (F.lit(4400000) + (F.col("c_custkey") % 1000) * F.lit(150.0)).alias("norte"),
    )
    lon, lat = utm_to_degrees(F.col("este"), F.col("norte"))
    return metres.select("c_custkey", lon.alias("longitud"), lat.alias("latitud"))


@check(
    "point_in_polygon",
    """SELECT s.ID_AIRE, s.LONGITUD, s.LATITUD, b.COD_DIS FROM v_station s
       LEFT JOIN v_box b ON s.LONGITUD > b.x0 AND s.LONGITUD < b.x1
                        AND s.LATITUD > b.y0 AND s.LATITUD < b.y1""",
    decimals=None,
)
def _(inputs: Inputs):
    points = inputs.view("v_station").select("ID_AIRE", "LONGITUD", "LATITUD")
    return geo.locate_points(points, inputs.box_edges(), "COD_DIS")


_SHAPES = """
    SELECT *, CAST(COD_DIS AS INTEGER) % 4 AS shape, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy,
           x0 + (x1 - x0) / 4 AS qx0, x1 - (x1 - x0) / 4 AS qx1,
           y0 + (y1 - y0) / 4 AS qy0, y1 - (y1 - y0) / 4 AS qy1,
           x0 + (x1 - x0) / 3 AS tx0, x1 - (x1 - x0) / 3 AS tx1 FROM {}"""

# Rings of the four shapes as (part, ring, corners): a diamond, an L, a box with a hole,
# two boxes.
_BOX = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]
_RINGS = [
    [(0, 0, [("cx", "y0"), ("x1", "cy"), ("cx", "y1"), ("x0", "cy")])],
    [(0, 0, [("x0", "y0"), ("x1", "y0"), ("x1", "cy"), ("cx", "cy"), ("cx", "y1"), ("x0", "y1")])],
    [(0, 0, _BOX), (0, 1, [("qx0", "qy0"), ("qx0", "qy1"), ("qx1", "qy1"), ("qx1", "qy0")])],
    [(0, 0, [("x0", "y0"), ("tx0", "y0"), ("tx0", "y1"), ("x0", "y1")]),
     (1, 0, [("tx1", "y0"), ("x1", "y0"), ("x1", "y1"), ("tx1", "y1")])],
]


def shape_edges(inputs: Inputs):
    """Edges of a diamond, an L, a box with a hole or two boxes in each district's box."""
    boxes = inputs.spark.sql(_SHAPES.format("{boxes}"), boxes=inputs.view("v_box"))

    def sides(rings):
        return F.array(
            *[
                F.struct(
                    F.lit(part).alias("part"), F.lit(ring).alias("ring"), F.lit(n).alias("seq"),
                    F.col(a[0]).alias("x1"), F.col(a[1]).alias("y1"),
                    F.col(b[0]).alias("x2"), F.col(b[1]).alias("y2"),
                )
                for part, ring, corners in rings
                for n, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1]))
            ]
        )

    chosen = F.when(F.col("shape") == 0, sides(_RINGS[0]))
    for number in (1, 2, 3):
        chosen = chosen.when(F.col("shape") == number, sides(_RINGS[number]))
    return boxes.select("COD_DIS", F.inline(chosen))


@check(
    "point_in_polygon_shapes",
    f"""SELECT s.ID_AIRE, s.LONGITUD, s.LATITUD, b.COD_DIS FROM v_station s
        LEFT JOIN ({_SHAPES.format('v_box')}) b
               ON s.LONGITUD > b.x0 AND s.LONGITUD < b.x1 AND s.LATITUD > b.y0 AND s.LATITUD < b.y1
              AND CASE shape
                    WHEN 0 THEN ABS(LONGITUD - cx) / ((x1 - x0) / 2)
                                + ABS(LATITUD - cy) / ((y1 - y0) / 2) < 1
                    WHEN 1 THEN LONGITUD < cx OR LATITUD < cy
                    WHEN 2 THEN NOT (LONGITUD BETWEEN qx0 AND qx1 AND LATITUD BETWEEN qy0 AND qy1)
                    ELSE LONGITUD < tx0 OR LONGITUD > tx1 END""",
    decimals=None,
)
def _(inputs: Inputs):
    points = inputs.view("v_station").select("ID_AIRE", "LONGITUD", "LATITUD")
    return geo.locate_points(points, shape_edges(inputs), "COD_DIS")


@check(
    "spatial_within_left",
    """SELECT s.ID_AIRE, s.ESTACION, s.LONGITUD, s.LATITUD, b.COD_DIS, b.NOMBRE FROM v_station s
       LEFT JOIN v_box b ON s.LONGITUD > b.x0 AND s.LONGITUD < b.x1
                        AND s.LATITUD > b.y0 AND s.LATITUD < b.y1
       WHERE s.LATITUD BETWEEN 39.85 AND 41.20 AND s.LONGITUD BETWEEN -4.60 AND -3.05""",
    decimals=None,
)
def _(inputs: Inputs):
    stations = inputs.view("v_station").select("ID_AIRE", "ESTACION", "LONGITUD", "LATITUD")
    return geo.assign_district(stations, inputs.box_edges(), inputs.view("v_district"))


@check(
    "polygon_centroid",
    """SELECT COD_DIS, ROUND((x0 + x1) / 2, 6) AS CX, ROUND((y0 + y1) / 2, 6) AS CY
       FROM v_box_utm""",
)
def _(inputs: Inputs):
    return geo.polygon_centroids(inputs.box_edges("v_box_utm"), "COD_DIS")


def _wkt_sql(corner: str) -> str:
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    return "'POLYGON ((' || " + " || ', ' || ".join(
        corner.format(x=x, y=y) for x, y in corners
    ) + " || '))'"


_METRE_CORNER = (
    "CAST(CAST({x} AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST({y} AS BIGINT) AS VARCHAR)"
)


@check(
    "polygon_wkt",
    f"SELECT COD_DIS, {_wkt_sql(_METRE_CORNER)} AS GEOMETRY_WKT FROM v_box_utm",
)
def _(inputs: Inputs):
    return geo.polygon_wkt(inputs.box_edges("v_box_utm"), "COD_DIS")


_NUMBER = "regexp_replace(printf('%.6f', {}), '\\.?0+$', '')"
_VERTICES = f"({_edges_sql('v_box_utm')})"
CENTROIDS = _degrees_sql(
    "cx",
    "cy",
    "(SELECT COD_DIS, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM v_box_utm)",
    "COD_DIS",
)


@check(
    "dim_geometria",
    "WITH v AS ("
    + _degrees_sql("x1", "y1", _VERTICES, "COD_DIS, seq")
    + "), t AS (SELECT COD_DIS, seq, "
    + _NUMBER.format("lon")
    + " || ' ' || "
    + _NUMBER.format("lat")
    + " AS xy FROM v), o AS (SELECT COD_DIS, 'POLYGON ((' || string_agg(xy, ', ' ORDER BY seq)"
    + " || ', ' || MIN(CASE WHEN seq = 0 THEN xy END) || '))' AS GEOMETRY_WKT"
    + " FROM t GROUP BY COD_DIS), c AS ("
    + CENTROIDS
    + ") SELECT o.COD_DIS, o.GEOMETRY_WKT, ROUND(c.lat, 7) AS CENTROID_LAT,"
    + " ROUND(c.lon, 7) AS CENTROID_LON FROM o JOIN c ON c.COD_DIS = o.COD_DIS",
    decimals=7,
)
def outlines(inputs: Inputs):
    shapes = edges_to_wkb(inputs.box_edges("v_box_utm"), "COD_DIS")
    return geo.dim_geometria(geo.polygon_edges(shapes, "COD_DIS"))


@check(
    "districts_with_stations",
    """SELECT b.COD_DIS, COUNT(s.ID_AIRE) AS n FROM v_box b JOIN v_station s
       ON s.LONGITUD > b.x0 AND s.LONGITUD < b.x1 AND s.LATITUD > b.y0 AND s.LATITUD < b.y1
       WHERE s.LATITUD BETWEEN 39.85 AND 41.20 AND s.LONGITUD BETWEEN -4.60 AND -3.05
       GROUP BY b.COD_DIS""",
)
def _(inputs: Inputs):
    points = inside_region(inputs.view("v_station"))
    located = geo.locate_points(points.drop("COD_DIS"), inputs.box_edges(), "COD_DIS")
    found = located.filter(F.col("COD_DIS").isNotNull())
    return found.groupBy("COD_DIS").agg(F.count(F.lit(1)).alias("n"))
