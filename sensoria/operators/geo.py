"""District geometry as tables: edges, containment, centroids, WKT.

Polygons enter as a WKB column and become an edges table
``(<key>, part, ring, seq, x1, y1, x2, y2)``.  Ring 0 of a part is its shell,
further rings are holes.  From there on the work is joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensoria.functions.projection import utm_to_degrees
from sensoria.operators.cleaning import inside_region

# Side of a grid cell in degrees, about a kilometre: a district has some hundred
# cells, and a border cell a few edges.
CELL = 0.01


def polygon_edges(shapes: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """Edges of a WKB Polygon/MultiPolygon column, either byte order."""
    schema = (
        f"{key} string, part int, ring int, seq int, "
        "x1 double, y1 double, x2 double, y2 double"
    )

    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        def rings(data: bytes, at: int):
            order = "<" if data[at] == 1 else ">"
            kind, count = np.frombuffer(data, f"{order}u4", 2, at + 1)
            at += 9
            found = []
            if kind == 6:
                for part in range(int(count)):
                    inner, at = rings(data, at)
                    found += [(part, ring, xy) for _, ring, xy in inner]
            elif kind == 3:
                for ring in range(int(count)):
                    size = int(np.frombuffer(data, f"{order}u4", 1, at)[0])
                    xy = np.frombuffer(data, f"{order}f8", 2 * size, at + 4)
                    found.append((0, ring, xy.astype("f8").reshape(size, 2)))
                    at += 4 + 16 * size
            else:
                raise ValueError(f"WKB type {kind} is no Polygon or MultiPolygon")
            return found, at

        for batch in batches:
            for name, data in zip(batch[key], batch[geometry]):
                if data is None:
                    continue
                for part, ring, xy in rings(bytes(data), 0)[0]:
                    start, end = xy[:-1], xy[1:]
                    yield pd.DataFrame(
                        {
                            key: name, "part": part, "ring": ring,
                            "seq": np.arange(len(start)),
                            "x1": start[:, 0], "y1": start[:, 1],
                            "x2": end[:, 0], "y2": end[:, 1],
                        }
                    )

    return shapes.select(F.col(key).cast("string"), geometry).mapInPandas(decode, schema)


def edges_to_degrees(edges: DataFrame) -> DataFrame:
    """Edges of UTM 30N metres reprojected to WGS84 degrees."""
    lon1, lat1 = utm_to_degrees(F.col("x1"), F.col("y1"))
    lon2, lat2 = utm_to_degrees(F.col("x2"), F.col("y2"))
    return edges.withColumns({"x1": lon1, "y1": lat1, "x2": lon2, "y2": lat2})


def strictly_inside(x: Column, y: Column, sides: Column) -> Column:
    """Even-odd rule over an array of edges; points on an edge are outside."""

    def side_of(e: Column) -> Column:
        return (e.x2 - e.x1) * (y - e.y1) - (e.y2 - e.y1) * (x - e.x1)

    def touches(e: Column) -> Column:
        return (
            (side_of(e) == 0)
            & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
            & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
        )

    def crosses_right(e: Column) -> Column:
        upward = (e.y1 <= y) & (y < e.y2) & (side_of(e) > 0)
        downward = (e.y2 <= y) & (y < e.y1) & (side_of(e) < 0)
        return upward | downward

    odd = F.size(F.filter(sides, crosses_right)) % 2 == 1
    return ~F.exists(sides, touches) & odd


def cell_cover(edges: DataFrame, key: str, cell: float = CELL) -> DataFrame:
    """Grid cells of each polygon: (_zona, fila, columna, _lados).

    Cells no edge passes through lie inside as a whole and carry no edges.  Border cells carry
    the edges of their row that a ray from the cell to the right can meet, all the exact test
    needs.  Where an edge meets a row is widened a little, so rounding can only turn an inner
    cell into a border cell.  Lists are bounded by the outline of one polygon in one row.
    """
    margin = cell * 1e-6
    low = F.floor(F.least("y1", "y2") / F.lit(cell))
    high = F.floor(F.greatest("y1", "y2") / F.lit(cell))
    rows = edges.withColumn("fila", F.explode(F.sequence(low, high)))

    def x_at(y: Column, level: float) -> Column:
        way = F.try_divide(y - F.col("y1"), F.col("y2") - F.col("y1"))
        way = F.greatest(F.lit(0.0), F.least(F.lit(1.0), way))
        way = F.when(F.col("y1") == F.col("y2"), F.lit(level)).otherwise(way)
        return F.col("x1") + way * (F.col("x2") - F.col("x1"))

    bottom = x_at(F.col("fila") * F.lit(cell) - margin, 0.0)
    top = x_at((F.col("fila") + 1) * F.lit(cell) + margin, 1.0)
    first = F.floor((F.least(bottom, top) - margin) / F.lit(cell))
    last = F.floor((F.greatest(bottom, top) + margin) / F.lit(cell))
    outlined = rows.groupBy(F.col(key).alias("_zona"), "fila").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_lados"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence(first, last))))).alias(
            "_borde"
        ),
    )
    border = outlined.select(
        "_zona", "fila", "_lados", F.explode("_borde").alias("columna")
    ).select(
        "_zona",
        "fila",
        "columna",
        F.filter(
            "_lados",
            lambda e: F.greatest(e.x1, e.x2) >= F.col("columna") * F.lit(cell) - margin,
        ).alias("_lados"),
    )
    # a gap between two border cells of a row lies inside or outside as a whole
    steps = F.when(F.size("_borde") > 1, F.sequence(F.lit(1), F.size("_borde") - 1))
    gaps = F.transform(
        steps,
        lambda i: F.struct(
            (F.col("_borde")[i - 1] + 1).alias("desde"), (F.col("_borde")[i] - 1).alias("hasta")
        ),
    )
    wide = F.filter(gaps, lambda gap: gap.desde <= gap.hasta)
    middle = F.struct(
        ((F.col("_hueco.desde") + 0.5) * F.lit(cell)).alias("x"),
        ((F.col("fila") + 0.5) * F.lit(cell)).alias("y"),
    )
    inner = (
        outlined.select("_zona", "fila", "_lados", F.explode(wide).alias("_hueco"))
        .withColumn("_centro", middle)
        .filter(strictly_inside(F.col("_centro.x"), F.col("_centro.y"), F.col("_lados")))
        .select(
            "_zona",
            "fila",
            F.explode(F.sequence("_hueco.desde", "_hueco.hasta")).alias("columna"),
            F.lit(None).cast(border.schema["_lados"].dataType).alias("_lados"),
        )
    )
    return border.unionByName(inner)


def locate_points(
    points: DataFrame,
    edges: DataFrame,
    key: str,
    x: str = "LONGITUD",
    y: str = "LATITUD",
    cell: float = CELL,
) -> DataFrame:
    """Left join of points to the polygon that strictly contains them.

    One equi-join on the grid cell: no key holds more than one cell's points, and edges are
    tested in border cells only, as part of the join condition, so points are neither
    multiplied nor aggregated.  Points outside every polygon stay with a NULL ``key``.
    """
    cover = cell_cover(edges, key, cell)
    placed = points.withColumns(
        {
            "_fila": F.floor(F.col(y) / F.lit(cell)),
            "_columna": F.floor(F.col(x) / F.lit(cell)),
        }
    )
    inside = (
        (F.col("_fila") == F.col("fila"))
        & (F.col("_columna") == F.col("columna"))
        & (F.col("_lados").isNull() | strictly_inside(F.col(x), F.col(y), F.col("_lados")))
    )
    return placed.join(cover, inside, "left").select(
        *[F.col(name) for name in points.columns], F.col("_zona").alias(key)
    )


def polygon_centroids(edges: DataFrame, key: str) -> DataFrame:
    """Area centroid (CX, CY) per polygon; holes count against the shell.

    Sums run about a corner of each polygon's box, which keeps digits that large
    map coordinates would lose.
    """
    corner = edges.groupBy(key).agg(F.min("x1").alias("_x0"), F.min("y1").alias("_y0"))
    local = edges.join(corner, key).withColumns(
        {
            "_x1": F.col("x1") - F.col("_x0"),
            "_y1": F.col("y1") - F.col("_y0"),
            "_x2": F.col("x2") - F.col("_x0"),
            "_y2": F.col("y2") - F.col("_y0"),
        }
    )
    cross = F.expr("_x1 * _y2 - _x2 * _y1")
    rings = local.groupBy(key, "part", "ring", "_x0", "_y0").agg(
        F.sum(cross).alias("_a"),
        F.sum(F.expr("_x1 + _x2") * cross).alias("_mx"),
        F.sum(F.expr("_y1 + _y2") * cross).alias("_my"),
    )
    role = F.when(F.col("ring") == 0, 1.0).otherwise(-1.0) * F.signum("_a")
    totals = rings.groupBy(key, "_x0", "_y0").agg(
        F.sum(role * F.col("_a")).alias("_a"),
        F.sum(role * F.col("_mx")).alias("_mx"),
        F.sum(role * F.col("_my")).alias("_my"),
    )
    return totals.select(
        key,
        (F.col("_x0") + F.try_divide("_mx", F.col("_a") * 3)).alias("CX"),
        (F.col("_y0") + F.try_divide("_my", F.col("_a") * 3)).alias("CY"),
    )


def _number_text(value: Column) -> Column:
    return F.regexp_replace(F.format_string("%.6f", value), r"\.?0+$", "")


def polygon_wkt(edges: DataFrame, key: str) -> DataFrame:
    """WKT text per polygon, coordinates to six decimals without padding."""
    vertex = F.concat_ws(" ", _number_text(F.col("x1")), _number_text(F.col("y1")))
    rings = edges.groupBy(key, "part", "ring").agg(
        F.array_sort(F.collect_list(F.struct("seq", vertex.alias("xy")))).alias("_v")
    )
    texts = F.col("_v.xy")
    ring_text = F.concat(
        F.lit("("),
        F.array_join(F.concat(texts, F.slice(texts, 1, 1)), ", "),
        F.lit(")"),
    )

    def joined(order: str, text: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(order, text)))
        return F.concat(F.lit("("), F.array_join(ordered[text], ", "), F.lit(")"))

    parts = (
        rings.select(key, "part", "ring", ring_text.alias("_t"))
        .groupBy(key, "part")
        .agg(joined("ring", "_t").alias("_t"))
    )
    shapes = parts.groupBy(key).agg(
        joined("part", "_t").alias("_all"),
        F.max("_t").alias("_only"),
        F.count(F.lit(1)).alias("_n"),
    )
    text = F.when(
        F.col("_n") == 1, F.concat(F.lit("POLYGON "), F.col("_only"))
    ).otherwise(F.concat(F.lit("MULTIPOLYGON "), F.col("_all")))
    return shapes.select(key, text.alias("GEOMETRY_WKT"))


def dim_geometria(edges: DataFrame, key: str = "COD_DIS") -> DataFrame:
    """Geometry dimension of metric edges: WGS84 outline text and centroid."""
    lon, lat = utm_to_degrees(F.col("CX"), F.col("CY"))
    centroids = polygon_centroids(edges, key).select(
        key, lat.alias("CENTROID_LAT"), lon.alias("CENTROID_LON")
    )
    outline = polygon_wkt(edges_to_degrees(edges), key)
    return outline.join(centroids, key).select(
        F.col(key).alias("COD_DIS"), "GEOMETRY_WKT", "CENTROID_LAT", "CENTROID_LON"
    )


def assign_district(
    stations: DataFrame, edges: DataFrame, names: DataFrame
) -> DataFrame:
    """Stations inside the region with their district code and name.

    ``edges`` are in degrees and ``names`` is (COD_DIS, NOMBRE).  Positions
    outside every district keep NULLs.
    """
    located = locate_points(inside_region(stations), edges, "COD_DIS")
    return located.join(names.select("COD_DIS", "NOMBRE"), "COD_DIS", "left")
