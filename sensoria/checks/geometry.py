"""Geometry inputs for the checks: outlines written back as WKB."""

from __future__ import annotations

from pyspark.sql import DataFrame


def edges_to_wkb(edges: DataFrame, key: str) -> DataFrame:
    """Little-endian WKB per key, the inverse of :func:`polygon_edges`.

    A group is the outline of one district; its size does not grow with readings.
    """

    def encode(group):
        import struct

        import pandas as pd

        group = group.sort_values(["part", "ring", "seq"])
        parts = []
        for _, part in group.groupby("part"):
            body = b""
            for _, ring in part.groupby("ring"):
                xy = ring[["x1", "y1"]].to_numpy()
                body += struct.pack("<I", len(xy) + 1)
                body += xy.tobytes() + xy[:1].tobytes()
            parts.append(struct.pack("<BII", 1, 3, part["ring"].nunique()) + body)
        data = parts[0]
        if len(parts) > 1:
            data = struct.pack("<BII", 1, 6, len(parts)) + b"".join(parts)
        return pd.DataFrame({key: [group[key].iloc[0]], "geometry": [data]})

    return edges.groupBy(key).applyInPandas(encode, f"{key} string, geometry binary")
