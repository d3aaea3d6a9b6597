"""Distances, grid cells and cell outlines as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk.functions.numeric import col_of, finite

EARTH_RADIUS_KM = 6371.0

# Hexagon area in km2 per resolution (seven children per parent).
HEX_AREA_KM2_AT_8 = 0.74
HEX_CHILDREN = 7


def haversine_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str, bounded: bool = True
) -> Column:
    """Great-circle distance; `bounded` keeps the square root's argument inside [0, 1]."""
    lat1, lon1, lat2, lon2 = (col_of(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    if bounded:
        a = F.when(a.isNotNull(), F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0)))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def _cell_id(prefix: str, *indices: Column) -> Column:
    """NULL as soon as one index is NULL, unlike `concat_ws`."""
    parts = [F.concat(F.lit("_"), i.cast("string")) for i in indices]
    return F.concat(F.lit(prefix), *parts)


def grid_index(coordinate: Column | str, resolution: int) -> Column:
    """Index of the nearest multiple of 2^-resolution degrees."""
    return F.rint(finite(coordinate) * F.lit(float(2**resolution))).cast("bigint")


def grid_cell(lat: Column | str, lon: Column | str, resolution: int) -> Column:
    """Square-degree cell id; indices are whole numbers, so the id has one spelling only. No place, no cell: NULL."""
    return _cell_id(f"g{resolution}", grid_index(lat, resolution), grid_index(lon, resolution))


def grid_center(index: Column | str, resolution: int) -> Column:
    return col_of(index).cast("double") / F.lit(float(2**resolution))


def hex_edge_km(resolution: int) -> float:
    """Edge length of a hexagon whose area shrinks by the child count per resolution step."""
    area = HEX_AREA_KM2_AT_8 * HEX_CHILDREN ** (8 - resolution)
    return math.sqrt(2.0 * area / (3.0 * math.sqrt(3.0)))


def hex_axial(lat: Column | str, lon: Column | str, resolution: int) -> tuple[Column, Column]:
    """Axial coordinates on an equal-area cylindrical plane, by cube rounding."""
    edge = hex_edge_km(resolution)
    x = F.radians(finite(lon)) * F.lit(EARTH_RADIUS_KM)
    y = F.sin(F.radians(finite(lat))) * F.lit(EARTH_RADIUS_KM)
    q = (F.lit(math.sqrt(3.0) / 3.0) * x - F.lit(1.0 / 3.0) * y) / F.lit(edge)
    r = (F.lit(2.0 / 3.0) * y) / F.lit(edge)
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    q_worst = (dq > dr) & (dq > ds)
    out_q = F.when(q_worst, -rr - rs).otherwise(rq)
    out_r = F.when(~q_worst & (dr > ds), -rq - rs).otherwise(rr)
    return out_q.cast("bigint"), out_r.cast("bigint")


def hex_cell(lat: Column | str, lon: Column | str, resolution: int) -> Column:
    q, r = hex_axial(lat, lon, resolution)
    return _cell_id(f"x{resolution}", q, r)


def _ring(corners: list[tuple[Column, Column]]) -> Column:
    closed = corners + corners[:1]
    return F.array(*[F.struct(lon.alias("lon"), lat.alias("lat")) for lon, lat in closed])


def hex_polygon(cell: Column | str) -> Column:
    """Closed ring of a hexagon id, from its axial coordinates."""
    parts = F.split(col_of(cell), "_")
    resolution = F.substring(parts[0], 2, 2).cast("int")
    edge = F.lit(hex_edge_km(0)) / F.pow(F.lit(math.sqrt(HEX_CHILDREN)), resolution)
    q, r = parts[1].cast("double"), parts[2].cast("double")
    x = edge * F.lit(math.sqrt(3.0)) * (q + r / F.lit(2.0))
    y = edge * F.lit(1.5) * r
    corners = []
    for i in range(6):
        angle = math.pi / 180.0 * (60.0 * i - 30.0)
        cx = x + edge * F.lit(math.cos(angle))
        cy = y + edge * F.lit(math.sin(angle))
        sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cy / F.lit(EARTH_RADIUS_KM)))
        corners.append((F.degrees(cx / F.lit(EARTH_RADIUS_KM)), F.degrees(F.asin(sine))))
    return _ring(corners)


def grid_polygon(cell: Column | str) -> Column:
    """Closed ring of a square-degree cell id."""
    parts = F.split(col_of(cell), "_")
    step = F.pow(F.lit(2.0), -F.substring(parts[0], 2, 2).cast("int"))
    lat, lon = parts[1].cast("double") * step, parts[2].cast("double") * step
    half = step / F.lit(2.0)
    return _ring(
        [
            (lon - half, lat - half),
            (lon + half, lat - half),
            (lon + half, lat + half),
            (lon - half, lat + half),
        ]
    )


def cell_polygon(cell: Column | str) -> Column:
    c = col_of(cell)
    return F.when(c.startswith("x"), hex_polygon(c)).otherwise(grid_polygon(c))
