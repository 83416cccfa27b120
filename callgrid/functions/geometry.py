"""Plane geometry on arrays of `struct<x double, y double>` vertices.

A polygon is a ring (`array<struct<x,y>>`) or several rings (`array<array<struct<x,y>>>`, holes included);
whether the first vertex is repeated at the end does not matter. Everything works on the list of edges, which is
derived once per polygon row with `edges`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .base import Col, col


def point_x(p: Col) -> Column:
    return col(p).getField("x")


def point_y(p: Col) -> Column:
    return col(p).getField("y")


def edges(ring: Col, several: bool = False) -> Column:
    """`array<struct<x1,y1,x2,y2>>` of a ring, or of all rings of a polygon."""

    def one(r: Column) -> Column:
        following = F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1))
        return F.zip_with(
            r,
            following,
            lambda a, b: F.struct(
                a["x"].cast("double").alias("x1"),
                a["y"].cast("double").alias("y1"),
                b["x"].cast("double").alias("x2"),
                b["y"].cast("double").alias("y2"),
            ),
        )

    return F.flatten(F.transform(col(ring), one)) if several else one(col(ring))


def _signed_area(e: Column) -> Column:
    return F.aggregate(e, F.lit(0.0), lambda s, k: s + (k["x1"] * k["y2"] - k["x2"] * k["y1"])) / 2


def oriented_edges(rings: Col) -> Column:
    """The edges of a polygon of several rings, parts and holes, in whatever order and direction they come.

    A ring that an even number of the others surround is the outline of a part and runs counter-clockwise, the others are holes
    and run clockwise. So signed areas of the edges add up to the area between the rings. A ring counts as surrounded if more
    than half of its corners are, as rings may touch.
    """

    def one(ring: Column) -> Column:
        own = edges(ring)
        surrounded = lambda other: F.aggregate(
            own, F.lit(0), lambda n, k: n + F.when(contains(edges(other), k["x1"], k["y1"]), F.lit(2)).otherwise(F.lit(0))
        ) > F.size(own)
        around = F.size(F.filter(col(rings), lambda other: (other != ring) & surrounded(other)))
        wanted = F.when(around % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        turned = F.transform(own, lambda k: F.struct(k["x2"].alias("x1"), k["y2"].alias("y1"), k["x1"].alias("x2"), k["y1"].alias("y2")))
        return F.when(F.signum(_signed_area(own)) == wanted, own).otherwise(turned)

    return F.flatten(F.transform(col(rings), one))


def reprojected(rings: Col, several: bool = False, params: dict | None = None) -> Column:
    """A ring, or several, in plane feet (or metres) as longitudes x and latitudes y, corner by corner."""
    one = lambda ring: F.transform(ring, lambda p: lcc_to_lonlat(p["x"], p["y"], params))
    return F.transform(col(rings), one) if several else one(col(rings))


def edges_area(e: Col) -> Column:
    return F.abs(_signed_area(col(e)))


def ring_area(ring: Col) -> Column:
    return edges_area(edges(ring))


def contains(e: Col, x: Col, y: Col) -> Column:
    """Even-odd ray casting. A point on a border shared by two polygons is in exactly one of them."""
    px, py = col(x), col(y)

    def crosses(k: Column) -> Column:
        straddles = (k["y1"] > py) != (k["y2"] > py)
        at = (k["x2"] - k["x1"]) * F.try_divide(py - k["y1"], k["y2"] - k["y1"]) + k["x1"]
        return F.when(straddles, (px < at).cast("int")).otherwise(F.lit(0))

    return F.aggregate(col(e), F.lit(0), lambda n, k: n + crosses(k)) % 2 == 1


def bounds(e: Col) -> list[Column]:
    """min_x, min_y, max_x, max_y of an edge list."""
    every = col(e)
    return [
        F.array_min(F.transform(every, lambda k: k["x1"])).alias("min_x"),
        F.array_min(F.transform(every, lambda k: k["y1"])).alias("min_y"),
        F.array_max(F.transform(every, lambda k: k["x1"])).alias("max_x"),
        F.array_max(F.transform(every, lambda k: k["y1"])).alias("max_y"),
    ]


def _span(k: Column) -> tuple[Column, Column]:
    return F.least(k["x1"], k["x2"]), F.greatest(k["x1"], k["x2"])


def _height(k: Column, x: Column) -> Column:
    slope = F.try_divide(k["y2"] - k["y1"], k["x2"] - k["x1"])
    return k["y1"] + slope * (x - k["x1"])


def overlap_area(ea: Col, eb: Col) -> Column:
    """Exact area shared by two simple polygons, convex or not, with or without holes.

    A polygon is the signed sum of the strips between each edge and a base line below it, so the shared area is the
    signed sum over edge pairs of the area under the lower of the two edges, over the x range both cover.
    """
    a, b = col(ea), col(eb)
    base = F.least(F.array_min(F.transform(a, lambda k: k["y1"])), F.array_min(F.transform(b, lambda k: k["y1"])))

    def pair(p: Column, q: Column) -> Column:
        (p0, p1), (q0, q1) = _span(p), _span(q)
        x0, x1 = F.greatest(p0, q0), F.least(p1, q1)
        width = x1 - x0
        pl, pr, ql, qr = _height(p, x0), _height(p, x1), _height(q, x0), _height(q, x1)
        dl, dr = pl - ql, pr - qr
        no_crossing = width * (F.least(pl + pr, ql + qr) / 2 - base)
        # where the edges cross, the lower one changes at the share |dl| / (|dl| + |dr|) of the range
        share = F.try_divide(F.abs(dl), F.abs(dl) + F.abs(dr))
        meet = pl + (pr - pl) * share
        crossing = width * (
            share * ((F.least(pl, ql) + meet) / 2 - base) + (1 - share) * ((meet + F.least(pr, qr)) / 2 - base)
        )
        sign = F.signum(p["x2"] - p["x1"]) * F.signum(q["x2"] - q["x1"])
        return F.when(width > 0, sign * F.when(dl * dr < 0, crossing).otherwise(no_crossing)).otherwise(F.lit(0.0))

    total = F.aggregate(
        a, F.lit(0.0), lambda s, p: s + F.aggregate(b, F.lit(0.0), lambda t, q: t + pair(p, q))
    )
    orientation = F.signum(_signed_area(a)) * F.signum(_signed_area(b))
    return F.greatest(total * orientation, F.lit(0.0))


def intersects(ea: Col, eb: Col, several: bool = False) -> Column:
    """True where two polygons share at least one point, borders included; `several` where one of them may have parts or holes."""
    a, b = col(ea), col(eb)

    def side(k: Column, x: Column, y: Column) -> Column:
        return F.signum((k["x2"] - k["x1"]) * (y - k["y1"]) - (k["y2"] - k["y1"]) * (x - k["x1"]))

    def meet(p: Column, q: Column) -> Column:
        boxes = (
            (F.least(p["x1"], p["x2"]) <= F.greatest(q["x1"], q["x2"]))
            & (F.least(q["x1"], q["x2"]) <= F.greatest(p["x1"], p["x2"]))
            & (F.least(p["y1"], p["y2"]) <= F.greatest(q["y1"], q["y2"]))
            & (F.least(q["y1"], q["y2"]) <= F.greatest(p["y1"], p["y2"]))
        )
        return (
            boxes
            & (side(p, q["x1"], q["y1"]) * side(p, q["x2"], q["y2"]) <= 0)
            & (side(q, p["x1"], p["y1"]) * side(q, p["x2"], p["y2"]) <= 0)
        )

    borders = F.exists(a, lambda p: F.exists(b, lambda q: meet(p, q)))
    if several:  # without a meeting of borders a part lies inside as a whole or not at all, so one corner of each part tells
        any_inside = lambda p, q: F.exists(p, lambda k: contains(q, k["x1"], k["y1"]))
        return borders | any_inside(a, b) | any_inside(b, a)
    first_a, first_b = F.get(a, F.lit(0)), F.get(b, F.lit(0))
    inside = contains(b, first_a["x1"], first_a["y1"]) | contains(a, first_b["x1"], first_b["y1"])
    return borders | inside


# The state plane zone EPSG:3735 (Lambert conformal conic, two parallels, US survey feet, GRS80).
OHIO_SOUTH_FT = {
    "lat_1": 38 + 44 / 60,
    "lat_2": 40 + 2 / 60,
    "lat_0": 38.0,
    "lon_0": -82.5,
    "x_0": 600000.0,
    "y_0": 0.0,
    "semi_major": 6378137.0,
    "inverse_flattening": 298.257222101,
    "to_metre": 1200 / 3937,
}


def _cone(p: dict) -> dict:
    """Constants of the projection, computed on the driver from its parameters."""
    e2 = 2 / p["inverse_flattening"] - 1 / p["inverse_flattening"] ** 2
    e = math.sqrt(e2)

    def m(lat):
        return math.cos(lat) / math.sqrt(1 - e2 * math.sin(lat) ** 2)

    def t(lat):
        s = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    lat_1, lat_2, lat_0 = (math.radians(p[k]) for k in ("lat_1", "lat_2", "lat_0"))
    n = (math.log(m(lat_1)) - math.log(m(lat_2))) / (math.log(t(lat_1)) - math.log(t(lat_2)))
    big_f = m(lat_1) / (n * t(lat_1) ** n)
    return {"e": e, "e2": e2, "n": n, "af": p["semi_major"] * big_f, "rho_0": p["semi_major"] * big_f * t(lat_0) ** n}


def lcc_to_lonlat(x: Col, y: Col, params: dict | None = None) -> Column:
    """Inverse Lambert conformal conic: plane feet (or metres) to `struct<x longitude, y latitude>` in degrees.

    The latitude comes from the conformal latitude by its sine series, so no iteration is needed.
    """
    p = params or OHIO_SOUTH_FT
    k = _cone(p)
    e2 = k["e2"]
    east = col(x) * p["to_metre"] - p["x_0"]
    north = F.lit(k["rho_0"]) - (col(y) * p["to_metre"] - p["y_0"])
    rho = F.sqrt(east * east + north * north)
    chi = F.lit(math.pi / 2) - 2 * F.atan(F.pow(rho / k["af"], F.lit(1 / k["n"])))
    series = [
        (2, e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360),
        (4, 7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520),
        (6, 7 * e2**3 / 120 + 81 * e2**4 / 1120),
        (8, 4279 * e2**4 / 161280),
    ]
    lat = chi
    for multiple, weight in series:
        lat = lat + weight * F.sin(multiple * chi)
    lon = F.atan2(east, north) / k["n"]
    return F.struct((F.degrees(lon) + p["lon_0"]).alias("x"), F.degrees(lat).alias("y"))


def lonlat_to_lcc(lon: Col, lat: Col, params: dict | None = None) -> Column:
    """Forward Lambert conformal conic, the check of the inverse."""
    p = params or OHIO_SOUTH_FT
    k = _cone(p)
    phi = F.radians(col(lat))
    s = F.sin(phi) * k["e"]
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(k["e"] / 2))
    rho = F.lit(k["af"]) * F.pow(t, F.lit(k["n"]))
    theta = F.radians(col(lon) - p["lon_0"]) * k["n"]
    return F.struct(
        ((rho * F.sin(theta) + p["x_0"]) / p["to_metre"]).alias("x"),
        ((F.lit(k["rho_0"]) - rho * F.cos(theta) + p["y_0"]) / p["to_metre"]).alias("y"),
    )
