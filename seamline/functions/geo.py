"""Column functions of plane and map geometry."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from seamline.functions import dictionaries as D

# Kilometres of a degree, ellipsoids (semi-major axis, flattening), UTM scale and false easting.
KM_PER_DEG = 111.32
ELLIPSOIDS = {"WGS 84": (6378137.0, 1 / 298.257223563), "GRS 1980": (6378137.0, 1 / 298.257222101)}
K0, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0


def affine(x: Column, y: Column, a: list) -> tuple[Column, Column]:
    """A 2x3 affine given by rows of columns or numbers."""
    return tuple(r[0] * x + r[1] * y + r[2] for r in a)


def inverse(a: list) -> list:
    """The inverse of a 2x3 affine."""
    (p, q, tx), (r, s, ty) = a
    det = p * s - q * r
    return [[s / det, -q / det, (q * ty - s * tx) / det], [-r / det, p / det, (r * tx - p * ty) / det]]


def similarity(scale, rotation: Column, tx, ty) -> list:
    """Scan pixels (y down) to a map (y up): flip, turn by degrees, scale and shift."""
    c, s = scale * F.cos(F.radians(rotation)), scale * F.sin(F.radians(rotation))
    return [[c, s, tx], [s, -c, ty]]


def side_of(bearing: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in D.SIDES)), (F.floor(F.pmod(bearing + 22.5, F.lit(360.0)) / 45) + 1).cast("int"))


def bearing(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north, y up."""
    return F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))


def nearest_on_segment(px, py, ax, ay, bx, by) -> tuple[Column, Column, Column]:
    """Foot and distance of a point on a segment."""
    dx, dy = bx - ax, by - ay
    u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-9))))
    qx, qy = ax + u * dx, ay + u * dy
    return qx, qy, F.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))


def huber(d: Column, k: float) -> Column:
    return F.when(d <= k, d * d).otherwise(k * (2 * d - k))


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes x1, y1, x2, y2; 0 if they only touch."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    common = F.when((w > 0) & (h > 0), w * h).otherwise(0)
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return common / F.greatest(area(a) + area(b) - common, F.lit(1))


def label_direction(x1, y1, x2, y2, aspect: float = 2.0) -> Column:
    """0 for a wide box, 90 for a tall one, null for one too square to tell."""
    w, h = x2 - x1, y2 - y1
    return F.when(w >= aspect * h, 0.0).when(h >= aspect * w, 90.0)


def utm_epsg(lon: Column, lat: Column) -> Column:
    zone = F.floor((lon + 180) / 6) + 1
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")


def utm_zone(epsg: Column) -> tuple[Column, Column]:
    """Zone and whether it is northern, for the UTM code ranges; null for others."""
    ranges = [(32601, 32660, 32600, True), (32701, 32760, 32700, False), (26901, 26923, 26900, True), (25828, 25838, 25800, True)]
    zone, north = F.lit(None).cast("int"), F.lit(None).cast("boolean")
    for low, high, base, up in ranges:
        zone = F.when(epsg.between(low, high), epsg - base).otherwise(zone)
        north = F.when(epsg.between(low, high), F.lit(up)).otherwise(north)
    return zone, north


def _meridian(e2: float) -> list[float]:
    return [1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024, 15 * e2**2 / 256 + 45 * e2**3 / 1024, 35 * e2**3 / 3072]


def utm_forward(lon: Column, lat: Column, zone: Column, north: Column, ellipsoid: str = "WGS 84") -> tuple[Column, Column]:
    """Easting and northing by the transverse Mercator series."""
    a, f = ELLIPSOIDS[ellipsoid]
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi = F.radians(lat)
    c, s, t = F.cos(phi), F.sin(phi), F.tan(phi)
    n = a / F.sqrt(1 - e2 * s * s)
    tt, cc = t * t, ep2 * c * c
    arc = F.radians(lon - (6 * zone - 183)) * c
    m = _meridian(e2)
    meridian = a * (m[0] * phi - m[1] * F.sin(2 * phi) + m[2] * F.sin(4 * phi) - m[3] * F.sin(6 * phi))
    east = arc + (1 - tt + cc) * F.pow(arc, 3) / 6 + (5 - 18 * tt + tt * tt + 72 * cc - 58 * ep2) * F.pow(arc, 5) / 120
    up = arc * arc / 2 + (5 - tt + 9 * cc + 4 * cc * cc) * F.pow(arc, 4) / 24 + (61 - 58 * tt + tt * tt + 600 * cc - 330 * ep2) * F.pow(arc, 6) / 720
    return K0 * n * east + FALSE_EASTING, K0 * (meridian + n * t * up) + F.when(north, 0.0).otherwise(FALSE_NORTHING)


def utm_inverse(x: Column, y: Column, zone: Column, north: Column, ellipsoid: str = "WGS 84") -> tuple[Column, Column]:
    """Longitude and latitude of an easting and a northing."""
    a, f = ELLIPSOIDS[ellipsoid]
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (y - F.when(north, 0.0).otherwise(FALSE_NORTHING)) / K0 / (a * _meridian(e2)[0])
    terms = [3 * e1 / 2 - 27 * e1**3 / 32, 21 * e1**2 / 16 - 55 * e1**4 / 32, 151 * e1**3 / 96, 1097 * e1**4 / 512]
    phi = mu + sum((k * F.sin(2 * (i + 1) * mu) for i, k in enumerate(terms)), F.lit(0.0))
    c, s, t = F.cos(phi), F.sin(phi), F.tan(phi)
    w = 1 - e2 * s * s
    n, r = a / F.sqrt(w), a * (1 - e2) / (w * F.sqrt(w))
    tt, cc = t * t, ep2 * c * c
    d = (x - FALSE_EASTING) / (n * K0)
    down = d * d / 2 - (5 + 3 * tt + 10 * cc - 4 * cc * cc - 9 * ep2) * F.pow(d, 4) / 24 + (61 + 90 * tt + 298 * cc + 45 * tt * tt - 252 * ep2 - 3 * cc * cc) * F.pow(d, 6) / 720
    along = (d - (1 + 2 * tt + cc) * F.pow(d, 3) / 6 + (5 - 2 * cc + 28 * tt - 3 * cc * cc + 8 * ep2 + 24 * tt * tt) * F.pow(d, 5) / 120) / c
    return F.degrees(along) + (6 * zone - 183), F.degrees(phi - n * t / r * down)


def km(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular distance."""
    dy = (lat1 - lat2) * KM_PER_DEG
    dx = (lon1 - lon2) * KM_PER_DEG * F.cos(F.radians((lat1 + lat2) / 2))
    return F.sqrt(dx * dx + dy * dy)


def pad_box(s, w, n, e, by_km: float) -> tuple[Column, Column, Column, Column]:
    dlat = by_km / KM_PER_DEG
    dlon = by_km / (KM_PER_DEG * F.greatest(F.cos(F.radians((s + n) / 2)), F.lit(1e-6)))
    return F.greatest(s - dlat, F.lit(-90.0)), w - dlon, F.least(n + dlat, F.lit(90.0)), e + dlon


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring of struct(x, y), open or closed."""
    follow = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, follow, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2


def ring_perimeter(ring: Column) -> Column:
    follow = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    steps = F.zip_with(ring, follow, lambda p, q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])))
    return F.aggregate(steps, F.lit(0.0), lambda a, v: a + v)


def inside(px: Column, py: Column, ring: Column) -> Column:
    """Even-odd test of a point in a ring."""
    follow = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    hits = F.zip_with(ring, follow, lambda p, q: ((p["y"] > py) != (q["y"] > py)) & (px < F.try_divide((q["x"] - p["x"]) * (py - p["y"]), q["y"] - p["y"]) + p["x"]))
    return F.pmod(F.size(F.filter(hits, lambda h: h)), F.lit(2)) == 1


def ring_depth(px: Column, py: Column, ring: Column) -> Column:
    """Distance to a ring's edge, positive inside."""
    follow = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    edge = F.array_min(F.zip_with(ring, follow, lambda p, q: nearest_on_segment(px, py, p["x"], p["y"], q["x"], q["y"])[2]))
    return F.when(inside(px, py, ring), edge).otherwise(-edge)


def cells(x1: Column, y1: Column, x2: Column, y2: Column, size: float) -> Column:
    """The grid cells a box touches, as an array of struct(cx, cy): the equality key of spatial joins."""
    span = lambda a, b: F.sequence(F.floor(a / size), F.floor(b / size))
    return F.flatten(F.transform(span(x1, x2), lambda cx: F.transform(span(y1, y2), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def decomposed(a11: Column, a12: Column, a21: Column, a22: Column) -> dict[str, Column]:
    """Scales, turn and shear of a linear map; the cosine is clipped before its angle is taken."""
    sx, sy = F.sqrt(a11 * a11 + a21 * a21), F.sqrt(a12 * a12 + a22 * a22)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(a11 * a12 + a21 * a22, sx * sy)))
    return {"sx": sx, "sy": sy, "rotation": F.degrees(F.atan2(a21, a11)), "shear": F.degrees(F.acos(cosine)) - 90}
