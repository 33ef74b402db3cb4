"""Boxes and rings as columns.

A box is four columns xmin, ymin, xmax, ymax, optionally behind a prefix; a ring is
an array of structs x, y. Everything is an expression, so it stays in generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lower bounds of the size classes, in square metres.
SIZE_BINS = [("tiny", 0.0), ("small", 9.0), ("medium", 25.0), ("large", 49.0), ("giant", 100.0)]
EARTH_RADIUS = 6378137.0
SIDES = ("xmin", "ymin", "xmax", "ymax")


def box(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{s}") for s in SIDES)  # type: ignore[return-value]


def area(b) -> Column:
    x0, y0, x1, y1 = b
    return (x1 - x0) * (y1 - y0)


def intersection(a, b) -> tuple[Column, Column, Column, Column]:
    """The common box; degenerate where the two don't overlap."""
    return F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])


def overlap(a, b) -> Column:
    """The common area, zero where there is none."""
    x0, y0, x1, y1 = intersection(a, b)
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, zero where the whole is zero."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def iou(a, b, added: float = 0.0) -> Column:
    """Intersection over union, with a little added to the union if asked for; zero without overlap or for an empty union."""
    common = overlap(a, b)
    union = area(a) + area(b) - common
    return ratio(common, union + added if added else union)


def ioa(a, b) -> Column:
    """Intersection over the smaller area."""
    return ratio(overlap(a, b), F.least(area(a), area(b)))


def centroid(b) -> tuple[Column, Column]:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def distance(p, q) -> Column:
    return F.sqrt((p[0] - q[0]) * (p[0] - q[0]) + (p[1] - q[1]) * (p[1] - q[1]))


def from_xywh(x: Column, y: Column, w: Column, h: Column):
    return x, y, x + w, y + h


def clip(b, to) -> tuple[Column, Column, Column, Column]:
    """The box, cut to another; callers drop what is empty then."""
    return intersection(b, to)


def expand(b, by) -> tuple[Column, Column, Column, Column]:
    by = F.lit(by) if not isinstance(by, Column) else by
    return b[0] - by, b[1] - by, b[2] + by, b[3] + by


def valid(b) -> Column:
    return (b[2] > b[0]) & (b[3] > b[1])


def ring_of(b) -> Column:
    """The box's corners as a closed ring."""
    x0, y0, x1, y1 = b
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring, closed or open."""
    turned = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, turned, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def ring_envelope(ring: Column) -> tuple[Column, Column, Column, Column]:
    x, y = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Area-weighted centroid of a closed ring, worked out from its first point so that far coordinates keep their digits."""
    x0, y0 = F.element_at(ring, 1)["x"], F.element_at(ring, 1)["y"]
    near = F.transform(ring, lambda p: F.struct((p["x"] - x0).alias("x"), (p["y"] - y0).alias("y")))
    turned = F.concat(F.slice(near, 2, F.size(near) - 1), F.slice(near, 1, 1))
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    parts = F.zip_with(near, turned, lambda p, q: F.struct(((p["x"] + q["x"]) * cross(p, q)).alias("x"), ((p["y"] + q["y"]) * cross(p, q)).alias("y"), cross(p, q).alias("a")))
    total = lambda name: F.aggregate(F.transform(parts, lambda v: v[name]), F.lit(0.0), lambda s, v: s + v)
    return x0 + F.try_divide(total("x"), 3 * total("a")), y0 + F.try_divide(total("y"), 3 * total("a"))


def to_pixels(ring: Column, x0: Column, y0: Column, gsd: Column) -> Column:
    """Shifts by the origin, then scales by the ground sampling distance."""
    return F.transform(ring, lambda p: F.struct(((p["x"] - x0) / gsd).alias("x"), ((p["y"] - y0) / gsd).alias("y")))


def scale(ring: Column, sx, sy) -> Column:
    """Anisotropic scale about the origin."""
    return F.transform(ring, lambda p: F.struct((p["x"] * sx).alias("x"), (p["y"] * sy).alias("y")))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Ray casting: whether the point is inside the ring."""
    turned = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    crossed = F.zip_with(ring, turned, lambda p, q: F.when(((p["y"] > y) != (q["y"] > y)) & (x < F.try_divide((q["x"] - p["x"]) * (y - p["y"]), q["y"] - p["y"]) + p["x"]), 1).otherwise(0))
    return F.aggregate(crossed, F.lit(0), lambda s, v: s + v) % 2 == 1


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical Mercator of degrees, latitude within 89.5 degrees."""
    within = F.greatest(F.least(lat, F.lit(89.5)), F.lit(-89.5))
    return F.lit(EARTH_RADIUS) * F.radians(lon), F.lit(EARTH_RADIUS) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(within) / 2))


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EARTH_RADIUS), F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS)) - F.lit(math.pi / 2))


def utm_zone(lon: Column) -> Column:
    return F.least(F.greatest(F.floor((lon + 180) / 6) + 1, F.lit(1)), F.lit(60)).cast("int")


def utm_srid(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)


def to_utm(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Krueger's series to the third order on the WGS 84 ellipsoid, in the point's own zone."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - (utm_zone(lon) * 6 - 183))
    s = F.sin(phi)
    atanh = lambda x: F.log((1 + x) / (1 - x)) / 2
    t = F.sinh(atanh(s) - F.lit(e) * atanh(F.lit(e) * s))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, c in enumerate(alpha, 1):
        x = x + F.lit(c) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + F.lit(c) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(k0 * big) * x + 500000.0, F.lit(k0 * big) * y + F.when(lat < 0, 10000000.0).otherwise(0.0)


def pixel_to_world(col: Column, row: Column, transform) -> tuple[Column, Column]:
    """Six affine coefficients a, b, c, d, e, f: x = a col + b row + c; y = d col + e row + f."""
    a, b, c, d, e, f = transform
    return a * col + b * row + c, d * col + e * row + f


def world_to_pixel(x: Column, y: Column, transform) -> tuple[Column, Column]:
    a, b, c, d, e, f = transform
    det = a * e - b * d
    return (e * (x - c) - b * (y - f)) / det, (a * (y - f) - d * (x - c)) / det


def size_label(pixel_area: Column, gsd: Column | float) -> Column:
    """The size class of an area in pixels; lower bounds belong to the class."""
    g = F.lit(gsd) if not isinstance(gsd, Column) else gsd
    out = None
    for (name, _), (_, upper) in zip(SIZE_BINS, SIZE_BINS[1:]):
        test = pixel_area < F.lit(upper) / (g * g)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(SIZE_BINS[-1][0])


def jitter(b, by: float, seed: int) -> tuple[Column, ...]:
    """Moves each side by up to ``by`` times its box's width or height, the same for a seed and row order."""
    width, height = b[2] - b[0], b[3] - b[1]
    return tuple(side + (2 * F.rand(seed + i) - 1) * by * (width if i % 2 == 0 else height) for i, side in enumerate(b))


def band_split(b, share: float) -> tuple[tuple, tuple]:
    """A box as its northern share and the rest."""
    cut = b[3] - (b[3] - b[1]) * share
    return (b[0], cut, b[2], b[3]), (b[0], b[1], b[2], cut)


def run_lengths_to_pixels(counts: Column, height: Column | int) -> Column:
    """Column-major run lengths, zeros first, as the set pixels' (row, col)."""
    h = F.lit(height) if not isinstance(height, Column) else height
    ends = F.transform(counts, lambda c, i: F.aggregate(F.slice(counts, 1, i + 1), F.lit(0), lambda s, v: s + v))
    runs = F.filter(F.transform(counts, lambda c, i: F.struct((F.element_at(ends, i + 1) - c).alias("at"), c.alias("n"), (i % 2).alias("set"))), lambda r: (r["set"] == 1) & (r["n"] > 0))
    flat = F.flatten(F.transform(runs, lambda r: F.sequence(r["at"], r["at"] + r["n"] - 1)))
    return F.transform(flat, lambda p: F.struct((p % h).cast("int").alias("row"), F.floor(p / h).cast("int").alias("col")))
