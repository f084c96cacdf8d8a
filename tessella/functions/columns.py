"""Column expressions: grids, projection, datums, bands, geometry. All run inside generated code."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain.
GRID_M = 25.0
EARTH_KM = 6371.0
OFFSET_BUCKETS = ((-26.533, 1.15), (-26.908, 1.00))
OFFSET_REST = 1.26
#: GRS80 and the zone's parameters (central meridian 153 degrees).
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
SCALE, FALSE_EAST, FALSE_NORTH, MERIDIAN = 0.9996, 500000.0, 10000000.0, 153.0


def col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def cell_round(v, size: float = GRID_M) -> Column:
    """Cell on the grid anchored at cell centres; halves go to the even cell."""
    return F.rint(col(v) / F.lit(float(size))).cast("bigint")


def cell_floor(v, size: float = GRID_M) -> Column:
    """Cell on the grid anchored at cell corners."""
    return F.floor(col(v) / F.lit(float(size))).cast("bigint")


def centre_round(k, size: float = GRID_M) -> Column:
    return col(k) * F.lit(float(size))


def centre_floor(k, size: float = GRID_M) -> Column:
    return col(k) * F.lit(float(size)) + F.lit(size / 2)


def pack_key(cx, cy, factor: int = 10_000_000) -> Column:
    return col(cx).cast("bigint") * F.lit(factor) + col(cy)


def unpack_key(key, factor: int = 10_000_000) -> tuple[Column, Column]:
    y = F.pmod(col(key), F.lit(factor))
    return ((col(key) - y) / F.lit(factor)).cast("bigint"), y


def round_to(x, digits: int) -> Column:
    """Rounding by scaling, the same on engines that round doubles half away from zero."""
    return F.round(col(x) * F.lit(10.0**digits), 0) / F.lit(10.0**digits)


def exact_sum(x, digits: int = 6) -> Column:
    """A sum that does not depend on the order of its terms: scaled to whole numbers first."""
    return F.sum(F.round(col(x) * F.lit(10.0**digits), 0).cast("decimal(38,0)"))


def lat_offset(lat) -> Column:
    """Datum offset by latitude bucket; bounds are strict."""
    out = F.lit(OFFSET_REST)
    for bound, value in reversed(OFFSET_BUCKETS):
        out = F.when(col(lat) > F.lit(bound), F.lit(value)).otherwise(out)
    return out


def depth(z, offset) -> Column:
    """Metres below datum: positive is under water, negative dries."""
    return -col(z) - col(offset)


def tide_band(e, b1, b2) -> Column:
    return F.when(col(e) < 0, "blue").when(col(e) <= col(b1), "teal").when(col(e) <= col(b2), "amber").otherwise("gold")


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    s = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(col(lng2) - col(lng1)) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(s)))


def _series() -> tuple[float, list[float], list[float], list[float]]:
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    return radius, alpha, beta, delta


def to_grid(lat, lng, meridian=MERIDIAN) -> tuple[Column, Column]:
    """(easting, northing) of a transverse Mercator zone by a third-order series."""
    meridian = meridian if isinstance(meridian, Column) else F.lit(meridian)
    radius, alpha, _, _ = _series()
    e = 2 * math.sqrt(FLATTENING * (2 - FLATTENING) / 4)
    phi, lam = F.radians(col(lat)), F.radians(col(lng) - meridian)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(e) * F.atanh(F.lit(e) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(FALSE_EAST) + F.lit(SCALE * radius) * east, F.lit(FALSE_NORTH) + F.lit(SCALE * radius) * north


def to_geographic(east, north, shift: tuple[float, float] = (0.0, 0.0), meridian=MERIDIAN) -> tuple[Column, Column]:
    """(lat, lng); shift is a datum shift in degrees."""
    meridian = meridian if isinstance(meridian, Column) else F.lit(meridian)
    radius, _, beta, delta = _series()
    xi, eta = (col(north) - F.lit(FALSE_NORTH)) / F.lit(SCALE * radius), (col(east) - F.lit(FALSE_EAST)) / F.lit(SCALE * radius)
    u, v = xi, eta
    for j, b in enumerate(beta, 1):
        u = u - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    return F.degrees(phi) + F.lit(shift[0]), meridian + F.degrees(F.atan2(F.sinh(v), F.cos(u))) + F.lit(shift[1])


#: Codes of the zones' grids by datum, and each datum's shift to the geographic one in degrees (none is applied).
CRS_SERIES = {28300: (0.0, 0.0), 7800: (0.0, 0.0)}
CRS_ZONES = range(49, 57)


def _by_crs(epsg, then) -> tuple[Column, Column]:
    """then(meridian, shift) for the zone that epsg names; another code is an error."""
    code = col(epsg).cast("int")
    out = [F.raise_error(F.concat(F.lit("unknown grid "), F.coalesce(code.cast("string"), F.lit("null")))).cast("double")] * 2
    for series, shift in CRS_SERIES.items():
        pair = then((code - series) * 6.0 - 183.0, shift)
        out = [F.when(code.between(series + CRS_ZONES[0], series + CRS_ZONES[-1]), p).otherwise(o) for p, o in zip(pair, out, strict=True)]
    return out[0], out[1]


def geographic_of(epsg, east, north) -> tuple[Column, Column]:
    """(lat, lng) of a grid place in the zone that the code names."""
    return _by_crs(epsg, lambda meridian, shift: to_geographic(east, north, shift, meridian))


def grid_of(epsg, lat, lng) -> tuple[Column, Column]:
    """(easting, northing) in the zone that the code names."""
    return _by_crs(epsg, lambda meridian, shift: to_grid(col(lat) - F.lit(shift[0]), col(lng) - F.lit(shift[1]), meridian))


def in_ring(x, y, ring: Sequence[tuple[float, float]]) -> Column:
    """Even-odd test against a literal ring of (x, y); points on an edge may count either way."""
    out = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if y1 != y2:
            crosses = (F.lit(y1) > col(y)) != (F.lit(y2) > col(y))
            out = out + F.when(crosses & (col(x) < F.lit(x2 - x1) * (col(y) - F.lit(y1)) / F.lit(y2 - y1) + F.lit(x1)), 1).otherwise(0)
    return out % 2 == 1


def ring_contains(ring, x, y) -> Column:
    """Even-odd test against a column of rings: array of struct(x, y), first point repeated at the end or not."""
    r = col(ring)
    pairs = F.zip_with(r, F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1)), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    px, py = col(x), col(y)
    hit = lambda e: ((e["y1"] > py) != (e["y2"] > py)) & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"])
    return F.size(F.filter(pairs, hit)) % 2 == 1


def cross_side(px, py, ax, ay, bx, by) -> Column:
    """Cross product of the segment a to b with a to p: negative on its right, the sea side of a coastline."""
    return (col(bx) - col(ax)) * (col(py) - col(ay)) - (col(by) - col(ay)) * (col(px) - col(ax))


def raster_place(v, low, high, n, flip: bool = False) -> Column:
    """Row or column of a coordinate in a raster of n cells, truncated and clamped; rows count from the north."""
    share = (col(high) - col(v)) if flip else (col(v) - col(low))
    return F.least(F.greatest((share / (col(high) - col(low)) * col(n)).cast("int"), F.lit(0)), col(n) - 1)
