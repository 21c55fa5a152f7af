"""Distances on the sphere as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres.
EARTH_RADIUS_M = 6371000.0
KMH_PER_MS = 3.6


def chord(dlat: Column, dlon: Column, lat1_cos: Column, lat2_cos: Column) -> Column:
    """The haversine term for angle differences in degrees."""
    return F.pow(F.sin(F.radians(dlat) / 2), 2) + lat1_cos * lat2_cos * F.pow(
        F.sin(F.radians(dlon) / 2), 2
    )


def arc(term: Column, known: bool = False) -> Column:
    """Metres for a haversine term, null for a null term.

    With ``known`` the term is taken to be non-null and evaluated once.
    """
    capped = F.least(F.lit(1.0), term) if known else F.when(term > 1, 1.0).otherwise(term)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(capped))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between points in degrees."""
    return arc(
        chord(lat2 - lat1, lon2 - lon1, F.cos(F.radians(lat1)), F.cos(F.radians(lat2)))
    )


def point_key(lat: Column, lon: Column) -> Column:
    """A point as text, to one millionth of a degree."""
    def micro(x: Column) -> Column:
        return F.round(x * 1_000_000).cast("long").cast("string")

    return F.concat_ws(":", micro(lat), micro(lon))


def kmh_to_ms(speed: Column) -> Column:
    return speed / KMH_PER_MS


def ms_to_kmh(speed: Column) -> Column:
    return speed * KMH_PER_MS


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(value, high))


# The WGS 84 ellipsoid, semi-major axis in metres and flattening.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563


def geodesic(lat1: Column, lon1: Column, lat2: Column, lon2: Column, steps: int = 25) -> Column:
    """Distance in metres along the WGS 84 ellipsoid between points in degrees.

    The inverse problem is solved by a fixed number of steps for the difference of longitude on the
    auxiliary sphere, which settle long before unless the points are nearly opposite each other.
    There, where the steps do not settle, the distance is the one over the nearer pole, which
    exceeds the shortest by at most 0.4 percent.
    """
    a, f = WGS84_A, WGS84_F
    b, one = a * (1 - f), F.lit(1.0)

    def let(value: Column, body) -> Column:
        """``body(value)`` with the value computed once."""
        return F.transform(F.array(value), body)[0]

    def beta(lat: Column) -> Column:
        return F.atan(F.lit(1 - f) * F.tan(F.radians(lat)))

    def on_sphere(sides: Column, far: Column) -> Column:
        """The arc between the points, and the geodesic's angle at the equator, for a longitude."""
        su1, cu1, su2, cu2 = (sides[n] for n in ("su1", "cu1", "su2", "cu2"))
        across = F.pow(cu2 * F.sin(far), F.lit(2.0)) + F.pow(cu1 * su2 - su1 * cu2 * F.cos(far), F.lit(2.0))

        def with_sine(sine: Column) -> Column:
            cosine = su1 * su2 + cu1 * cu2 * F.cos(far)
            sin_alpha = F.when(sine > 0, cu1 * cu2 * F.sin(far) / sine).otherwise(0.0)

            def with_alpha(sa: Column) -> Column:
                cos2 = one - sa * sa
                middle = F.when(cos2 > 1e-12, cosine - 2 * su1 * su2 / cos2).otherwise(0.0)
                return F.struct(
                    sine.alias("sine"), cosine.alias("cosine"), F.atan2(sine, cosine).alias("arc"),
                    sa.alias("sa"), cos2.alias("cos2"), middle.alias("middle"),
                )

            return let(sin_alpha, with_alpha)

        return let(F.sqrt(across), with_sine)

    def next_longitude(sides: Column, far: Column) -> Column:
        def move(x: Column) -> Column:
            c = f / 16 * x["cos2"] * (4 + f * (4 - 3 * x["cos2"]))
            bend = x["arc"] + c * x["sine"] * (
                x["middle"] + c * x["cosine"] * (2 * x["middle"] * x["middle"] - 1)
            )
            return sides["turn"] + (1 - c) * f * x["sa"] * bend

        return let(on_sphere(sides, far), move)

    def length(x: Column) -> Column:
        u2 = x["cos2"] * ((a * a - b * b) / (b * b))
        scale = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
        c = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
        m = x["middle"]
        inner = x["cosine"] * (2 * m * m - 1) - c / 6 * m * (4 * x["sine"] * x["sine"] - 3) * (4 * m * m - 3)
        return b * scale * (x["arc"] - c * x["sine"] * (m + c / 4 * inner))

    def over_the_pole(sides: Column) -> Column:
        # The meridian quarter, less or more the arcs to both points by their mean curvature.
        quarter = _meridian(F.lit(90.0))
        one_way, other_way = sides["north1"] + sides["north2"], -(sides["north1"] + sides["north2"])
        return 2 * quarter - F.greatest(one_way, other_way)

    def solved(sides: Column) -> Column:
        start = F.struct(sides["turn"].alias("now"), sides["turn"].alias("before"))
        end = F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)),
            start,
            lambda s, _: F.struct(next_longitude(sides, s["now"]).alias("now"), s["now"].alias("before")),
        )

        def finish(s: Column) -> Column:
            settled = (F.abs(s["now"] - s["before"]) < 1e-11) & (F.abs(s["now"]) <= F.pi())
            return F.when(settled, let(on_sphere(sides, s["now"]), length)).otherwise(over_the_pole(sides))

        return let(end, finish)

    turn = F.radians(F.pmod(lon2 - lon1 + 180, F.lit(360.0)) - 180)
    sides = F.struct(
        F.sin(beta(lat1)).alias("su1"), F.cos(beta(lat1)).alias("cu1"),
        F.sin(beta(lat2)).alias("su2"), F.cos(beta(lat2)).alias("cu2"),
        turn.alias("turn"), _meridian(lat1).alias("north1"), _meridian(lat2).alias("north2"),
    )
    same = (lat1 == lat2) & (F.abs(turn) < 1e-15)
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, F.when(same, 0.0).otherwise(let(sides, solved)))


def _meridian(lat: Column) -> Column:
    """Metres along a meridian from the equator to a latitude."""
    n = WGS84_F / (2 - WGS84_F)
    phi = F.radians(lat)
    scale = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = [(-3 / 2 * (n - n**3 / 8), 2), (15 / 16 * (n**2 - n**4 / 4), 4), (-35 / 48 * n**3, 6), (315 / 512 * n**4, 8)]
    total = phi
    for c, k in series:
        total = total + c * F.sin(k * phi)
    return F.lit(scale) * total
