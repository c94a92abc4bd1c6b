"""Geodesics on WGS-84 as column expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import INV_F, A

FLAT = 1 / INV_F
B = A * (1 - FLAT)


def _with(value: Column, f) -> Column:
    """f(value), where value is worked out once however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def destination(lat: Column, lon: Column, bearing: float, km: Column, rounds: int = 4) -> Column:
    """The point `km` away in a direction (degrees from north): Vincenty's direct series, a fixed
    number of rounds; below a millimetre for distances up to 1000 km."""
    sin_b, cos_b = math.sin(math.radians(bearing)), math.cos(math.radians(bearing))

    def terms(u1: Column) -> Column:
        sin_a = F.cos(u1) * sin_b
        usq = (1 - sin_a * sin_a) * ((A * A - B * B) / (B * B))
        big_a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
        big_b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
        return F.struct(F.sin(u1).alias("su"), F.cos(u1).alias("cu"), F.atan2(F.tan(u1), F.lit(cos_b)).alias("s1"), sin_a.alias("sa"), big_b.alias("b"), (km * 1000 / (B * big_a)).alias("start"))

    def settled(t: Column) -> Column:
        def better(sigma: Column, _: Column) -> Column:
            mid, s = F.cos(2 * t["s1"] + sigma), F.sin(sigma)
            inner = F.cos(sigma) * (2 * mid * mid - 1) - t["b"] / 6 * mid * (4 * s * s - 3) * (4 * mid * mid - 3)
            return t["start"] + t["b"] * s * (mid + t["b"] / 4 * inner)

        return _with(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), t["start"], better), lambda sigma: place(t, sigma))

    def place(t: Column, sigma: Column) -> Column:
        s, c, mid = F.sin(sigma), F.cos(sigma), F.cos(2 * t["s1"] + sigma)
        flat = t["su"] * s - t["cu"] * c * cos_b
        lat2 = F.atan2(t["su"] * c + t["cu"] * s * cos_b, (1 - FLAT) * F.sqrt(t["sa"] * t["sa"] + flat * flat))
        lam = F.atan2(s * sin_b, t["cu"] * c - t["su"] * s * cos_b)
        cos2_a = 1 - t["sa"] * t["sa"]
        k = FLAT / 16 * cos2_a * (4 + FLAT * (4 - 3 * cos2_a))
        dl = lam - (1 - k) * FLAT * t["sa"] * (sigma + k * s * (mid + k * c * (2 * mid * mid - 1)))
        return F.struct(F.degrees(lat2).alias("lat"), (lon + F.degrees(dl)).alias("lon"))

    return _with(_with(F.atan((1 - FLAT) * F.tan(F.radians(lat))), terms), settled)


def degree_span(lat: Column, lon: Column, km: float) -> Column:
    """Half the degrees, by longitude and latitude, that a field of view of `km` covers there."""
    east, north = destination(lat, lon, 90, F.lit(km / 2)), destination(lat, lon, 0, F.lit(km / 2))
    return F.struct(F.abs(east["lon"] - lon).alias("lon"), F.abs(north["lat"] - lat).alias("lat"))


def degrees_per_km(lat: Column, lon: Column) -> Column:
    east, north = destination(lat, lon, 90, F.lit(1.0)), destination(lat, lon, 0, F.lit(1.0))
    return F.struct(F.abs(east["lon"] - lon).alias("lon"), F.abs(north["lat"] - lat).alias("lat"))


def to_conic(lat: Column, lon: Column, lat1: float, lat2: float, lat0: float, lon0: float, east0: float, north0: float) -> Column:
    """Easting and northing (metres) of a Lambert conic zone with two standard parallels."""
    e = math.sqrt(FLAT * (2 - FLAT))

    def m(p: float) -> float:
        return math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)

    def t(p: float) -> float:
        return math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)

    p1, p2, p0 = map(math.radians, (lat1, lat2, lat0))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    f = m(p1) / (n * t(p1) ** n)
    rho0 = A * f * t(p0) ** n
    s = F.sin(F.radians(lat))
    tc = F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2) / F.pow((1 - e * s) / (1 + e * s), F.lit(e / 2))
    rho, theta = A * f * F.pow(tc, F.lit(n)), n * F.radians(lon - lon0)
    return F.struct((east0 + rho * F.sin(theta)).alias("easting"), (north0 + rho0 - rho * F.cos(theta)).alias("northing"))


def destination_sql(rows: str, bearing: float, km: float, rounds: int = 4) -> str:
    """SQL for destination() over rows with id, lat, lon: id, lat, lon, lat2, lon2."""
    sin_b, cos_b, k = math.sin(math.radians(bearing)), math.cos(math.radians(bearing)), (A * A - B * B) / (B * B)
    sql = f"SELECT id, lat, lon, atan({1 - FLAT!r}::DOUBLE * tan(radians(lat))) AS u FROM {rows}"
    sql = f"SELECT *, cos(u) * {sin_b!r}::DOUBLE AS sa, (1 - cos(u) * cos(u) * {sin_b * sin_b!r}::DOUBLE) * {k!r}::DOUBLE AS usq FROM ({sql})"
    sql = f"SELECT *, 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq))) AS big_a, usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq))) AS big_b, atan2(tan(u), {cos_b!r}::DOUBLE) AS s1 FROM ({sql})"
    sql = f"SELECT *, {km * 1000!r}::DOUBLE / ({B!r}::DOUBLE * big_a) AS s0, {km * 1000!r}::DOUBLE / ({B!r}::DOUBLE * big_a) AS s FROM ({sql})"
    for _ in range(rounds):
        mid = "cos(2 * s1 + s)"
        inner = f"cos(s) * (2 * {mid} * {mid} - 1) - big_b / 6 * {mid} * (4 * sin(s) * sin(s) - 3) * (4 * {mid} * {mid} - 3)"
        sql = f"SELECT * EXCLUDE (s), s0 + big_b * sin(s) * ({mid} + big_b / 4 * ({inner})) AS s FROM ({sql})"
    flat = f"(sin(u) * sin(s) - cos(u) * cos(s) * {cos_b!r}::DOUBLE)"
    lat2 = f"degrees(atan2(sin(u) * cos(s) + cos(u) * sin(s) * {cos_b!r}::DOUBLE, {1 - FLAT!r}::DOUBLE * sqrt(sa * sa + {flat} * {flat})))"
    lam = f"atan2(sin(s) * {sin_b!r}::DOUBLE, cos(u) * cos(s) - sin(u) * sin(s) * {cos_b!r}::DOUBLE)"
    c = f"({FLAT / 16!r}::DOUBLE * (1 - sa * sa) * (4 + {FLAT!r}::DOUBLE * (4 - 3 * (1 - sa * sa))))"
    mid = "cos(2 * s1 + s)"
    dl = f"{lam} - (1 - {c}) * {FLAT!r}::DOUBLE * sa * (s + {c} * sin(s) * ({mid} + {c} * cos(s) * (2 * {mid} * {mid} - 1)))"
    return f"SELECT id, lat, lon, {lat2} AS lat2, lon + degrees({dl}) AS lon2 FROM ({sql})"


def span_sql(rows: str, km: float) -> str:
    """SQL for the degrees that `km` cover to the east and to the north of rows: id, lat, lon, slon, slat."""
    return f"SELECT e.id, e.lat, e.lon, abs(e.lon2 - e.lon) AS slon, abs(n.lat2 - n.lat) AS slat FROM ({destination_sql(rows, 90, km)}) e JOIN ({destination_sql(rows, 0, km)}) n ON e.id = n.id"


def conic_sql(lat1: float, lat2: float, lat0: float, lon0: float, east0: float, north0: float) -> tuple[str, str]:
    """SQL of to_conic()'s easting and northing, of columns lat and lon."""
    e = math.sqrt(FLAT * (2 - FLAT))
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p1, p2, p0 = map(math.radians, (lat1, lat2, lat0))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    f = m(p1) / (n * t(p1) ** n)
    at = f"(tan(pi() / 4 - radians(lat) / 2) / pow((1 - {e!r}::DOUBLE * sin(radians(lat))) / (1 + {e!r}::DOUBLE * sin(radians(lat))), {e / 2!r}::DOUBLE))"
    rho, theta = f"{A * f!r}::DOUBLE * pow({at}, {n!r}::DOUBLE)", f"{n!r}::DOUBLE * radians(lon - ({lon0!r}::DOUBLE))"
    return f"{east0!r}::DOUBLE + {rho} * sin({theta})", f"{north0 + A * f * t(p0) ** n!r}::DOUBLE - {rho} * cos({theta})"
