"""Column functions on degrees, ranges, angles and projections."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS-84.
A, INV_F = 6378137.0, 298.257223563


def sign(x: Column) -> Column:
    return F.when(x < 0, -1).otherwise(1)


def slope_signs(lon_hemi: Column, lat_hemi: Column) -> Column:
    """Signs of degrees per pixel: longitudes fall in the west, absolute latitudes rise in the south."""
    return F.struct(F.when(lon_hemi < 0, -1).otherwise(1).alias("lon"), F.when(lat_hemi < 0, 1).otherwise(-1).alias("lat"))


def absolute_range(low: Column, high: Column) -> Column:
    """The range of absolute values; from 0 if the range crosses it."""
    a, b = F.abs(low), F.abs(high)
    crosses = (low * high) < 0
    return F.struct(F.when(crosses, F.lit(0.0)).otherwise(F.least(a, b)).cast("double").alias("low"), F.greatest(a, b).cast("double").alias("high"))


def in_range(x: Column, low: Column, high: Column, strict_reference: bool = True) -> Column:
    """Whether a value, signed or absolute, fits a range. Across zero an absolute value may stand
    for either side; the strict form compares it with the upper end only."""
    same = F.abs(x).between(F.least(F.abs(low), F.abs(high)), F.greatest(F.abs(low), F.abs(high)))
    lo, hi = F.least(low, high), F.greatest(low, high)
    end = F.abs(hi) if strict_reference else F.greatest(F.abs(lo), F.abs(hi))
    return F.when(low * high >= 0, same).otherwise(x.between(lo, hi) | x.between(F.lit(0), end))


def hemisphere(low: Column, high: Column) -> Column:
    return F.when((low + high) / 2 >= 0, 1).otherwise(-1)


def signed(x: Column, hemi: Column) -> Column:
    return F.abs(x) * hemi


def degrees(d: Column, m: Column, s: Column) -> Column:
    return d + F.coalesce(m, F.lit(0)) / 60 + F.coalesce(s, F.lit(0)) / 3600


def consecutive(d: Column, m: Column, s: Column) -> Column:
    """49 50 51 is a row of numbers rather than an angle."""
    return (m == d + 1) & (s == m + 1)


#: What counts as an angle on a map, by kind, in order of trust.
DMS = r"\b[-+]?([0-9]{1,2}|1[0-7][0-9]|180)( |[o*°⁰˙˚•·º:]|( ?,?[o*°⁰˙˚•·º:]))( ?[0-6]?[0-9])['`′/:]?( ?[0-6][0-9])?[\"″'`′/:]?($|\b)"
DEGREES = r"\b[-+]?([0-9]{1,2}|1[0-7][0-9]|180) ?,?[o*°⁰˙˚•·º⁹]($|\b)"
DECIMAL = r"\b[-+]?([0-9]{1,2}|1[0-7][0-9]|180)(\.[0-9]{1,3})[o*°⁰˙˚•·º]?($|\b)"


def dms_parts(text: Column) -> Column:
    """Degrees, minutes and seconds of a text's first angle: with minutes, else whole degrees, else
    decimal ones; null parts where there are none. Signs aren't read."""

    def part(pattern: str, group: int) -> Column:
        return F.regexp_replace(F.regexp_extract(text, pattern, group), "[^0-9]", "").try_cast("int")

    dms, one = text.rlike(DMS), text.rlike(DEGREES)
    ten = F.concat(F.regexp_extract(text, DECIMAL, 1), F.regexp_extract(text, DECIMAL, 2)).try_cast("double")
    return F.struct(
        F.when(dms, part(DMS, 1).cast("double")).when(one, part(DEGREES, 1).cast("double")).otherwise(ten).alias("d"),
        F.when(dms, part(DMS, 4)).alias("m"),
        F.when(dms, part(DMS, 5)).alias("s"),
    )


def angle_in_range(x: Column, a: Column, b: Column) -> Column:
    """Whether an angle lies between two others, going round 0."""
    x, a, b = F.pmod(x, F.lit(360)), F.pmod(a, F.lit(360)), F.pmod(b, F.lit(360))
    return F.when(a <= b, (x >= a) & (x <= b)).otherwise((x >= a) | (x <= b))


def compass(trig: Column, most: int = 360) -> Column:
    """Counter-clockwise degrees to clockwise ones; beyond `most` they wrap, `most` itself stays."""
    turned = F.when(trig > 0, 360 - trig).otherwise(-trig)
    return F.when(turned > most, turned - most).otherwise(turned)


def dpi(x: Column, y: Column, least: float = 72.0, default: float = 300.0) -> Column:
    mean = (x + y) / 2
    return F.when(mean < least, F.lit(default)).otherwise(F.coalesce(mean, F.lit(default)))


def km_per_pixel(denominator: Column, dots: Column) -> Column:
    return F.when(denominator > 0, denominator * 2.54e-5 / dots).otherwise(F.lit(0.0))


def skew_threshold(size: Column, angle: float = 20.0) -> Column:
    return size * math.sin(math.radians(angle)) / 2


def geographic_code(epsg: Column, country: Column, year: Column, default: int = 4326) -> Column:
    """The reference system: stated, else by country and year of North American maps."""
    american = country.isin("us", "ca")
    return F.coalesce(epsg, F.when(american & (year >= 1990), 4269).when(american & (year >= 1930), 4267), F.lit(default))


def evidence_of_nad83(datum: Column, systems: Column, year: Column) -> Column:
    listed = F.exists(F.coalesce(systems, F.array().cast("array<string>")), lambda s: s.contains("83"))
    return F.coalesce(datum.contains("83"), F.lit(False)) | listed | F.coalesce(year >= 1986, F.lit(False))


def is_utm_northing(value: Column, letters: Column) -> Column:
    """By direction letter; without one, a value above 834 000 is a northing."""
    return F.when(letters.contains("e"), False).when(letters.contains("n"), True).otherwise(value > 834_000)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def _krueger() -> tuple[float, list[float], float]:
    n = 1 / (2 * INV_F - 1)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    return n, alpha, radius


def to_utm(lat: Column, lon: Column, zone: Column) -> Column:
    """Easting and northing (northern origin; southern points get 10 000 km added), Krueger series
    to the third order: within a millimetre."""
    n, alpha, radius = _krueger()
    k0, e = 0.9996, 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    y = k0 * radius * north
    return F.struct((500_000 + k0 * radius * east).alias("easting"), F.when(lat < 0, y + 10_000_000).otherwise(y).alias("northing"))


def from_utm(easting: Column, northing: Column, zone: Column, south: Column) -> Column:
    """Latitude and longitude of a UTM point."""
    n, _, radius = _krueger()
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    k0 = 0.9996
    y = F.when(south, northing - 10_000_000).otherwise(northing)
    xi, eta = y / (k0 * radius), (easting - 500_000) / (k0 * radius)
    x1, e1 = xi, eta
    for j, b in enumerate(beta, 1):
        x1 = x1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        e1 = e1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x1) / F.cosh(e1))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.struct(F.degrees(phi).alias("lat"), (F.degrees(F.atan2(F.sinh(e1), F.cos(x1))) + (zone * 6 - 183)).alias("lon"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(a))
