"""Column functions on colours: 8-bit RGB and LAB."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the colour spaces: linear RGB to XYZ over the white point of daylight (D65).
TO_X, TO_Y, TO_Z = (0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227)
WHITE_X, WHITE_Z = 0.950456, 1.088754


def lab(r: Column, g: Column, b: Column) -> Column:
    """(l, a, b) of 8-bit RGB, each brought to 0 ... 255."""

    def linear(v: Column) -> Column:
        v = v / 255.0
        return F.when(v > 0.04045, F.pow((v + 0.055) / 1.055, F.lit(2.4))).otherwise(v / 12.92)

    def bent(t: Column) -> Column:
        return F.when(t > 0.008856, F.pow(t, F.lit(1 / 3))).otherwise(7.787 * t + 16 / 116)

    rgb = [linear(c) for c in (r, g, b)]
    x, y, z = (sum((c * k for c, k in zip(rgb[1:], ks[1:], strict=True)), rgb[0] * ks[0]) for ks in (TO_X, TO_Y, TO_Z))
    fx, fy, fz = bent(x / WHITE_X), bent(y), bent(z / WHITE_Z)
    light = F.when(y > 0.008856, 116 * F.pow(y, F.lit(1 / 3)) - 16).otherwise(903.3 * y)
    whole = lambda v: F.least(F.greatest(F.floor(v + 0.5), F.lit(0)), F.lit(255)).cast("int")
    return F.struct(whole(light * 255 / 100).alias("l"), whole(500 * (fx - fy) + 128).alias("a"), whole(200 * (fy - fz) + 128).alias("b"))


def lab_sql(rows: str, *keep: str) -> str:
    """SQL for lab() over rows with r, g, b: the columns `keep`, L, A and B."""
    linear = ", ".join(f"CASE WHEN {c} / 255.0::DOUBLE > 0.04045 THEN pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) ELSE {c} / 255.0::DOUBLE / 12.92 END AS l{c}" for c in "rgb")
    xyz = ", ".join(f"lr * {k[0]} + lg * {k[1]} + lb * {k[2]} AS {n}" for n, k in (("x", TO_X), ("y", TO_Y), ("z", TO_Z)))
    bent = ", ".join(f"CASE WHEN {e} > 0.008856 THEN pow({e}, 1.0::DOUBLE / 3) ELSE 7.787 * {e} + 16.0::DOUBLE / 116 END AS f{n}" for n, e in (("x", f"(x / {WHITE_X})"), ("y", "y"), ("z", f"(z / {WHITE_Z})")))
    whole = lambda e, n: f"least(greatest(floor({e} + 0.5), 0), 255) AS {n}"
    some = ", ".join(keep)
    light = "(CASE WHEN y > 0.008856 THEN 116 * pow(y, 1.0::DOUBLE / 3) - 16 ELSE 903.3 * y END) * 255 / 100"
    return f"SELECT {some}, {whole(light, 'L')}, {whole('500 * (fx - fy) + 128', 'A')}, {whole('200 * (fy - fz) + 128', 'B')} FROM (SELECT {some}, y, {bent} FROM (SELECT {some}, {xyz} FROM (SELECT {some}, {linear} FROM {rows})))"
