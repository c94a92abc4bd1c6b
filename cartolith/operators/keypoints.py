"""Operators on keypoints: coords(raster_id, seq, axis, degree, px, source, status, confidence).

A map has tens of keypoints, maps are many: everything is keyed by raster, aggregates are
pre-aggregated and windows run within a map and axis.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def keypoint_count(coords: DataFrame) -> DataFrame:
    """(raster_id, n): the number of good keypoints on the axis that has fewer."""
    n = [F.count_if((F.col("axis") == a) & (F.col("status") == "ok")) for a in ("lat", "lon")]
    return coords.groupBy("raster_id").agg(F.least(*n).alias("n"))


def needing_more(coords: DataFrame, least: int = 2) -> DataFrame:
    """The maps that a further extractor should look at."""
    return keypoint_count(coords).filter(F.col("n") < least).select("raster_id")


def by_sources(coords: DataFrame, sources: list[str]) -> DataFrame:
    """Keypoints of the listed sources; of all, if none is listed."""
    return coords.filter(F.col("source").isin(sources)) if sources else coords


def has_source(coords: DataFrame, sources: list[str]) -> DataFrame:
    return coords.groupBy("raster_id").agg(F.bool_or(F.col("source").isin(sources)).alias("found"))


def degree_range(coords: DataFrame, sources: list[str], negative: bool) -> DataFrame:
    """(raster_id, axis, low, high, n) of signed degrees from the sources; zeros if there are none."""
    value = F.when(F.col("source").isin(sources), F.abs("degree") * (-1 if negative else 1))
    zero = F.lit(0.0)
    return coords.groupBy("raster_id", "axis").agg(F.coalesce(F.min(value), zero).alias("low"), F.coalesce(F.max(value), zero).alias("high"), F.count(value).alias("n"))


def distinct_degrees(coords: DataFrame) -> DataFrame:
    return coords.groupBy("raster_id", "axis").agg(F.count_distinct("degree").alias("n"))


def source_counts(coords: DataFrame) -> DataFrame:
    """(raster_id, source, summary): `lat;lon` counts."""
    n = [F.count_if(F.col("axis") == a).cast("string") for a in ("lat", "lon")]
    return coords.groupBy("raster_id", "source").agg(F.concat_ws(";", *n).alias("summary"))


def projection_confidence(coords: DataFrame) -> DataFrame:
    """(raster_id, confidence): the product of confidences on each axis, times 1.1 for every
    keypoint beyond two, both axes multiplied, 1 at most."""
    axis = coords.groupBy("raster_id", "axis").agg((F.product("confidence") * F.pow(F.lit(1.1), F.greatest(F.count("*") - 2, F.lit(0)))).alias("c"))
    return axis.groupBy("raster_id").agg(F.least(F.product("c"), F.lit(1.0)).alias("confidence"))


def without_conflict(coords: DataFrame, a: str = "utm", b: str = "state_plane") -> DataFrame:
    """Where both sources occur, one of them goes: the one without an axis, else the one of the
    lower greatest confidence (at a tie, `a`)."""

    def stats(s: str) -> list[Column]:
        own = F.col("source") == s
        axes = [F.count_if(own & (F.col("axis") == x)) for x in ("lat", "lon")]
        return [F.count_if(own).alias(f"n_{s}"), (F.least(*axes) == 0).alias(f"lame_{s}"), F.max(F.when(own, F.col("confidence"))).alias(f"best_{s}")]

    per = coords.groupBy("raster_id").agg(*stats(a), *stats(b))
    both = (F.col(f"n_{a}") > 0) & (F.col(f"n_{b}") > 0)
    loser = F.when(F.col(f"lame_{a}"), a).when(F.col(f"lame_{b}"), b).when(F.col(f"best_{a}") > F.col(f"best_{b}"), b).otherwise(a)
    drop = per.select("raster_id", F.when(both, loser).alias("__drop"))
    return coords.join(drop, "raster_id").filter(~F.col("source").eqNullSafe(F.col("__drop"))).drop("__drop")


def islands(rows: DataFrame, value: str, eps: float, keys: list[str], order: str = "seq") -> DataFrame:
    """rows with `cluster` (0 for the largest, by size and then first row; null for lone values)
    and `cluster_size`: values chained by gaps of at most `eps`, in groups of two or more."""
    w = Window.partitionBy(*keys).orderBy(value, order)
    gap = F.coalesce((F.col(value) - F.lag(value).over(w) > eps).cast("int"), F.lit(0))
    run = rows.withColumn("__gap", gap).withColumn("__run", F.sum("__gap").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    one = Window.partitionBy(*keys, "__run")
    run = run.withColumn("cluster_size", F.count("*").over(one)).withColumn("__first", F.min(order).over(one))
    lone = F.col("cluster_size") < 2
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(lone, F.col("cluster_size").desc(), F.col("__first"))) - 1
    return run.withColumn("cluster", F.when(~lone, rank)).drop("__gap", "__run", "__first")


def collided(coords: DataFrame) -> DataFrame:
    """One row for each (degree, pixel): of several, the first stays, the others move by a pixel,
    where the last one wins, also over what was there before it."""
    w = Window.partitionBy("raster_id", "axis", "degree", "px").orderBy("seq")
    moved = coords.withColumn("key_px", F.col("px") + F.when(F.row_number().over(w) > 1, 1).otherwise(0))
    rest = [c for c in moved.columns if c not in ("raster_id", "axis", "degree", "key_px")]
    return moved.groupBy("raster_id", "axis", "degree", "key_px").agg(F.max_by(F.struct(*rest), "seq").alias("__r")).select("raster_id", "axis", "degree", "key_px", "__r.*")


def residual_threshold(coords: DataFrame, value: str = "degree") -> DataFrame:
    """(raster_id, axis, n, threshold): the median distance from the median, the mean distance if
    that is 0; of more than four values, times the greater of 4 / n and a half."""
    mid = coords.groupBy("raster_id", "axis").agg(F.median(value).alias("__m"))
    off = coords.join(mid, ["raster_id", "axis"]).withColumn("__d", F.abs(F.col(value) - F.col("__m")))
    per = off.groupBy("raster_id", "axis").agg(F.count("*").alias("n"), F.median("__d").alias("mad"), F.avg("__d").alias("mean"))
    base = F.when(F.col("mad") > 0, F.col("mad")).otherwise(F.col("mean"))
    scale = F.when(F.col("n") > 4, F.greatest(4 / F.col("n"), F.lit(0.5))).otherwise(F.lit(1.0))
    return per.select("raster_id", "axis", "n", (base * scale).alias("threshold"))


#: Keypoints of a map and axis up to which all their pairs are tried as lines, and lines tried beyond.
ALL_PAIRS, TRIALS = 64, 2000


def _median(sorted_values: Column, n: Column) -> Column:
    at = F.floor((n - 1) / 2).cast("int")
    return (F.get(sorted_values, at) + F.get(sorted_values, n - 1 - at)) / 2


def inliers(coords: DataFrame, slope_sign: int = 0) -> DataFrame:
    """coords with `inlier`: of the lines through two keypoints of a map and axis that rise with
    the given sign (0: any), the one with most keypoints within the residual threshold decides; of
    equal ones, that of the smallest summed residual, then of the first pair. Without a line all stay.

    A map's keypoints meet in one row. Up to ALL_PAIRS of them all pairs are tried; of more, TRIALS
    pairs drawn by hash, so the work stays linear in them (the bounded trials of a consensus fit).
    """
    keys = ["raster_id", "axis"]
    every = coords.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", *[c for c in coords.columns if c not in ("seq", *keys)]))).alias("pts"))
    every = every.withColumn("n", F.size("pts")).withColumn("mid", _median(F.array_sort(F.transform("pts", lambda p: p["degree"])), F.col("n")))
    every = every.withColumn("off", F.array_sort(F.transform("pts", lambda p: F.abs(p["degree"] - F.col("mid")))))
    mean = F.aggregate("off", F.lit(0.0), lambda t, v: t + v) / F.col("n")
    mad = _median(F.col("off"), F.col("n"))
    scale = F.when(F.col("n") > 4, F.greatest(4 / F.col("n"), F.lit(0.5))).otherwise(F.lit(1.0))
    every = every.withColumn("threshold", F.round(F.when(mad > 0, mad).otherwise(mean) * scale, 9))
    last = F.col("n") - 1
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.transform(F.sequence(i + 1, last), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    x = lambda t, salt: F.pmod(F.xxhash64(F.lit(salt), t), F.col("n")).cast("int")
    drawn = F.filter(F.transform(F.sequence(F.lit(1), F.lit(TRIALS)), lambda t: F.struct(F.least(x(t, 1), x(t, 2)).alias("i"), F.greatest(x(t, 1), x(t, 2)).alias("j"))), lambda p: p["i"] < p["j"])
    none = F.array().cast("array<struct<i:int,j:int>>")
    every = every.withColumn("pairs", F.when(F.col("n") < 2, none).when(F.col("n") <= ALL_PAIRS, pairs).otherwise(F.array_distinct(drawn)))

    def line(p: Column) -> Column:
        a, b = F.get("pts", p["i"]), F.get("pts", p["j"])
        slope = F.when(a["px"] != b["px"], (b["degree"] - a["degree"]) / (b["px"] - a["px"]))
        return F.struct(slope.alias("slope"), (a["degree"] - slope * a["px"]).alias("start"), a["seq"].alias("i"), b["seq"].alias("j"))

    fine = lambda v: v["slope"].isNotNull() & ((F.signum(v["slope"]) == slope_sign) if slope_sign else F.lit(True))
    every = every.withColumn("lines", F.filter(F.transform("pairs", line), fine)).drop("pairs", "off", "mid")

    def voted(v: Column) -> Column:
        off = F.transform("pts", lambda p: F.abs(p["degree"] - (v["slope"] * p["px"] + v["start"])))
        hits = F.filter(off, lambda o: F.round(o, 9) <= F.col("threshold"))
        return F.struct(F.size(hits).alias("votes"), (-F.round(F.aggregate(hits, F.lit(0.0), lambda t, o: t + o), 6)).alias("rest"), (-v["i"]).alias("i"), (-v["j"]).alias("j"), v["slope"].alias("slope"), v["start"].alias("start"))

    best = every.withColumn("line", F.array_max(F.transform("lines", voted)))
    rows = best.select(*keys, "threshold", "line", F.explode("pts").alias("p")).select(*keys, "threshold", "line", "p.*")
    off = F.abs(F.col("degree") - (F.col("line.slope") * F.col("px") + F.col("line.start")))
    return rows.withColumn("inlier", F.coalesce(F.round(off, 9) <= F.col("threshold"), F.lit(True))).select(*coords.columns, "inlier")


def confidence_cut(coords: DataFrame, existing: DataFrame, most: int = 4) -> DataFrame:
    """Keypoints at least as sure as the k-th surest, k being `most` less the number that the map
    has already (existing: raster_id, n): all of up to k, none for k = 0."""
    w = Window.partitionBy("raster_id").orderBy(F.col("confidence").desc())
    k = F.greatest(F.lit(most) - F.coalesce("__n", F.lit(0)), F.lit(0))
    ranked = coords.join(existing.withColumnRenamed("n", "__n"), "raster_id", "left").withColumn("__rank", F.rank().over(w))
    return ranked.filter(F.col("__rank") <= k).drop("__n", "__rank")


def extremes(coords: DataFrame) -> DataFrame:
    """(raster_id, axis, per_pixel): degrees per pixel between the keypoints of least and greatest
    pixel (the first of several); null for one keypoint."""
    low, high = F.min_by("degree", F.struct("px", "seq")), F.max_by("degree", F.struct(F.col("px"), -F.col("seq")))
    per = coords.groupBy("raster_id", "axis").agg(low.alias("d0"), high.alias("d1"), F.min("px").alias("p0"), F.max("px").alias("p1"))
    return per.select("raster_id", "axis", F.try_divide(F.col("d1") - F.col("d0"), F.col("p1") - F.col("p0")).alias("per_pixel"))


def colinear(coords: DataFrame, limit: float = 0.05) -> DataFrame:
    """Maps whose keypoints of an axis lie on a line across it: (raster_id, axis, slope). A slope of
    just the limit is none, whatever its last digits, which depend on the rows' order."""
    per = coords.groupBy("raster_id", "axis").agg(F.regr_slope("py", "px").alias("slope"), F.count("*").alias("n"))
    return per.filter((F.col("n") > 1) & (F.round(F.abs("slope"), 12) < limit)).select("raster_id", "axis", "slope")


def anchors(maps: DataFrame) -> DataFrame:
    """Four fallback keypoints at the corners of a map's region, from the centre degree and the
    scale: maps(raster_id, x0, y0, x1, y1, centre, per_pixel); corners on one side are a pixel apart."""
    corner = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(x).alias("px"), F.col(y).alias("py")) for n, (x, y) in enumerate((("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")))])).alias("c")
    rows = maps.select("*", corner)
    jitter = F.when(F.col("c.n") >= 2, 1).otherwise(0)
    degree = F.col("centre") + (F.col("c.px") - (F.col("x0") + F.col("x1")) / 2) * F.col("per_pixel")
    return rows.select("raster_id", F.col("c.n").alias("n"), (F.col("c.px") + jitter).alias("px"), F.col("c.py").alias("py"), degree.alias("degree"))


def default_hemispheres(points: DataFrame) -> DataFrame:
    """(raster_id, lon_hemi, lat_hemi) of points(raster_id, x, y, lon, lat) without a known fence:
    west if the leftmost longitude is negative or above the rightmost, south if the topmost latitude
    is negative or smaller than the bottom one."""
    per = points.groupBy("raster_id").agg(
        F.min_by("lon", F.struct("x", "seq")).alias("left"), F.max_by("lon", F.struct("x", -F.col("seq"))).alias("right"),
        F.min_by("lat", F.struct("y", "seq")).alias("top"), F.max_by("lat", F.struct("y", -F.col("seq"))).alias("bottom"),
    )
    west = (F.col("left") < 0) | (F.col("left") > F.col("right"))
    south = (F.col("top") < 0) | (F.abs("top") < F.abs("bottom"))
    return per.select("raster_id", F.when(west, -1).otherwise(1).alias("lon_hemi"), F.when(south, -1).otherwise(1).alias("lat_hemi"))


def polynomial_fit(points: DataFrame) -> DataFrame:
    """(raster_id, a, b, c) of degree = a + b x + c y by least squares on centred sums; null where
    the points are too few or lie on a line."""
    mean = points.groupBy("raster_id").agg(*[F.avg(v).alias("m" + v) for v in ("x", "y", "z")])
    rows = points.join(mean, "raster_id")
    dx, dy, dz = (F.col(v) - F.col("m" + v) for v in ("x", "y", "z"))
    sums = rows.groupBy("raster_id", "mx", "my", "mz").agg(*[F.sum(p * q).alias(n) for n, p, q in (("xx", dx, dx), ("yy", dy, dy), ("xy", dx, dy), ("xz", dx, dz), ("yz", dy, dz))])
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    good = F.when(det > 1e-9 * F.col("xx") * F.col("yy"), det)
    b = (F.col("xz") * F.col("yy") - F.col("yz") * F.col("xy")) / good
    c = (F.col("yz") * F.col("xx") - F.col("xz") * F.col("xy")) / good
    return sums.select("raster_id", (F.col("mz") - b * F.col("mx") - c * F.col("my")).alias("a"), b.alias("b"), c.alias("c"))


def held(value: Column, limit: float) -> Column:
    """A value within -limit ... limit; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(limit)), F.lit(-limit)))


def predicted(points: DataFrame, fit: DataFrame, limit: float) -> DataFrame:
    """points(raster_id, x, y) with `value` by the map's fit, held within -limit ... limit; null
    where the map has no fit."""
    value = F.col("a") + F.col("b") * F.col("x") + F.col("c") * F.col("y")
    return points.join(fit, "raster_id").withColumn("value", held(value, limit)).drop("a", "b", "c")
