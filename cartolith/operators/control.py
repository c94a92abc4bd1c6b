"""Control points, corners, projected labels and the georeference of a map."""

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.storage import durable
from . import keypoints as K
from .runs import chosen

#: How large and small projected coordinates on a label can be, and feet a metre.
MAX_EASTING, FEET = 833_000, 3.280839895
#: A projected coordinate with its direction, and a stated UTM zone.
PROJECTED = r"(?:^|\b)([1-9]?[ ,.]?[0-9]{3}[ ,.]?[0-9]00) ?m?(n|north|e|east)?($|\b)"
ZONE = r"^utm[^0-9]*([1-9]{1,2})\s?([ns])($|\b)"


def projected_labels(ocr: DataFrame) -> DataFrame:
    """(doc_id, idx, value, letters): the last projected coordinate in a text that names no scale."""
    low = F.lower("text")
    found = F.regexp_extract_all(low, F.lit(PROJECTED), F.lit(1))
    letters = F.regexp_extract_all(low, F.lit(PROJECTED), F.lit(2))
    rows = ocr.filter(~low.rlike("scale|:")).withColumn("__f", found).filter(F.size("__f") > 0)
    value = F.regexp_replace(F.element_at("__f", -1), "[^0-9]", "").cast("double")
    return rows.select("doc_id", "idx", value.alias("value"), F.element_at(letters, -1).alias("letters"))


def stated_zone(text: Column) -> Column:
    """Zone and hemisphere letter of `utm zone 12n`; null parts otherwise."""
    low = F.lower(text)
    zone, side = F.regexp_extract(low, ZONE, 1), F.regexp_extract(low, ZONE, 2)
    return F.struct(F.when(zone != "", zone.cast("int")).alias("zone"), F.when(side != "", side).alias("side"))


def in_metres(value: Column, nad83: Column) -> Column:
    """State-plane values are feet on newer maps."""
    return F.when(nad83, value / FEET).otherwise(value)


def valid_projections(labels: DataFrame) -> DataFrame:
    """Labels of documents none of whose eastings passes the greatest easting there is."""
    north = geo.is_utm_northing(F.col("value"), F.col("letters"))
    rows = labels.withColumn("northing", north)
    bad = rows.groupBy("doc_id").agg(F.bool_or(~F.col("northing") & (F.col("value") >= MAX_EASTING)).alias("__bad"))
    return rows.join(bad.filter(~F.col("__bad")).drop("__bad"), "doc_id")


def medians(labels: DataFrame) -> DataFrame:
    mid = [F.median(F.when(F.col("northing") == n, F.col("value"))).alias(name) for n, name in ((False, "easting"), (True, "northing"))]
    return labels.groupBy("doc_id").agg(*mid)


def two_clusters(values: DataFrame, eps: float = 50_000) -> DataFrame:
    """values(doc_id, seq, value) with `part` 0 or 1 for the two largest clusters of a document; a
    single value beside one cluster makes the second."""
    rows = K.islands(values, "value", eps, ["doc_id"])
    whole = Window.partitionBy("doc_id")
    lone, clusters = F.count_if(F.col("cluster").isNull()).over(whole), F.max("cluster").over(whole)
    part = F.when(F.col("cluster") <= 1, F.col("cluster")).when(F.col("cluster").isNull() & (lone == 1) & (clusters == 0), 1)
    return rows.withColumn("part", part.cast("int")).filter("part is not null").select(*values.columns, "part")


def overlap_direction(values: DataFrame) -> DataFrame:
    """(doc_id, part, is_x): of the first repeated value in a part, whether its two places differ
    less by x than by y."""
    w = Window.partitionBy("doc_id", "part", "value").orderBy("seq")
    rows = values.withColumn("__dx", F.abs(F.col("x") - F.lag("x").over(w))).withColumn("__dy", F.abs(F.col("y") - F.lag("y").over(w))).filter("__dx is not null")
    return rows.groupBy("doc_id", "part").agg(F.min_by(F.col("__dx") < F.col("__dy"), "seq").alias("is_x"))


def cluster_axis(degrees: DataFrame, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    """(doc_id, axis) of a cluster (doc_id, seq, x, y, degree): above 90 degrees a longitude; else the
    only range that its first value fits; else by how the places of one degree spread; else null."""
    first = degrees.groupBy("doc_id").agg(F.min_by("degree", "seq").alias("d"))
    same = degrees.groupBy("doc_id", "degree").agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"), F.count("*").alias("n"), F.min("seq").alias("s"))
    told = F.when(F.col("dx") * 0.05 > F.col("dy"), "lat").when(F.col("dy") * 0.05 > F.col("dx"), "lon")
    spread = same.filter("n > 1").withColumn("a", told).filter("a is not null").groupBy("doc_id").agg(F.min_by("a", "s").alias("spread"))
    fits = [F.col("d").between(*r) for r in (lat, lon)]
    axis = F.when(F.abs("d") > 90, "lon").when(fits[0] & ~fits[1], "lat").when(~fits[0] & fits[1], "lon").otherwise(F.col("spread"))
    return first.join(spread, "doc_id", "left").select("doc_id", axis.alias("axis"))


def corners(coords: DataFrame, reach: float = 2.0) -> DataFrame:
    """(raster_id, lon_seq, lat_seq, x, y): where a vertical line through a longitude label meets a
    horizontal one through a latitude label, each as long as `reach` label widths both ways. In order
    of the longitudes; a latitude serves one longitude, which may take several."""
    lon = coords.filter(F.col("axis") == "lon").select("raster_id", F.col("seq").alias("lon_seq"), F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("width").alias("lw"))
    lat = coords.filter(F.col("axis") == "lat").select(F.col("raster_id").alias("r"), F.col("seq").alias("lat_seq"), F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("width").alias("tw"))
    met = lon.join(lat, F.col("raster_id") == F.col("r")).filter((F.abs(F.col("ly") - F.col("ty")) <= reach * F.col("lw")) & (F.abs(F.col("lx") - F.col("tx")) <= reach * F.col("tw")))
    first = F.row_number().over(Window.partitionBy("raster_id", "lat_seq").orderBy("lon_seq"))
    return met.withColumn("__n", first).filter("__n = 1").select("raster_id", "lon_seq", "lat_seq", F.col("lx").alias("x"), F.col("ty").alias("y"))


def control_points(coords: DataFrame, most: int = 8, distance: float = 30.0, seed: int = 911) -> DataFrame:
    """Up to `most` keypoints of a map, corners first, then by confidence in an order drawn from the
    map and seed; none within `distance` of one chosen before."""

    def choose(g: dict[str, np.ndarray]) -> list[int]:
        x, y, kept = g["x"], g["y"], []
        for n in range(len(x)):
            if len(kept) >= most and not g["corner"][n]:
                break
            if all((x[k] - x[n]) ** 2 + (y[k] - y[n]) ** 2 > distance * distance for k in kept):
                kept.append(n)
        return kept

    rows = coords.select("raster_id", "seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "corner", "confidence").withColumn("draw", F.xxhash64(F.lit(seed), "raster_id", "seq"))
    return chosen(rows, ["raster_id"], [F.col("corner").desc(), F.when(~F.col("corner"), -F.col("confidence")), F.when(F.col("corner"), F.col("seq")), "draw"], choose).drop("draw")


def empty_quadrants(points: DataFrame, rois: DataFrame) -> DataFrame:
    """(raster_id, quadrant, x, y): the map's corner for each quarter, cut at the outer region's
    edges, that holds no control point."""
    corner = F.array(*[F.struct(F.lit(n).alias("quadrant"), F.col(x).alias("x"), F.col(y).alias("y")) for n, (x, y) in enumerate((("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")))])
    rows = rois.select("raster_id", "x0", "y0", "x1", "y1", "margin", F.explode(corner).alias("c")).select("raster_id", "x0", "y0", "x1", "y1", "margin", "c.*")
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    right, low = F.col("quadrant").isin(1, 2), F.col("quadrant").isin(2, 3)
    px, py = F.col("px"), F.col("py")
    inside = F.when(right, px.between(mx, F.col("x1") + F.col("margin"))).otherwise(px.between(F.col("x0") - F.col("margin"), mx)) & F.when(low, py.between(my, F.col("y1") + F.col("margin"))).otherwise(py.between(F.col("y0") - F.col("margin"), my))
    own = points.select(F.col("raster_id").alias("__r"), F.col("x").alias("px"), F.col("y").alias("py"))
    return rows.join(own, (F.col("raster_id") == F.col("__r")) & inside, "left_anti").select("raster_id", "quadrant", "x", "y")


def random_points(rois: DataFrame, n: int, seed: int = 911) -> DataFrame:
    """(raster_id, n, x, y): points in the middle half of a region, drawn from its id and the seed."""

    def drawn(c: str, salt: int) -> Column:
        part = F.pmod(F.xxhash64(F.lit(seed + salt), "raster_id", "n"), F.lit(1_000_003)) / 1_000_003
        size = F.col(f"{c}1") - F.col(f"{c}0")
        return F.floor(F.col(f"{c}0") + size / 4 + part * size / 2)

    rows = rois.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.select("raster_id", "n", drawn("x", 0).alias("x"), drawn("y", 1).alias("y"))


def sampled(places: DataFrame, most: int, seed: int = 911) -> DataFrame:
    """At most `most` places of a map, drawn by hash: a stated sampling operator."""
    w = Window.partitionBy("map_id").orderBy(F.xxhash64(F.lit(seed), "map_id", "seq"), "seq")
    return places.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most).drop("__n")


def relaxed(kept: DataFrame, every: DataFrame, least: int = 2) -> DataFrame:
    """kept, and for maps and axes with fewer than `least` distinct degrees the surest others, at
    half their confidence, until there are as many."""
    keys = ["raster_id", "axis"]
    have = kept.groupBy(*keys).agg(F.collect_set("degree").alias("__have"))
    rest = every.join(kept.select(*keys, "seq"), [*keys, "seq"], "left_anti").join(have, keys, "left").withColumn("__have", F.coalesce("__have", F.array().cast("array<double>")))
    order = Window.partitionBy(*keys).orderBy(F.col("confidence").desc(), "seq")
    before = F.size(F.array_union(F.col("__have"), F.coalesce(F.collect_set("degree").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.array().cast("array<double>"))))
    more = rest.withColumn("__n", before).filter(F.col("__n") < least).withColumn("confidence", F.col("confidence") / 2)
    return kept.withColumn("relaxed", F.lit(False)).unionByName(more.drop("__n", "__have").withColumn("relaxed", F.lit(True)))


def in_ring(coords: DataFrame, rois: DataFrame) -> DataFrame:
    """Keypoints whose box meets the outer box and doesn't lie wholly in the inner one."""
    met = coords.join(rois, "raster_id")
    x0, y0, x1, y1 = (F.col(c) for c in ("bx0", "by0", "bx1", "by1"))
    outer = (x0 <= F.col("ox1")) & (x1 >= F.col("ox0")) & (y0 <= F.col("oy1")) & (y1 >= F.col("oy0"))
    hole = (x0 > F.col("ix0")) & (x1 < F.col("ix1")) & (y0 > F.col("iy0")) & (y1 < F.col("iy1"))
    return met.filter(outer & ~hole).select(*coords.columns)


def georeferenced(points: DataFrame, coords: DataFrame, fences: DataFrame) -> DataFrame:
    """points(raster_id, seq, x, y) with lon, lat and confidence from the map's good keypoints
    coords(raster_id, axis, seq, px (x), py (y), degree, confidence): conflicting and outlying ones
    go, each axis is fitted by least squares in x and y, held within the globe and signed by the
    fence's hemisphere. A map with fewer than two distinct keypoints on an axis gets the fence's
    middle, at confidence 0."""
    # Outliers are judged along each axis' own pixel: x for longitudes, y for latitudes.
    along = F.when(F.col("axis") == "lat", F.col("py")).otherwise(F.col("px"))
    unmixed = durable(K.without_conflict(coords).withColumn("__x", F.col("px")).withColumn("px", along))
    good = durable(K.inliers(unmixed).filter("inlier").drop("inlier"))
    enough = K.distinct_degrees(good).groupBy("raster_id").agg((F.count("*") == 2).alias("both"), F.min("n").alias("n")).filter("both and n >= 2").select("raster_id")
    out = points
    for axis, name, limit in (("lon", "lon", 180.0), ("lat", "lat", 90.0)):
        own = good.filter(F.col("axis") == axis).select("raster_id", F.col("__x").alias("x"), F.col("py").alias("y"), F.col("degree").alias("z"))
        fit = K.polynomial_fit(own).join(enough, "raster_id")
        value = F.col("a") + F.col("b") * F.col("x") + F.col("c") * F.col("y")
        out = out.join(fit, "raster_id", "left").withColumn(f"__{name}", K.held(value, limit)).drop("a", "b", "c")
    out = out.join(K.projection_confidence(good), "raster_id", "left").join(fences, "raster_id", "left")
    fine = F.col("__lon").isNotNull() & F.col("__lat").isNotNull()
    for name in ("lon", "lat"):
        mid = (F.col(f"{name}_min") + F.col(f"{name}_max")) / 2
        out = out.withColumn(name, F.when(fine, geo.signed(F.col(f"__{name}"), geo.hemisphere(F.col(f"{name}_min"), F.col(f"{name}_max")))).otherwise(mid))
    return out.select("raster_id", "seq", "x", "y", "lon", "lat", F.when(fine, F.col("confidence")).otherwise(F.lit(0.0)).alias("confidence"))
