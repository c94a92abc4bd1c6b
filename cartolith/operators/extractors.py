"""The extractors and filters that a map's keypoints pass through, one after another, and the small
rules of their drivers. Keypoints are coords(raster_id, seq, axis, degree, px, py, source, status,
confidence) as in `keypoints`; everything is keyed by map."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import geodesy as Y
from ..functions import geometry as G
from . import keypoints as K
from .places import WORLD

BOUNDS = ("lon_min", "lon_max", "lat_min", "lat_max")
#: UTM ends at these latitudes.
UTM_LATITUDES = (-80.0, 84.0)


def source_score(coords: DataFrame, source: str) -> DataFrame:
    """(raster_id, n, best): how many keypoints of a source, and their greatest confidence; -1: none."""
    own = F.col("source") == source
    return coords.groupBy("raster_id").agg(F.count_if(own).alias("n"), F.coalesce(F.max(F.when(own, F.col("confidence"))), F.lit(-1.0)).alias("best"))


def without_source(coords: DataFrame, source: str) -> DataFrame:
    return coords.filter(F.col("source") != source)


def in_region(texts: DataFrame, rois: DataFrame) -> DataFrame:
    """Texts (raster_id, box, ...) whose box meets their map's region; all of them where a map has
    no region."""
    met = texts.join(rois.select("raster_id", F.col("box").alias("__roi")), "raster_id", "left")
    return met.filter(F.col("__roi").isNull() | G.overlap(F.col("box"), F.col("__roi"))).drop("__roi")


def regular_increment(minutes: Column, seconds: Column, strict_reference: bool = True) -> Column:
    """Whether an angle is a sixteenth or a twelfth of a degree; the strict form lets all pass."""
    whole = minutes * 60 + seconds
    return F.lit(True) if strict_reference else (whole % 225 == 0) | (whole % 300 == 0)


def small_gap(rows: DataFrame, keys: list[str], value: str, strict_reference: bool = True) -> DataFrame:
    """(keys, place): where the smallest gap between neighbouring values begins. The strict form
    compares with the first gap alone, so the last one below it counts; 0 without any."""
    w = Window.partitionBy(*keys).orderBy(value)
    gaps = rows.withColumn("place", F.row_number().over(w) - 1).withColumn("gap", F.lead(value).over(w) - F.col(value)).filter("gap is not null")
    if not strict_reference:
        return gaps.groupBy(*keys).agg(F.min_by("place", F.struct("gap", "place")).alias("place"))
    first = gaps.withColumn("first", F.first("gap").over(w))
    return first.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("gap") < F.col("first"), F.col("place"))), F.lit(0)).alias("place"))


def first_latitudes(clusters: DataFrame) -> DataFrame:
    """(raster_id, cluster): the first cluster that is known to be of latitudes."""
    return clusters.filter("known and latitude").groupBy("raster_id").agg(F.min("cluster").alias("cluster"))


def batches_of(rows: DataFrame, keys: list[str], order: str, size: int = 20) -> DataFrame:
    """rows with the number of the batch that they are worked on in."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("int"))


def northings(values: DataFrame, known: DataFrame) -> DataFrame:
    """values(doc_id, idx, value, letters) with northing and how it was told: by its letter, else as
    the nearest of the document's known values (doc_id, seq, known, is_north), if there are some in
    both directions and it is less than ten times away; otherwise an easting."""
    both = known.groupBy("doc_id").agg((F.bool_or("is_north") & F.bool_or(~F.col("is_north"))).alias("both")).filter("both").select("doc_id")
    near = values.join(known.join(both, "doc_id"), "doc_id").groupBy("doc_id", "idx").agg(F.min_by(F.struct("known", "is_north"), F.struct(F.abs(F.col("known") - F.col("value")), "seq")).alias("nearest"))
    out = values.join(near, ["doc_id", "idx"], "left")
    text, ratio = F.lower(F.coalesce("letters", F.lit(""))), F.col("value") / F.col("nearest.known")
    close = F.coalesce((ratio > 0.1) & (ratio < 10), F.lit(False))
    north = F.when(text.contains("e"), False).when(text.contains("n"), True).when(close, F.col("nearest.is_north")).otherwise(False)
    how = F.when(text.contains("e") | text.contains("n"), "parsed").when(close, "proximity").otherwise("default")
    return out.withColumn("northing", north).withColumn("how", how).drop("nearest")


def zone_cascade(maps: DataFrame) -> DataFrame:
    """maps with the state plane zone and where it is from: the clue point's, the parsed
    coordinates', the only one of the state, the one that the map's coordinate systems name, else
    that of the fence's middle; an empty code if none is known. maps(raster_id, clue_zone,
    parsed_zone, state_zones: array<struct<name, zone>>, systems: array<string>, fence_zone); a clue
    point or parsed coordinates decide, even if no zone holds them."""
    zones = F.coalesce("state_zones", F.array().cast("array<struct<name:string,zone:string>>"))
    systems = F.transform(F.coalesce("systems", F.array().cast("array<string>")), F.lower)
    named = F.get(F.filter(zones, lambda z: F.array_contains(systems, F.lower(z["name"]))), 0)["zone"]
    only = F.when(F.size(zones) == 1, F.get(zones, 0)["zone"])
    steps = [(F.col("has_clue"), "clue point", F.col("clue_zone")), (F.col("has_parsed"), "parsed coordinates", F.col("parsed_zone")), (only.isNotNull(), "only option", only), (named.isNotNull(), "crs", named)]
    zone, how = F.col("fence_zone"), F.lit("default")
    for holds, name, code in reversed(steps):
        zone, how = F.when(holds, code).otherwise(zone), F.when(holds, F.lit(name)).otherwise(how)
    return maps.select("raster_id", F.coalesce(zone, F.lit("")).alias("zone"), how.alias("how"))


def default_fences(maps: DataFrame) -> DataFrame:
    """The fence of maps(raster_id, lon_minmax, lat_minmax) as the request has it, else the world;
    hemispheres 1, 1."""
    ends = [F.coalesce(F.get(f"{a}_minmax", n), F.lit(WORLD[a][n])).alias(f"{a}_{e}") for a in ("lon", "lat") for n, e in enumerate(("min", "max"))]
    return maps.select("raster_id", *ends, F.lit(1).alias("lon_hemi"), F.lit(1).alias("lat_hemi"))


def parsing_fences(maps: DataFrame, fences: DataFrame) -> DataFrame:
    """(raster_id, absolute bounds, is_default): what degrees on a map may be, signs apart. A map
    without a fence takes its request's ranges, or all degrees."""
    out = maps.join(fences.select("raster_id", F.struct(*BOUNDS).alias("__f"), (F.col("kind") == "default").alias("__d")), "raster_id", "left")
    columns = []
    for a, top in (("lon", 180.0), ("lat", 90.0)):
        low = F.coalesce(F.col(f"__f.{a}_min"), F.get(f"{a}_minmax", 0), F.lit(0.0))
        high = F.coalesce(F.col(f"__f.{a}_max"), F.get(f"{a}_minmax", 1), F.lit(top))
        r = geo.absolute_range(low, high)
        columns += [r["low"].alias(f"{a}_low"), r["high"].alias(f"{a}_high")]
    return out.select("raster_id", *columns, F.coalesce("__d", F.lit(True)).alias("is_default"))


def widened(ranges: DataFrame, km: float = 700.0) -> DataFrame:
    """ranges(raster_id, bounds) widened by half of `km` on each side, as degrees at their low corner."""
    s = Y.degree_span(F.col("lat_min"), F.col("lon_min"), km)
    rows = ranges.withColumn("__s", s)
    return rows.select("raster_id", *[(F.col(f"{a}_{e}") + k * F.col("__s")[a]).alias(f"{a}_{e}") for a in ("lon", "lat") for e, k in (("min", -1), ("max", 1))])


def shifted_datum(points: DataFrame, system: str, target: str, shift: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """points(lon, lat, ...) in the target's datum: those of another system, where they came from
    outside, go through `shift`; the others stay."""
    moved = F.col("external") & (F.col(system) != F.lit(target))
    return points.filter(~moved).unionByName(shift(points.filter(moved)).select(*points.columns))


def narrowed_by_text(fences: DataFrame, found: DataFrame) -> DataFrame:
    """Fences with the ranges of degrees that were read on the map, where these lie within them;
    axis by axis."""
    own = found.select("raster_id", *[F.col(b).alias("__" + b) for b in BOUNDS])
    rows, out = fences.join(own, "raster_id", "left"), []
    for a in ("lon", "lat"):
        fits = F.coalesce((F.col(f"__{a}_min") >= F.col(f"{a}_min")) & (F.col(f"__{a}_max") <= F.col(f"{a}_max")), F.lit(False))
        out += [F.when(fits, F.col(f"__{a}_{e}")).otherwise(F.col(f"{a}_{e}")).alias(f"{a}_{e}") for e in ("min", "max")]
    return rows.select("raster_id", *out)


def span_centre(x0: Column, x1: Column, begin: Column, end: Column) -> Column:
    """The middle of the part of a box from share `begin` to share `end` of its width."""
    part = (begin > 0) | (end < 1)
    low, high = x0 + (x1 - x0) * begin, x1 - (x1 - x0) * (1 - end)
    return F.when(part, (low + high) / 2).otherwise((x0 + x1) / 2)


# ---- drivers -----------------------------------------------------------------------------------


def _with_seq(coords: DataFrame, more: DataFrame) -> DataFrame:
    """Keypoints added to those that a map has: of equal axis, degree and pixel, the new one stays."""
    key = ["raster_id", "axis", "degree", "px"]
    return coords.join(more.select(*key), key, "left_anti").unionByName(more.select(*coords.columns))


def extracted_degrees(texts: DataFrame, fences: DataFrame) -> DataFrame:
    """Keypoints from the angles in texts(raster_id, seq, text, px, py): an angle that isn't a row
    of numbers and lies in the map's absolute latitudes or longitudes (parsing_fences()); one that
    fits both counts as a longitude above the latitudes' limit and as a latitude otherwise."""
    parts = geo.dms_parts(F.col("text"))
    rows = texts.withColumn("__p", parts).filter(F.col("__p.d").isNotNull() & ~F.coalesce(geo.consecutive(F.col("__p.d"), F.col("__p.m"), F.col("__p.s")), F.lit(False)))
    rows = rows.withColumn("degree", geo.degrees(F.col("__p.d"), F.col("__p.m"), F.col("__p.s"))).join(fences, "raster_id")
    fits = {a: F.col("degree").between(F.col(f"{a}_low"), F.col(f"{a}_high")) for a in ("lon", "lat")}
    axis = F.when(fits["lat"], "lat").when(fits["lon"], "lon")
    return rows.withColumn("axis", axis).filter("axis is not null").select("raster_id", "seq", "axis", "degree", "px", "py", F.lit("lat_lon").alias("source"), F.lit("ok").alias("status"), F.lit(0.95).alias("confidence"))


def lat_lon_extractor(coords: DataFrame, texts: DataFrame, fences: DataFrame) -> DataFrame:
    """Maps with too few keypoints get those of their texts, in place of what they had."""
    maps = texts.select("raster_id").distinct()
    enough = K.keypoint_count(coords).filter("n >= 2").select("raster_id")
    todo = maps.join(enough, "raster_id", "left_anti")
    found = extracted_degrees(texts.join(todo, "raster_id", "left_semi"), fences)
    return coords.join(todo, "raster_id", "left_anti").unionByName(found.select(*coords.columns))


def utm_limits(maps: DataFrame) -> DataFrame:
    """maps(raster_id, zone, bounds) with the latitudes that UTM values may have: the fence's, in
    order and within UTM; all of UTM's where zone and fence don't overlap."""
    south, north = (F.lit(v) for v in UTM_LATITUDES)
    low, high = F.greatest(F.least("lat_min", "lat_max"), south), F.least(F.greatest("lat_min", "lat_max"), north)
    west = F.col("zone") * 6 - 186
    meets = (west <= F.greatest("lon_min", "lon_max")) & (west + 6 >= F.least("lon_min", "lon_max"))
    return maps.withColumn("meets", meets).select("raster_id", "zone", "meets", F.when(F.col("meets"), low).otherwise(south).alias("lat_low"), F.when(F.col("meets"), high).otherwise(north).alias("lat_high"))


def utm_extractor(coords: DataFrame, labels: DataFrame, maps: DataFrame) -> DataFrame:
    """Keypoints from a map's UTM values, added to those that it has. labels(raster_id, seq, value,
    northing, px, py); maps as for utm_limits(). A value's other half is the map's median of the
    other direction; without one there is no keypoint."""
    mid = labels.groupBy("raster_id").agg(F.median(F.when(F.col("northing"), F.col("value"))).alias("__n"), F.median(F.when(~F.col("northing"), F.col("value"))).alias("__e"))
    rows = labels.join(mid.filter("__n is not null and __e is not null"), "raster_id").join(utm_limits(maps), "raster_id")
    east, north = F.when(F.col("northing"), F.col("__e")).otherwise(F.col("value")), F.when(F.col("northing"), F.col("value")).otherwise(F.col("__n"))
    at = geo.from_utm(east, north, F.col("zone"), F.lit(False))
    rows = rows.withColumn("__at", at).filter(F.col("__at.lat").between(F.col("lat_low"), F.col("lat_high")))
    axis = F.when(F.col("northing"), "lat").otherwise("lon")
    degree = F.abs(F.when(F.col("northing"), F.col("__at.lat")).otherwise(F.col("__at.lon")))
    more = rows.select("raster_id", "seq", axis.alias("axis"), degree.alias("degree"), "px", "py", F.lit("utm").alias("source"), F.lit("ok").alias("status"), F.lit(0.75).alias("confidence"))
    return _with_seq(coords, more)


def state_plane_extractor(coords: DataFrame, labels: DataFrame, zones: DataFrame, lookups: bool, to_degrees: Callable[[Column, Column], Column]) -> DataFrame:
    """As utm_extractor(), for maps whose state plane zone (zone_cascade()) is known; to_degrees
    makes (lat, lon) of eastings and northings. Without lookup tables no keypoint is left at all."""
    if not lookups:
        return coords.limit(0)
    mid = labels.groupBy("raster_id").agg(F.median(F.when(F.col("northing"), F.col("value"))).alias("__n"), F.median(F.when(~F.col("northing"), F.col("value"))).alias("__e"))
    rows = labels.join(mid.filter("__n is not null and __e is not null"), "raster_id").join(zones.filter("zone <> ''"), "raster_id", "left_semi")
    at = to_degrees(F.when(F.col("northing"), F.col("__e")).otherwise(F.col("value")), F.when(F.col("northing"), F.col("value")).otherwise(F.col("__n")))
    rows = rows.withColumn("__at", at)
    axis = F.when(F.col("northing"), "lat").otherwise("lon")
    degree = F.abs(F.when(F.col("northing"), F.col("__at.lat")).otherwise(F.col("__at.lon")))
    more = rows.select("raster_id", "seq", axis.alias("axis"), degree.alias("degree"), "px", "py", F.lit("state_plane").alias("source"), F.lit("ok").alias("status"), F.lit(0.75).alias("confidence"))
    return _with_seq(coords, more)


def filtered(coords: DataFrame, *filters: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Keypoints through one filter after another; each sees both axes of all maps."""
    for f in filters:
        coords = f(coords)
    return coords


def control_points(given: DataFrame, made: DataFrame, drawn: DataFrame) -> DataFrame:
    """Each map's control points: those that were given with the request, else those made of its
    keypoints, else drawn ones. All three: (raster_id, seq, x, y)."""
    out = given.withColumn("origin", F.lit("given"))
    for rows, name in ((made, "made"), (drawn, "drawn")):
        out = out.unionByName(rows.join(out.select("raster_id").distinct(), "raster_id", "left_anti").withColumn("origin", F.lit(name)))
    return out


def any_in_ring(points: DataFrame, rings: DataFrame) -> DataFrame:
    """(ring_id, found) of rings(raster_id, ring_id, ring): whether any of the map's points lies in it."""
    met = rings.join(points.select("raster_id", "x", "y"), "raster_id", "left")
    inside = F.coalesce(G.point_in_ring(F.col("x"), F.col("y"), F.col("ring")), F.lit(False))
    return met.groupBy("ring_id").agg(F.bool_or(inside).alias("found"))


def usable_cache(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """(key) of cached entries that have as many labels as there are predictions now."""
    n = cached.select("key", F.size("labels").alias("__n"))
    return wanted.join(n, "key").filter((F.col("__n") == F.col("predictions")) & (F.col("__n") > 0)).select("key")


def geocoded(places: DataFrame, kind: str, look_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The places of a kind with what the look-up knows of them; the others as they are, without."""
    own = look_up(places.filter(F.col("kind") == kind))
    return own.unionByName(places.filter(F.col("kind") != kind).withColumn("boxes", F.lit(None).cast(own.schema["boxes"].dataType)))


def task_inputs(tables: dict[str, DataFrame], needs: list[str]) -> dict[str, DataFrame]:
    """What a task sees of its pipeline's tables: those that it names. A table that isn't there yet
    is left out, and tables can't be changed in place."""
    return {n: tables[n] for n in needs if n in tables}


def output_of(rows: DataFrame, kind: str, key: str = "raster_id") -> DataFrame:
    """(key, output_type, output): a model table as JSON records, a row each."""
    return rows.select(key, F.lit(kind).alias("output_type"), F.to_json(F.struct(*[c for c in rows.columns if c != key])).alias("output"))


def label_records(labels: DataFrame) -> DataFrame:
    """(raster_id, output_type, output): a map's point labels in order, as one record."""
    item = F.struct("seq", "class_name", "x0", "y0", "x1", "y1", "score")
    rows = labels.groupBy("raster_id").agg(F.array_sort(F.collect_list(item)).alias("labels"))
    return output_of(rows, "points")
