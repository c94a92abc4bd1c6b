"""Operators on geocoded places and fences."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the default fence (the whole world, in absolute degrees).
WORLD = {"lon": (-180.0, 180.0), "lat": (-90.0, 90.0)}


def envelope(places: DataFrame, feature: str) -> DataFrame:
    """A fence for each map: the bounds of the places of a feature type."""
    bounds = [F.min("lon0").alias("lon_min"), F.max("lon1").alias("lon_max"), F.min("lat0").alias("lat_min"), F.max("lat1").alias("lat_max")]
    return places.filter(F.col("feature") == feature).groupBy("map_id").agg(*bounds)


def fence_cascade(maps: DataFrame, *fences: DataFrame) -> DataFrame:
    """maps with the first fence that exists, and its place in the cascade; else the whole world."""
    names = ("lon_min", "lon_max", "lat_min", "lat_max")
    out = maps
    for n, f in enumerate(fences):
        out = out.join(f.select(F.col("map_id").alias(f"__m{n}"), F.struct(*names).alias(f"__f{n}")), F.col("map_id") == F.col(f"__m{n}"), "left")
    world = F.struct(*[F.lit(v).alias(c) for c, v in zip(names, (*WORLD["lon"], *WORLD["lat"]), strict=True)])
    found = F.coalesce(*[F.col(f"__f{n}") for n in range(len(fences))], world)
    level = F.coalesce(*[F.when(F.col(f"__f{n}").isNotNull(), F.lit(n)) for n in range(len(fences))], F.lit(len(fences)))
    return out.select("map_id", found.alias("__f"), level.alias("level")).select("map_id", "__f.*", "level")


def narrowed(narrow: DataFrame, wide: DataFrame, span: float) -> DataFrame:
    """A narrow fence that lies in the wide one, widened about its middle to `span` degrees at
    least and cut at the wide one; otherwise the wide one."""
    w = wide.select("map_id", *[F.col(c).alias("w_" + c) for c in ("lon_min", "lon_max", "lat_min", "lat_max")])
    both = w.join(narrow, "map_id", "left")
    fits = F.lit(True)
    for c in ("lon", "lat"):
        fits = fits & (F.col(f"{c}_min") >= F.col(f"w_{c}_min")) & (F.col(f"{c}_max") <= F.col(f"w_{c}_max"))
    fits = F.coalesce(fits, F.lit(False))
    out = []
    for c in ("lon", "lat"):
        mid = (F.col(f"{c}_min") + F.col(f"{c}_max")) / 2
        low, high = F.least(F.col(f"{c}_min"), mid - span / 2), F.greatest(F.col(f"{c}_max"), mid + span / 2)
        out += [F.when(fits, F.greatest(low, F.col(f"w_{c}_min"))).otherwise(F.col(f"w_{c}_min")).alias(f"{c}_min"), F.when(fits, F.least(high, F.col(f"w_{c}_max"))).otherwise(F.col(f"w_{c}_max")).alias(f"{c}_max")]
    return both.select("map_id", *out, fits.alias("narrowed"))


def in_fence(lon: Column, lat: Column) -> Column:
    return lon.between(F.col("lon_min"), F.col("lon_max")) & lat.between(F.col("lat_min"), F.col("lat_max"))


def fenced(places: DataFrame, fences: DataFrame) -> DataFrame:
    """places(map_id, seq, lon, lat) within the map's fence, with `rank` by distance to its middle."""
    met = places.join(fences, "map_id").filter(in_fence(F.col("lon"), F.col("lat")))
    dx, dy = F.col("lon") - (F.col("lon_min") + F.col("lon_max")) / 2, F.col("lat") - (F.col("lat_min") + F.col("lat_max")) / 2
    w = Window.partitionBy("map_id", "place").orderBy(dx * dx + dy * dy, "seq")
    return met.withColumn("rank", F.row_number().over(w)).drop("lon_min", "lon_max", "lat_min", "lat_max")


def by_common_centre(places: DataFrame) -> DataFrame:
    """places with `rank` among a place's candidates by distance to the weighted middle of the map's
    candidates, each weighing one over the number of its place's candidates."""
    place, whole = Window.partitionBy("map_id", "place"), Window.partitionBy("map_id")
    rows = places.withColumn("__w", 1 / F.count("*").over(place))
    mean = {c: F.sum(F.col("__w") * F.col(c)).over(whole) / F.sum("__w").over(whole) for c in ("lon", "lat")}
    rows = rows.withColumn("__x", F.round(mean["lon"], 9)).withColumn("__y", F.round(mean["lat"], 9))
    dx, dy = F.col("lon") - F.col("__x"), F.col("lat") - F.col("__y")
    w = Window.partitionBy("map_id", "place").orderBy(F.round(dx * dx + dy * dy, 6), "seq")
    return rows.withColumn("rank", F.row_number().over(w)).drop("__w", "__x", "__y")


def coordinates(places: DataFrame, absolute: bool = True) -> DataFrame:
    """The first candidate of each place as a coordinate pair: confidence 0.8, 0.4 with several
    candidates; one pair a pixel, the first."""
    n = F.count("*").over(Window.partitionBy("map_id", "place"))
    first = F.row_number().over(Window.partitionBy("map_id", "place").orderBy("seq"))
    rows = places.withColumn("confidence", F.when(n > 1, 0.4).otherwise(0.8)).withColumn("__r", first).filter("__r = 1")
    pixel = F.row_number().over(Window.partitionBy("map_id", "px", "py").orderBy("seq"))
    rows = rows.withColumn("__p", pixel).filter("__p = 1")
    value = F.abs if absolute else (lambda c: F.col(c))
    return rows.select("map_id", "place", "px", "py", value("lon").alias("lon"), value("lat").alias("lat"), "confidence")
