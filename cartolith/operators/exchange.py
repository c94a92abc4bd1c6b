"""Nested exchange records from flat results."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Region classes and the area types that they are exchanged as.
AREA_TYPES = {
    "cross_section": "cross_section",
    "legend_points_lines": "line_point_legend_area",
    "legend_polygons": "polygon_legend_area",
    "map": "map_area",
}


def areas(regions: DataFrame, system: str, version: str) -> DataFrame:
    """A region as area_type, bbox [x0, y0, x1, y1] (from x, y, w, h), confidence, system."""
    types = F.create_map(*[F.lit(v) for kv in AREA_TYPES.items() for v in kv])
    x, y = F.col("x"), F.col("y")
    return regions.select("doc_id", "seq", F.coalesce(types[F.col("class_label")], F.lit("text")).alias("area_type"), F.array(x, y, x + F.col("w"), y + F.col("h")).alias("bbox"), "confidence", F.lit(system).alias("system"), F.lit(version).alias("system_version"))


def control_points(points: DataFrame, epsg: Column) -> DataFrame:
    """One record a raster: gcps in order (id gcp.<n>, px, geo), crs and projected file name."""
    gcp = F.struct(F.concat(F.lit("gcp."), (F.col("n")).cast("string")).alias("gcp_id"), F.struct("lon", "lat").alias("map_geom"), F.struct("x", "y").alias("px_geom"), "confidence")
    rows = points.withColumn("n", F.col("seq")).groupBy("raster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", gcp.alias("g")))), lambda r: r["g"]).alias("gcps"), F.min(epsg).alias("crs"))
    return rows.withColumn("file_name", F.concat_ws("_", F.col("raster_id").cast("string"), F.regexp_extract("crs", r"\d+", 0), F.lit("projected.tif")))


def metadata_record(rows: DataFrame) -> DataFrame:
    """title, authors (joined by commas), year (a whole number or null), scale (after the colon),
    the rest null where it is the text NULL."""

    def known(c: str) -> Column:
        return F.nullif(F.col(c), F.lit("NULL"))

    scale = F.element_at(F.split(known("scale"), ":"), -1).try_cast("int")
    return rows.select("map_id", F.struct(known("title").alias("title"), F.concat_ws(", ", "authors").alias("authors"), known("year").try_cast("int").alias("year"), scale.alias("scale"), known("crs").alias("crs")).alias("record"))


def envelope(rows: DataFrame, payload: Column, request: str = "request_id") -> DataFrame:
    """The result message: request, success, output as JSON text ({} for nothing)."""
    return rows.select(request, F.lit(True).alias("success"), F.coalesce(F.to_json(payload), F.lit("{}")).alias("output"))


def pivoted_summary(counts: DataFrame, sources: list[str]) -> DataFrame:
    """One row a raster with `lat;lon` counts for each source, `0;0` where there is none."""
    out = counts.groupBy("raster_id").pivot("source", sources).agg(F.first("summary"))
    return out.na.fill("0;0")
