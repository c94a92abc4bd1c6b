"""Readers and writers of the file formats around maps. Text formats are parsed from tables of
lines (file, seq, line), so that a folder of many files is one distributed scan."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: The first bytes of image files.
MAGIC = {"png": "89504E47", "jpeg": "FFD8FF", "tiff_le": "49492A00", "tiff_be": "4D4D002A"}
#: Default fences by region name: longitudes, latitudes.
REGIONS = {"world": (-180.0, 180.0, -90.0, 90.0), "us": (-180.0, -66.0, 18.0, 71.0)}


def images(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, path, content) of the image files under a folder, at any depth."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.filter(is_image(F.col("content"))).select(T.document_id(F.col("path")).alias("doc_id"), "path", "content")


def is_image(content: Column) -> Column:
    head = F.hex(F.substring(content, 1, 4))
    return F.coalesce(F.greatest(*[head.startswith(m) for m in MAGIC.values()]), F.lit(False))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, line): the lines of text files in order."""
    rows = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return rows.select("file", F.posexplode(F.split("value", "\r?\n")).alias("seq", "line"))


def query_points(rows: DataFrame, width: Column, height: Column) -> DataFrame:
    """(file, seq, raster_id, x, y, lon, lat) from lines raster, row, column[, lon, lat]. Headers and
    lines of fewer than three fields are passed over; the first point beyond the image ends its file;
    truth counts if it is there and neither part is 0."""
    parts = F.transform(F.split("line", ","), lambda p: F.trim(p))
    own = rows.withColumn("__p", parts).filter((F.size("__p") >= 3) & ~F.col("line").startswith("raster_"))
    number = [F.get("__p", k).try_cast("double") for k in range(5)]
    own = own.withColumn("y", number[1].cast("int")).withColumn("x", number[2].cast("int")).filter("x is not null and y is not null")
    bad = (F.col("x") >= width) | (F.col("y") >= height) | (F.col("x") < 0) | (F.col("y") < 0)
    end = F.min(F.when(bad, F.col("seq"))).over(Window.partitionBy("file"))
    own = own.withColumn("__end", end).filter(F.col("__end").isNull() | (F.col("seq") < F.col("__end")))
    true = (F.size("__p") >= 5) & (number[3] != 0) & (number[4] != 0)
    return own.select("file", "seq", F.get("__p", 0).alias("raster_id"), "x", "y", F.when(true, number[3]).alias("lon"), F.when(true, number[4]).alias("lat"))


def first_and_last(rows: DataFrame, keys: list[str], value: str, order: str = "seq") -> DataFrame:
    """(keys, first, last): the value of the first and of the last line of each key."""
    return rows.groupBy(*keys).agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))


def default_fence(region: Column) -> Column:
    """Bounds by region name; the world for names that aren't known."""
    names = ("lon_min", "lon_max", "lat_min", "lat_max")
    fences = {r: F.struct(*[F.lit(v).alias(c) for c, v in zip(names, b, strict=True)]) for r, b in REGIONS.items()}
    out = fences["world"]
    for r, f in fences.items():
        out = F.when(F.lower(region) == r, f).otherwise(out)
    return out


def truth(rows: DataFrame, schema: str, key: str = "map_id") -> DataFrame:
    """Records of JSON lines, the last for each key."""
    parsed = rows.withColumn("__r", F.from_json("line", schema)).select("seq", "__r.*").filter(F.col(key).isNotNull())
    rest = [c for c in parsed.columns if c not in ("seq", key)]
    return parsed.groupBy(key).agg(F.max_by(F.struct(*rest), "seq").alias("__r")).select(key, "__r.*")


def by_first_key(rows: DataFrame) -> DataFrame:
    """JSON lines with the number that their first key is, by which they sort."""
    first = F.get(F.map_keys(F.from_json("line", "map<string,string>")), 0)
    return rows.withColumn("key", first.try_cast("int"))


def tables_of(rows: DataFrame, xml: str = "xml") -> DataFrame:
    """(doc_id, n, points): the corner points of every table in an XML document."""
    points = F.xpath(F.col(xml), F.lit("//table/Coords/@points"))
    return rows.select("doc_id", F.posexplode(points).alias("n", "points"))


def result_xml(boxes: DataFrame, least: float = 0.7) -> DataFrame:
    """(image_id, xml): the boxes of an image that are sure enough, as tables with four corners."""
    corners = F.format_string('<table><Coords points="%d,%d %d,%d %d,%d %d,%d"/></table>', "x0", "y0", "x0", "y1", "x1", "y1", "x1", "y0")
    rows = boxes.filter(F.col("score") >= least).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("seq", corners.alias("t")))).alias("__t"))
    return rows.select("image_id", F.concat(F.lit("<document>"), F.array_join(F.transform("__t", lambda t: t["t"]), ""), F.lit("</document>")).alias("xml"))


def unquoted_lines(rows: DataFrame) -> DataFrame:
    """Rows as comma-separated lines without quoting; nulls are empty."""
    return rows.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]).alias("line"))


def write_unquoted(rows: DataFrame, path: str) -> None:
    """A header line and the rows, each task its own part file."""
    rows.write.mode("overwrite").option("header", True).option("quote", "\u0000").option("escapeQuotes", False).csv(path)
