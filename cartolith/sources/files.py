"""Objects by name under a folder: bytes, JSON and images, written by the executors, read by Spark."""

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import durable


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def has(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; a store that can't be asked counts as absent."""
    try:
        files, place = _at(spark, path)
        return bool(files.exists(place))
    except Exception as e:  # unknown scheme, no such host, no permission
        if "java" not in type(e).__module__ and not hasattr(e, "java_exception"):
            raise
        return False


def required(spark: SparkSession, **paths: str) -> None:
    """Raises an error that names all settings whose path isn't there."""
    missing = sorted(n for n, p in paths.items() if not has(spark, p))
    if missing:
        raise ValueError(f"no such place: {', '.join(missing)}")


def keys(spark: SparkSession, prefix: str, most: int = 1000) -> list[str]:
    """The first names, in order, that begin with a prefix: at most one listing page."""
    files, place = _at(spark, prefix + "*")
    return sorted(s.getPath().getName() for s in files.globStatus(place) or [])[:most]


def fetched(spark: SparkSession, source: str, folder: str, overwrite: bool = False) -> str:
    """The path of a copy of `source` in `folder`; copied only if it isn't there, or to overwrite it."""
    there = f"{folder}/{source.rstrip('/').rpartition('/')[2]}"
    if overwrite or not has(spark, there):
        (a, x), (b, y) = _at(spark, source), _at(spark, there)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, x, b, y, False, True, spark._jsc.hadoopConfiguration())
    return there


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def write_bytes(rows: DataFrame, folder: str) -> DataFrame:
    """Writes rows (name, content) as files under a folder, with folders in between; (name, size) of
    each. A name that ends in a slash is an error. A file that is written again is the same file, so
    tasks can be tried again."""
    root_uri = _uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(root_uri)
        for b in batches:
            names, sizes = b["name"].to_pylist(), []
            for name, content in zip(names, b["content"].to_pylist(), strict=True):
                if not name or name.endswith("/"):
                    raise ValueError(f"{name!r} is no file name")
                store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{root}/{name}") as f:
                    f.write(content or b"")
                sizes.append(len(content or b""))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["name", "size"])

    return durable(rows.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(write, "name string, size long"))


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(name, size, content) of the files under a folder, at any depth, or of a single file. A
    folder that isn't there is an error; the content is read only where it is used."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return rows.select(F.substring_index("path", folder.rstrip("/").rpartition("/")[2] + "/", -1).alias("name"), F.col("length").alias("size"), "content")


def looked_up(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """wanted(name, ...) with the content of its file; null where there is none."""
    return wanted.join(files.select("name", "content"), "name", "left")


def json_objects(rows: DataFrame, name: Column) -> DataFrame:
    """(name, content): each row as one JSON object."""
    return rows.select(name.alias("name"), F.to_json(F.struct(*rows.columns)).alias("content"))


def json_lists(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, content): the rows of each key as one JSON list, in order."""
    items = F.array_sort(F.collect_list(F.struct(order, *[c for c in rows.columns if c not in (key, order)])))
    return rows.groupBy(key).agg(F.to_json(items).alias("content"))


def read_json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The JSON objects, or lists of objects, of the files under a folder; one file, one text."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(folder)


def places_reference(spark: SparkSession, path: str) -> DataFrame:
    """(place, box) from JSON objects {place: [[lon, lat, lon, lat], ...]}; no rows if there is no
    such file or it can't be parsed."""
    kind = "map<string,array<array<double>>>"
    if not has(spark, path):
        return spark.createDataFrame([], "place string, box array<double>")
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("m"))
    return whole.select(F.explode("m").alias("place", "boxes")).select("place", F.explode("boxes").alias("box"))


def zone_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(zone, ring) of GeoJSON features: the outer ring of each polygon, with its FIPS zone."""
    schema = "features array<struct<properties: map<string,string>, geometry: struct<coordinates: array<array<array<double>>>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    ring = F.transform(F.get("f.geometry.coordinates", 0), lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))
    return rows.select(F.lpad(F.col("f.properties")["FIPSZONE"], 4, "0").alias("zone"), ring.alias("ring"))


def requested_ids(spark: SparkSession, path: str) -> DataFrame:
    """(image_id) from files with an id a line; blank lines are passed over."""
    return spark.read.text(path).select(F.trim("value").alias("image_id")).filter("image_id <> ''")


def write_control_points(points: DataFrame, folder: str) -> None:
    """points(raster_id, x, y, lon, lat) as CSV with a header, a folder for each raster."""
    points.write.partitionBy("raster_id").option("header", True).csv(folder)


def control_points(spark: SparkSession, folder: str, raster_id: str | None = None) -> DataFrame:
    """(raster_id, x, y, lon, lat) back; of one raster, only its folder is read."""
    rows = spark.read.schema("raster_id string, x double, y double, lon double, lat double").option("header", True).csv(folder)
    return rows if raster_id is None else rows.filter(F.col("raster_id") == raster_id)


def listed_points(rows: DataFrame, content: str = "content") -> DataFrame:
    """(raster_id, x, y, lon, lat) from JSON records {map: {name, projection_info: {gcps: [...]}}}."""
    schema = "map struct<name: string, projection_info: struct<gcps: array<struct<px_geom: struct<x: double, y: double>, map_geom: struct<longitude: double, latitude: double>>>>>"
    own = rows.select(F.from_json(content, schema).alias("r")).select("r.map.name", F.explode("r.map.projection_info.gcps").alias("g"))
    return own.select(F.col("name").alias("raster_id"), "g.px_geom.x", "g.px_geom.y", F.col("g.map_geom.longitude").alias("lon"), F.col("g.map_geom.latitude").alias("lat"))


def form_tokens(rows: DataFrame, content: str = "content") -> DataFrame:
    """(page, item, pos, label, token, box) from JSON records {form: [{label, words: [{text, box}]}]};
    blank words are passed over, as positions count only the others."""
    schema = "form array<struct<label: string, words: array<struct<text: string, box: array<int>>>>>"
    items = rows.select("page", F.posexplode(F.from_json(content, schema)["form"]).alias("item", "f"))
    words = F.filter("f.words", lambda w: F.trim(w["text"]) != "")
    return items.select("page", "item", F.col("f.label").alias("label"), F.posexplode(words).alias("pos", "w")).select("page", "item", "pos", "label", F.col("w.text").alias("token"), F.col("w.box").alias("box"))
