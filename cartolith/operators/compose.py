"""Whole stages from smaller operators: gates, drivers, records."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import keypoints as K


def halted(documents: DataFrame, checks: dict[str, DataFrame], key: str = "doc_id") -> DataFrame:
    """documents with the first check (reason -> table of keys to halt) that stops each; null: go on."""
    out, reasons = documents, []
    for n, (reason, keys) in enumerate(checks.items()):
        out = out.join(keys.select(F.col(key).alias(f"__h{n}")).distinct(), F.col(key) == F.col(f"__h{n}"), "left")
        reasons.append(F.when(F.col(f"__h{n}").isNotNull(), F.lit(reason)))
    return out.withColumn("halt_reason", F.coalesce(*reasons)).drop(*[f"__h{n}" for n in range(len(checks))])


def gated(coords: DataFrame, more: DataFrame, least: int = 2) -> DataFrame:
    """coords, and those of a further extractor for maps that need more keypoints."""
    return coords.unionByName(more.join(K.needing_more(coords, least), "raster_id", "left_semi"))


def rescued(coords: DataFrame, limit: Column) -> DataFrame:
    """coords(.., inlier, slope, start) with outliers taken back whose line passes within `limit`
    pixels of them along the axis."""
    off = F.abs(F.col("px") - F.try_divide(F.col("degree") - F.col("start"), F.col("slope")))
    return coords.withColumn("inlier", F.col("inlier") | F.coalesce(off < limit, F.lit(False)))


def finalised(coords: DataFrame, anchors: DataFrame, corners: Column, least: int = 3) -> DataFrame:
    """coords, and the fallback anchors of maps with fewer than `least` corners and fewer than two
    distinct degrees on an axis."""
    n_corners = coords.groupBy("raster_id").agg(F.count_if(corners).alias("__c"))
    short = K.distinct_degrees(coords).filter(F.col("n") < 2).select("raster_id").distinct()
    need = short.join(n_corners, "raster_id").filter(F.col("__c") < least).select("raster_id")
    return coords.select("raster_id", "degree", "px", F.lit("label").alias("origin")).unionByName(anchors.join(need, "raster_id", "left_semi").select("raster_id", "degree", "px", F.lit("anchor").alias("origin")))


def levers(params: DataFrame, key: str) -> DataFrame:
    """(key, levers): the settings of a document's tasks in order."""
    rows = F.array_sort(F.collect_list(F.struct("task_index", "task_id", "name", "value")))
    return params.groupBy(key).agg(rows.alias("levers"))


def attached(points: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """(key, n_points, legend): points counted, with the document's legend names in order."""
    legend = items.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "label"))), lambda s: s["label"]).alias("legend"))
    return points.groupBy(key).agg(F.count("*").alias("n_points")).join(legend, key, "left")


def dispatched(rows: DataFrame, kind: Column, mappers: dict) -> DataFrame:
    """Each row through the mapper of its kind: mappers name -> function DataFrame to DataFrame."""
    tagged, out = rows.withColumn("__k", kind), None
    for name, mapper in mappers.items():
        part = mapper(tagged.filter(F.col("__k") == name).drop("__k"))
        out = part if out is None else out.unionByName(part)
    return out


def tried(rows: DataFrame, value: Column, error: str) -> DataFrame:
    """rows with `value` and, where it can't be had, `error`: one bad document stops no other."""
    return rows.withColumn("value", value).withColumn("error", F.when(F.col("value").isNull(), F.lit(error)))


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key: a document's state after repeated deliveries."""
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
