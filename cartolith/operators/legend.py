"""Swatches found by recognition, joined to the legend items of a map; words joined to lines."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy
from . import keypoints as K
from .lookups import best_by
from .runs import chosen


def joined_swatches(swatches: DataFrame, items: DataFrame) -> DataFrame:
    """(raster_id, class_name, item_seq, how): the best swatch of each class against the legend.

    A class that an item has already stays as it is (`known`). Else it goes to the nearest item
    without a class, if the distance of the middles is below the smallest side of both boxes
    (`claimed`), else it is a new item (`new`). Classes come in the order of their first swatch, and
    an item that one has claimed isn't free for the next. swatches and items have raster_id, seq,
    class_name, x0, y0, x1, y1.
    """
    first = swatches.groupBy("raster_id", "class_name").agg(F.min("seq").alias("turn"))
    best = best_by(swatches, ["raster_id", "class_name"], F.col("score")).join(first, ["raster_id", "class_name"])
    known = items.filter(F.coalesce("class_name", F.lit("")) != "").groupBy("raster_id", "class_name").agg(F.min("seq").alias("item_seq"))
    have = best.join(known, ["raster_id", "class_name"])
    rest = best.join(known, ["raster_id", "class_name"], "left_anti")
    free = items.filter(F.coalesce("class_name", F.lit("")) == "").select("raster_id", F.col("seq").alias("item_seq"), *[F.col(c).alias("i" + c) for c in ("x0", "y0", "x1", "y1")])

    def size(a: str, b: str) -> Column:
        return F.col(b) - F.col(a)

    side = F.greatest(F.least(size("x0", "x1"), size("y0", "y1"), size("ix0", "ix1"), size("iy0", "iy1")), F.lit(1.0))
    far = F.hypot((F.col("x0") + F.col("x1") - F.col("ix0") - F.col("ix1")) / 2, (F.col("y0") + F.col("y1") - F.col("iy0") - F.col("iy1")) / 2) / side
    near = rest.join(free, "raster_id").withColumn("far", far).filter("far < 1").select("raster_id", "turn", "far", "item_seq", "class_name")

    def choose(g: dict[str, np.ndarray]) -> list[int]:
        taken, done, keep = set(), set(), []
        for n, (t, i) in enumerate(zip(g["turn"].tolist(), g["item_seq"].tolist(), strict=True)):
            if t not in done and i not in taken:
                done.add(t)
                taken.add(i)
                keep.append(n)
        return keep

    claimed = chosen(near, ["raster_id"], ["turn", "far", "item_seq"], choose)
    new = rest.join(claimed, ["raster_id", "class_name"], "left_anti")
    out = have.select("raster_id", "class_name", "item_seq", F.lit("known").alias("how"))
    out = out.unionByName(claimed.select("raster_id", "class_name", "item_seq", F.lit("claimed").alias("how")))
    return out.unionByName(new.select("raster_id", "class_name", F.lit(None).cast("long").alias("item_seq"), F.lit("new").alias("how")))


def inferred(coords: DataFrame, rois: DataFrame) -> DataFrame:
    """Keypoints that the other axis' scale gives: for maps with two distinct degrees on one axis and
    one on the other. coords(raster_id, axis, seq, x, y, degree), rois(raster_id, x0, y0, x1, y1,
    lon_sign, lat_sign); the new point lies at the far side of the region, a pixel aside."""
    along = F.when(F.col("axis") == "lat", F.col("y")).otherwise(F.col("x"))
    keyed = coords.withColumn("px", along)
    slope = K.extremes(keyed).withColumnRenamed("axis", "axis_of")
    n = K.distinct_degrees(keyed).groupBy("raster_id").pivot("axis", ["lat", "lon"]).agg(F.first("n")).filter("(lat >= 2 and lon = 1) or (lon >= 2 and lat = 1)")
    n = n.select("raster_id", F.when(F.col("lat") >= 2, "lat").otherwise("lon").alias("from_axis"))
    firsts = coords.groupBy("raster_id", "axis").agg(F.min_by(F.struct("x", "y", "degree"), "seq").alias("p"))
    lone = n.join(firsts, "raster_id").filter(F.col("axis") != F.col("from_axis"))
    top = keyed.groupBy("raster_id", "axis").agg(F.max_by("degree", F.struct(F.col("px"), -F.col("seq"))).alias("top")).withColumnRenamed("axis", "top_axis")
    rows = lone.join(slope, "raster_id").filter(F.col("axis_of") == F.col("from_axis")).join(top, "raster_id").filter(F.col("top_axis") == F.col("from_axis")).join(rois, "raster_id")
    lat = F.when(F.col("from_axis") == "lat", F.col("top")).otherwise(F.col("p.degree"))
    per = geodesy.degrees_per_km(lat, F.when(F.col("from_axis") == "lat", F.col("p.degree")).otherwise(F.col("top")))
    rows = rows.withColumn("per", per).filter("per_pixel is not null and per_pixel <> 0")
    km = F.abs(F.col("per_pixel")) / F.when(F.col("from_axis") == "lat", F.col("per.lat")).otherwise(F.col("per.lon"))
    is_lon = F.col("axis") == "lon"
    px, py = F.col("p.x"), F.col("p.y")
    x = F.when(is_lon, F.when(px > (F.col("x0") + F.col("x1")) / 2, F.col("x0")).otherwise(F.col("x1"))).otherwise(F.greatest(px - 1, F.lit(0)))
    y = F.when(is_lon, F.greatest(py - 1, F.lit(0))).otherwise(F.when(py > (F.col("y0") + F.col("y1")) / 2, F.col("y0")).otherwise(F.col("y1")))
    degree = F.when(is_lon, F.col("lon_sign") * km * F.col("per.lon") * (x - px)).otherwise(F.col("lat_sign") * km * F.col("per.lat") * (y - py)) + F.col("p.degree")
    return rows.select("raster_id", "axis", x.cast("double").alias("x"), y.cast("double").alias("y"), degree.alias("degree"), F.lit(0.5).alias("confidence"))


def text_lines(words: DataFrame) -> DataFrame:
    """(doc_id, idx, text, x0, y0, x1, y1): words(doc_id, seq, text, x0 ... y1), whose word 0 is the
    whole text with line breaks, as lines with the box of their words. A word ends a line that it
    completes; one that doesn't occur in the line but begins the next starts that."""

    def lines(full: str, own: list[tuple]) -> list[tuple]:
        out, at, parts = [], 0, full.split("\n")
        for n, line in enumerate(parts):
            left, after, box = line.strip(), parts[n + 1] if n + 1 < len(parts) else "", None
            while at < len(own):
                word, *b = own[at]
                rest = left.replace(word, "", 1).strip() if word else left
                if rest and word and len(rest) == len(left) and after.startswith(word):
                    break
                box = b if box is None else [min(box[0], b[0]), min(box[1], b[1]), max(box[2], b[2]), max(box[3], b[3])]
                at, left = at + 1, rest
                if not rest:
                    break
            if box is not None:
                out.append((n, line.strip(), *box))
        return out

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, ws in zip(b["doc_id"], b["words"], strict=True):
                if len(ws) > 1:
                    own = [(w["text"].strip(), w["x0"], w["y0"], w["x1"], w["y1"]) for w in ws[1:]]
                    out += [(doc, *r) for r in lines(ws[0]["text"], own)]
            yield pd.DataFrame(out, columns=["doc_id", "idx", "text", "x0", "y0", "x1", "y1"])

    # A page's words are one value: a page is the unit of recognition.
    pages = words.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text", "x0", "y0", "x1", "y1"))).alias("words"))
    return pages.mapInPandas(work, "doc_id long, idx int, text string, x0 long, y0 long, x1 long, y1 long")
