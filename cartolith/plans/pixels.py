"""Queries on pixels made of embeddings, legend swatches, inferred keypoints and text lines."""

import numpy as np
from pyspark.sql import functions as F

from ..operators import legend as L
from ..operators import raster as R
from ..sources.derived import derived
from .catalog import query

#: A cross of dark pixels.
CROSS = np.array([[255, 0, 255], [0, 0, 0], [255, 0, 255]], np.uint8)


def images(spark, sf_dir):
    """Embeddings as grey images of 8 by 8."""
    rows = derived(spark, sf_dir, "SELECT vec_id AS id, embedding FROM embeddings")
    level = F.transform("embedding", lambda x: F.lpad(F.hex(F.least(F.greatest(F.floor((x + 0.5) * 256), F.lit(0)), F.lit(255))), 2, "0"))
    return rows.select("id", F.lit(8).alias("w"), F.lit(8).alias("h"), F.unhex(F.array_join(level, "")).alias("pixels"))


@query("r16_template_matches")
def template_matches(spark, sf_dir):
    return R.template_matches(images(spark, sf_dir), CROSS, 0.6).select("id", "rotation", "x", "y", F.round("score", 6).alias("score"))


@query("r21_best_turns")
def best_turns(spark, sf_dir):
    return R.best_turns(R.template_matches(images(spark, sf_dir), CROSS, 0.5)).select("id", "x", "y", "rotation", F.round("score", 6).alias("score"))


@query("r14_cleaned_templates")
def cleaned_templates(spark, sf_dir):
    return R.cleaned_templates(images(spark, sf_dir))


@query("r10_region_masks", "SELECT s_suppkey AS id, (least(s_suppkey % 20 + 11, 49) - greatest(s_suppkey % 20 - 1, 0) + 1) * (least(s_suppkey % 15 + 9, 39) - greatest(s_suppkey % 15 - 1, 0) + 1) AS n FROM supplier")
def region_masks(spark, sf_dir):
    """The number of pixels of each mask."""
    rows = derived(spark, sf_dir, "SELECT s_suppkey AS id, CAST(s_suppkey % 20 AS INT) AS x0, CAST(s_suppkey % 15 AS INT) AS y0 FROM supplier")
    boxes = F.array(F.struct("x0", "y0", (F.col("x0") + 10).alias("x1"), (F.col("y0") + 8).alias("y1")))
    masks = R.region_masks(rows.select("id", F.lit(50).alias("w"), F.lit(40).alias("h"), boxes.alias("boxes")))
    return masks.select("id", F.length(F.replace(F.hex("pixels"), F.lit("00"), F.lit(""))).alias("n")).select("id", (F.col("n") / 2).cast("long").alias("n"))


@query("r12_colour_range", "SELECT p_partkey AS id, greatest(p_partkey % 256 - 25, 0) AS low, least(p_partkey % 256 + 25, 255) AS high FROM part")
def colour_range(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT p_partkey AS id, p_partkey % 256 AS v FROM part")
    return rows.select("id", R.colour_range(F.col("v"), 25).alias("r")).select("id", "r.low", "r.high")


SWATCHES = "SELECT p_size AS raster_id, p_partkey AS seq, p_type AS class_name, CAST(p_partkey % 97 AS DOUBLE) / 97 AS score, CAST(p_partkey * 7 % 400 AS DOUBLE) AS x0, CAST(p_partkey * 3 % 300 AS DOUBLE) AS y0, CAST(p_partkey * 7 % 400 + 60 AS DOUBLE) AS x1, CAST(p_partkey * 3 % 300 + 50 AS DOUBLE) AS y1 FROM part"
ITEMS = "SELECT p_size AS raster_id, p_partkey AS seq, CASE WHEN p_partkey % 10 = 0 THEN p_type ELSE '' END AS class_name, CAST(p_partkey * 11 % 400 AS DOUBLE) AS x0, CAST(p_partkey * 5 % 300 AS DOUBLE) AS y0, CAST(p_partkey * 11 % 400 + 55 AS DOUBLE) AS x1, CAST(p_partkey * 5 % 300 + 45 AS DOUBLE) AS y1 FROM part WHERE p_partkey % 2 = 0"


@query("j8_joined_swatches")
def joined_swatches(spark, sf_dir):
    return L.joined_swatches(derived(spark, sf_dir, SWATCHES), derived(spark, sf_dir, ITEMS))


@query("m22_inferred_keypoints")
def inferred_keypoints(spark, sf_dir):
    from .coordinates import COORDS

    coords = derived(spark, sf_dir, COORDS).select("raster_id", "axis", "seq", F.col("px").alias("x"), F.col("py").alias("y"), "degree")
    rois = coords.select("raster_id").distinct().select("raster_id", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(300.0).alias("x1"), F.lit(15.0).alias("y1"), F.lit(-1).alias("lon_sign"), F.lit(-1).alias("lat_sign"))
    return L.inferred(coords, rois).select("raster_id", "axis", "x", "y", F.round("degree", 5).alias("degree"), "confidence")


@query("t18_text_lines", r"""WITH d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx FROM documents)
SELECT doc_id, CAST(idx AS INT) AS idx, trim(line) AS text FROM d WHERE regexp_matches(line, '[^ ]')""")
def text_lines(spark, sf_dir):
    """Lines of documents from their words: the words' boxes give each line's."""
    docs = derived(spark, sf_dir, "SELECT doc_id, text FROM documents")
    whole = docs.select("doc_id", F.lit(0).alias("seq"), "text")
    words = docs.select("doc_id", F.posexplode(F.filter(F.split("text", r"[ \n]"), lambda w: w != "")).alias("seq", "text")).withColumn("seq", F.col("seq") + 1)
    at = [(F.col("seq") * k).cast("long").alias(c) for k, c in ((10, "x0"), (1, "y0"), (11, "x1"), (2, "y1"))]
    return L.text_lines(whole.unionByName(words).select("doc_id", "seq", "text", *at)).select("doc_id", "idx", "text")
