"""Operators on image tiles, detected symbols and legend items."""

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .runs import chosen


def splits(size: Column, limit: int) -> Column:
    """Even parts (from, to) of 0 ... size, none longer than `limit`."""
    n = F.ceil(size / limit)
    step = F.ceil(size / n).cast("int")
    return F.transform(F.sequence(F.lit(0), size.cast("int") - 1, step), lambda a: F.struct(a.alias("a"), F.least(a + step, size.cast("int")).alias("b")))


def tile_grid(images: DataFrame, limit: int) -> DataFrame:
    """images(raster_id, w, h) as tiles without overlap, rows first: n, x0, y0, x1, y1."""
    rows = images.select("*", F.posexplode(splits(F.col("h"), limit)).alias("__j", "__y"))
    rows = rows.select("*", F.posexplode(splits(F.col("w"), limit)).alias("__i", "__x"))
    across = F.ceil(F.col("w") / limit).cast("int")
    return rows.select("raster_id", (F.col("__j") * across + F.col("__i")).alias("n"), F.col("__x.a").alias("x0"), F.col("__y.a").alias("y0"), F.col("__x.b").alias("x1"), F.col("__y.b").alias("y1"))


def overlapped_tiles(rois: DataFrame, size: int = 1024, overlap: int = 99) -> DataFrame:
    """rois(raster_id, x0, y0, x1, y1) as tiles of a fixed size that overlap: x_offset, y_offset."""
    step = size - overlap
    rows = rois.select("raster_id", F.explode(F.sequence(F.col("y0"), F.col("y1") - 1, F.lit(step))).alias("y_offset"), "x0", "x1")
    rows = rows.select("raster_id", "y_offset", F.explode(F.sequence(F.col("x0"), F.col("x1") - 1, F.lit(step))).alias("x_offset"))
    return rows.withColumn("width", F.lit(size)).withColumn("height", F.lit(size))


def resize_ratio(w: Column, h: Column, limit: int) -> Column:
    """What to scale an image by so that its longer side keeps the limit; never above 1."""
    return F.when(F.greatest(w, h) > limit, F.lit(limit) / F.greatest(w, h)).otherwise(F.lit(1.0))


def tile_edge_flags(shape: int = 2, sure: float = 0.5, overlap: int = 99) -> tuple[Column, Column]:
    """(redundant, in overlap) of a symbol x1 ... y2 in a tile at x_offset, y_offset, in a region
    rx0 ... ry1: one that isn't square at a tile's edge is a cut one, unless it lies at the border
    of the region and is sure."""
    x1, y1, x2, y2, ox, oy = (F.col(c) for c in ("x1", "y1", "x2", "y2", "x_offset", "y_offset"))
    xc, yc = (x1 + x2) / 2, (y1 + y2) / 2
    shared = (xc < overlap) | (xc > F.col("width") - overlap) | (yc < overlap) | (yc > F.col("height") - overlap)
    cut = (F.abs((x2 - x1) - (y2 - y1)) > shape) & ((x1 <= 1) | (y1 <= 1) | (x2 >= F.col("width") - 1) | (y2 >= F.col("height") - 1))
    within = (x1 + ox > F.col("rx0")) & (x2 + ox < F.col("rx1")) & (y1 + oy > F.col("ry0")) & (y2 + oy < F.col("ry1"))
    return cut & (within | (F.col("score") < sure)), shared


def merged_tiles(symbols: DataFrame) -> DataFrame:
    """Symbols of tiles in map coordinates: cut ones left out; of those in overlaps, one for each
    class and cell of two pixels, the last."""
    redundant, shared = tile_edge_flags()
    rows = symbols.withColumn("__s", shared).filter(~redundant)
    for c, o in (("x1", "x_offset"), ("x2", "x_offset"), ("y1", "y_offset"), ("y2", "y_offset")):
        rows = rows.withColumn(c, F.col(c) + F.col(o))
    cell = [F.floor((F.col(a) + F.col(b)) / 2 / 2).alias(n) for a, b, n in (("x1", "x2", "__cx"), ("y1", "y2", "__cy"))]
    cols = ["raster_id", "class_name", "seq", "x1", "y1", "x2", "y2", "score"]
    alone = rows.filter(~F.col("__s")).select(*cols)
    dup = rows.filter("__s").select(*cols, *cell).groupBy("raster_id", "class_name", "__cx", "__cy").agg(F.max_by(F.struct(*cols[2:]), "seq").alias("__r"))
    return alone.unionByName(dup.select("raster_id", "class_name", "__r.*"))


def suppressed(matches: DataFrame, distance: float, most: int = 250) -> DataFrame:
    """Best matches first, without those nearer than `distance` to a chosen one, `most` at most:
    matches(raster_id, class_name, seq, x, y, score)."""

    def choose(g: dict[str, np.ndarray]) -> list[int]:
        x, y, kept = g["x"], g["y"], []
        for n in range(len(x)):
            if len(kept) >= most:
                break
            if all((x[k] - x[n]) ** 2 + (y[k] - y[n]) ** 2 >= distance * distance for k in kept):
                kept.append(n)
        return kept

    rows = matches.select("raster_id", "class_name", "seq", "x", "y", "score")
    return chosen(rows, ["raster_id", "class_name"], [F.col("score").desc(), "seq"], choose)


def one_to_one(a: str, b: str):
    """A choice of pairs in order in which each left and right row serves once."""

    def choose(g: dict[str, np.ndarray]) -> list[int]:
        left, right, keep = set(), set(), []
        for n, (p, q) in enumerate(zip(g[a].tolist(), g[b].tolist(), strict=True)):
            if p not in left and q not in right:
                left.add(p)
                right.add(q)
                keep.append(n)
        return keep

    return choose


def matched_points(truth: DataFrame, found: DataFrame, reach: float, size: int = 256) -> DataFrame:
    """(map_id, true_seq, seq, distance): pairs one to one, nearest first, within `reach`. Candidates
    come from an equi-join on cells; only a map's candidate pairs meet in one task."""

    def cells(df: DataFrame, spread: int) -> DataFrame:
        near = F.sequence(F.lit(-spread), F.lit(spread))
        cx, cy = F.floor(F.col("x") / size), F.floor(F.col("y") / size)
        grid = F.flatten(F.transform(near, lambda i: F.transform(near, lambda j: F.struct((cx + i).alias("cx"), (cy + j).alias("cy")))))
        return df.withColumn("__c", F.explode(grid) if spread else F.struct(cx.alias("cx"), cy.alias("cy")))

    spread = int(np.ceil(reach / size))
    a = cells(truth.select("map_id", F.col("seq").alias("true_seq"), "x", "y"), spread)
    b = cells(found.select(F.col("map_id").alias("r_map"), "seq", "x", "y"), 0).withColumnRenamed("x", "rx").withColumnRenamed("y", "ry").withColumnRenamed("__c", "__d")
    both = a.join(b, (F.col("map_id") == F.col("r_map")) & (F.col("__c") == F.col("__d")))
    pairs = both.withColumn("distance", F.hypot(F.col("x") - F.col("rx"), F.col("y") - F.col("ry"))).filter(F.col("distance") <= reach).select("map_id", "true_seq", "seq", "distance")

    return chosen(pairs, ["map_id"], ["distance", "true_seq", "seq"], one_to_one("true_seq", "seq"))


def legend_precedence(annotations: DataFrame, systems: list[str], hand: str = "labelme") -> DataFrame:
    """Validated annotations of the listed systems; those of the hand-made system only where a
    raster has no point item from another."""
    rows = annotations.filter(F.col("system").isin(systems) & F.col("validated"))
    rows = rows.filter((F.col("system") == hand) | (F.col("category") == "point"))
    other = F.max((F.col("system") != hand).cast("int")).over(Window.partitionBy("raster_id"))
    return rows.withColumn("__o", other).filter((F.col("__o") == 0) | (F.col("system") != hand)).drop("__o")


def without_text_twins(items: DataFrame, hand: str = "labelme") -> DataFrame:
    """Hand-made annotations come in pairs of one label, swatch and text: the first of a run stays."""
    before = F.lag("label").over(Window.partitionBy("raster_id").orderBy("seq"))
    return items.withColumn("__b", before).filter((F.col("system") != hand) | ~F.col("label").eqNullSafe(F.col("__b"))).drop("__b")


def swatches_in_legend(items: DataFrame, legends: DataFrame, width: int = 120, shape: float = 2.0) -> DataFrame:
    """Swatches whose middle lies in a legend region, of known class or nearly square; a swatch in
    two regions comes twice."""
    met = items.join(legends.select("raster_id", F.col("box").alias("l_box")), "raster_id")
    c = G.centre(F.col("box"))
    inside = c["x"].between(F.col("l_box.x0"), F.col("l_box.x1")) & c["y"].between(F.col("l_box.y0"), F.col("l_box.y1"))
    w, h = F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0")
    return met.filter(inside & ((F.coalesce("class_name", F.lit("")) != "") | ((w < width) & (w < shape * h)))).drop("l_box")


def uses_ontology(items: DataFrame) -> DataFrame:
    return items.groupBy("raster_id").agg(F.bool_and(F.coalesce("class_name", F.lit("")) != "").alias("all_known"))


def still_missing(items: DataFrame, found: DataFrame, least: int = 1) -> DataFrame:
    """Legend items of whose class fewer than `least` symbols were found."""
    n = found.groupBy("raster_id", "class_name").agg(F.count("*").alias("__n"))
    return items.join(n, ["raster_id", "class_name"], "left").filter(F.coalesce("__n", F.lit(0)) < least).drop("__n")


def valid_template(box: Column, contour: Column) -> Column:
    """A swatch that can serve as a template: a contour, and a box of some size."""
    return (F.size(contour) > 0) & (box["x1"] > box["x0"]) & (box["y1"] > box["y0"])


def match_box(x: Column, y: Column, w: Column, h: Column, size: int = 90) -> Column:
    """A box of a fixed size around the middle of a match."""
    cx, cy = (x + w / 2).cast("int"), (y + h / 2).cast("int")
    return G.box(cx - size // 2, cy - size // 2, cx + size // 2, cy + size // 2)


def features(items: DataFrame, symbols: DataFrame) -> DataFrame:
    """(raster_id, name, n_points, has_legend) for every legend name or symbol class."""
    left = items.select("raster_id", F.col("class_name").alias("name"), F.lit(True).alias("__l")).distinct()
    right = symbols.groupBy("raster_id", F.col("class_name").alias("name")).agg(F.count("*").alias("n_points"))
    return left.join(right, ["raster_id", "name"], "full").select("raster_id", "name", F.coalesce("n_points", F.lit(0)).alias("n_points"), F.coalesce("__l", F.lit(False)).alias("has_legend"))


def point_cells(symbols: DataFrame) -> DataFrame:
    """The distinct middles of each class, as (x, y) pairs in order: a sparse bit mask."""
    mid = F.struct(F.floor((F.col("x1") + F.col("x2")) / 2).cast("int").alias("x"), F.floor((F.col("y1") + F.col("y2")) / 2).cast("int").alias("y"))
    return symbols.groupBy("raster_id", "class_name").agg(F.array_sort(F.collect_set(mid)).alias("cells"))
