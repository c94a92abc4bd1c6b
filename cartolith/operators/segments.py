"""Operators on text boxes and classified regions of a map."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G


def deduplicated(ocr: DataFrame, key: str = "doc_id", text: str = "text", order: str = "idx") -> DataFrame:
    """One row a text: the place of its first occurrence, the values of its last."""
    rest = [c for c in ocr.columns if c not in (key, text, order)]
    # An aggregate for each column, so that those which nobody reads cost nothing.
    return ocr.groupBy(key, text).agg(F.min(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest], F.max(order).alias("last_" + order))


def text_filter(ocr: DataFrame, segments: DataFrame, classes: list[str], threshold: int = 0, include: bool = False) -> DataFrame:
    """Text kept by region classes: ocr(doc_id, idx, text, box), segments(doc_id, class_label, box).

    Excluding keeps a text if for some class of its document it isn't inside a region of it, or
    that class holds fewer than `threshold` texts; including keeps it if it meets a region. Only
    listed classes are tested, but every present class counts as one; without regions nothing
    stays. The join is by document and, beyond that, on the boxes: no pair leaves its document.
    """
    labels = segments.groupBy("doc_id").agg(F.count_distinct("class_label").alias("__labels"))
    tested = segments.filter(F.col("class_label").isin(classes)).select("doc_id", "class_label", F.col("box").alias("seg_box"))
    inside, meets = G.inside(F.col("box"), F.col("seg_box")), G.overlap(F.col("box"), F.col("seg_box"))
    met = ocr.select("doc_id", "idx", "box").join(tested, "doc_id").filter(meets)
    hits = met.groupBy("doc_id", "idx", "class_label").agg(F.count_if(inside).alias("n"))
    if include:
        kept = hits.select("doc_id", "idx").distinct()
    else:  # a text goes if every present class holds it, and holds enough
        words = F.sum("n").over(Window.partitionBy("doc_id", "class_label"))
        full = hits.withColumn("__words", words).filter((F.col("n") > 0) & (F.col("__words") >= threshold))
        gone = full.groupBy("doc_id", "idx").agg(F.count("*").alias("__in")).join(labels, "doc_id").filter("__in = __labels")
        kept = ocr.select("doc_id", "idx").join(labels.select("doc_id"), "doc_id", "left_semi").join(gone, ["doc_id", "idx"], "left_anti")
    return deduplicated(ocr.join(kept, ["doc_id", "idx"], "left_semi"))


def ranked(segments: DataFrame, classes: list[str], key: str = "doc_id") -> DataFrame:
    """Regions of the listed classes with their rank in class by confidence * sqrt(area)."""
    worth = F.col("confidence") * F.sqrt("area")
    w = Window.partitionBy(key, "class_label").orderBy(worth.desc(), F.col("seq"))
    place = F.array_position(F.array(*map(F.lit, classes)), F.col("class_label"))
    return segments.filter(F.col("class_label").isin(classes)).withColumn("class_order", place).withColumn("rank", F.row_number().over(w))


def top_regions(segments: DataFrame, label: str, most: int = 0, key: str = "doc_id") -> DataFrame:
    own = ranked(segments.filter(F.col("class_label") == label), [label], key)
    return own.filter(F.col("rank") <= most) if most else own


def denoised(segments: DataFrame, limit: float = 0.75, key: str = "doc_id") -> DataFrame:
    """Regions at least as sure as the first of their class, or as `limit` if that is less."""
    first = F.first("confidence").over(Window.partitionBy(key, "class_label").orderBy("seq"))
    return segments.withColumn("__cut", F.least(F.lit(limit), first)).filter(F.col("confidence") >= F.col("__cut")).drop("__cut")


def without_map(documents: DataFrame, segments: DataFrame, key: str = "doc_id", label: str = "map") -> DataFrame:
    """Documents to halt: no region of the class."""
    return documents.join(segments.filter(F.col("class_label") == label).select(key).distinct(), key, "left_anti")


def text_by_region(ocr: DataFrame, segments: DataFrame, label: str) -> DataFrame:
    """Each region of a class with the texts whose first met region it is, joined in order."""
    own = segments.filter(F.col("class_label") == label).select("doc_id", "seq", F.col("box").alias("seg_box"))
    met = ocr.join(own, "doc_id").filter(G.overlap(F.col("box"), F.col("seg_box")))
    first = met.groupBy("doc_id", "idx").agg(F.min("seq").alias("seq"), F.first("text").alias("text"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda t: t["text"])
    return first.groupBy("doc_id", "seq").agg(F.count("*").alias("n_texts"), F.concat(F.array_join(texts, " "), F.lit(" ")).alias("text"))


def with_cells(rows: DataFrame, box: str, size: int) -> DataFrame:
    """A row for each grid cell (__cx, __cy) that the box covers."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(box)[a] / size).cast("int"), F.floor(F.col(box)[b] / size).cast("int")))
    return rows.withColumn("__cx", span("x0", "x1")).withColumn("__cy", span("y0", "y1"))


def box_join(left: DataFrame, right: DataFrame, key: str, size: int = 256) -> DataFrame:
    """Pairs of rows of a document whose `box`es meet: an equi-join on grid cells, then the exact
    test; a pair is taken in the upper left cell that both cover, so that none comes twice.
    right's columns get the prefix r_."""
    a = with_cells(left, "box", size)
    b = with_cells(right.select(*[F.col(c).alias("r_" + c) for c in right.columns]), "r_box", size)
    x = F.floor(F.greatest(F.col("box.x0"), F.col("r_box.x0")) / size).cast("int")
    y = F.floor(F.greatest(F.col("box.y0"), F.col("r_box.y0")) / size).cast("int")
    both = a.join(b.withColumnsRenamed({"__cx": "__rx", "__cy": "__ry"}), (a[key] == b["r_" + key]) & (F.col("__cx") == F.col("__rx")) & (F.col("__cy") == F.col("__ry")))
    return both.filter((F.col("__cx") == x) & (F.col("__cy") == y) & G.overlap(F.col("box"), F.col("r_box"))).drop("__cx", "__cy", "__rx", "__ry")


def nearest_in_box(points: DataFrame, texts: DataFrame, key: str, value: str) -> DataFrame:
    """For each box of `points` the value of the text that meets it with the nearest centre."""
    met = box_join(points, texts, key)
    a, b = G.centre(F.col("box")), G.centre(F.col("r_box"))
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    far = dx * dx + dy * dy
    return met.groupBy(key, "seq").agg(F.min_by("r_" + value, F.struct(far, F.col("r_idx"), F.col("r_" + value))).alias(value))
