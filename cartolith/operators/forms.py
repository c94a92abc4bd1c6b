"""Operators on form tokens and table cells."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .points import one_to_one
from .runs import chosen


def bio_tags(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """tokens(.., pos, label) with a tag: O for other, B- for a run's first word, I- for the rest."""
    name = F.upper("label")
    tag = F.when(F.col("label") == "other", "O").when(F.col("pos") == 0, F.concat(F.lit("B-"), name)).otherwise(F.concat(F.lit("I-"), name))
    return tokens.withColumn("tag", tag)


def segment_ids(tokens: DataFrame, keys: list[str], order: str) -> DataFrame:
    """tokens with `segment`, which grows when the box changes, and `position`, from 2 within one."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = F.coalesce((F.col("box") != F.lag("box").over(w)).cast("int"), F.lit(0))
    rows = tokens.withColumn("__n", new).withColumn("segment", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*keys, "segment").orderBy(order)) + 1).drop("__n")


def line_boxes(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """tokens with the box of their whole line."""
    w = Window.partitionBy(*keys)
    ends = [f("box." + c).over(w) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]
    return tokens.withColumn("line_box", G.box(*ends))


def windows_of(tokens: DataFrame, keys: list[str], order: str, size: int = 510) -> DataFrame:
    """tokens with the number of the window of `size` tokens that they fall into, and their place."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return tokens.withColumn("__n", n).withColumn("window", F.floor(F.col("__n") / size).cast("int")).withColumn("place", (F.col("__n") % size).cast("int")).drop("__n")


def grid(cells: DataFrame) -> DataFrame:
    """cells(table_id, cell, r0, r1, c0, c1, text) with a row for each place that they span."""
    rows = cells.select("*", F.explode(F.sequence("r0", "r1")).alias("r"))
    return rows.select("*", F.explode(F.sequence("c0", "c1")).alias("c"))


def adjacent(cells: DataFrame) -> DataFrame:
    """(table_id, a, b, direction): texts of cells that follow each other in a row or column, blank
    cells passed over, each relation once."""
    places = grid(cells.filter(F.trim("text") != "")).select("table_id", "cell", "text", "r", "c")

    def following(line: str, along: str, name: str) -> DataFrame:
        w = Window.partitionBy("table_id", line).orderBy(along)
        rows = places.withColumn("b", F.lead("text").over(w)).withColumn("__next", F.lead("cell").over(w))
        rows = rows.filter(F.col("__next").isNotNull() & (F.col("__next") != F.col("cell")))
        return rows.select("table_id", F.col("cell").alias("a_cell"), F.col("__next").alias("b_cell"), F.col("text").alias("a"), "b", F.lit(name).alias("direction")).distinct()

    return following("r", "c", "horizontal").unionByName(following("c", "r", "vertical"))


def first_overlap(left: DataFrame, right: DataFrame, key: str, least: float) -> DataFrame:
    """(key, seq, r_seq): for each left box the first right one with enough overlap; right boxes
    can serve again."""
    r = right.select(F.col(key).alias("__k"), F.col("seq").alias("r_seq"), F.col("box").alias("r_box"))
    met = left.join(r, left[key] == F.col("__k")).filter(G.overlap(F.col("box"), F.col("r_box")) & (G.iou(F.col("box"), F.col("r_box")) >= least))
    return met.groupBy(key, "seq").agg(F.min("r_seq").alias("r_seq"))


def greedy_overlap(left: DataFrame, right: DataFrame, key: str, least: float) -> DataFrame:
    """(key, seq, r_seq): one to one, each left box in order takes the first right box left."""
    r = right.select(F.col(key).alias("__k"), F.col("seq").alias("r_seq"), F.col("box").alias("r_box"))
    met = left.join(r, left[key] == F.col("__k")).filter(G.overlap(F.col("box"), F.col("r_box")) & (G.iou(F.col("box"), F.col("r_box")) >= least)).select(F.col(key), "seq", "r_seq")

    return chosen(met, [key], ["seq", "r_seq"], one_to_one("seq", "r_seq"))


def harmonic(hits: Column, n_true: Column, n_found: Column) -> Column:
    """F1 from counts; 0 where nothing is true or found."""
    return F.when(n_true + n_found > 0, 2 * hits / (n_true + n_found)).otherwise(F.lit(0.0))


def structure_match(true: DataFrame, found: DataFrame, cells: DataFrame) -> DataFrame:
    """(table_id, correct, n_true, n_found) for each true table: relations between neighbouring
    cells, and how many of the found ones are true ones, carried over by cells(table_id, cell,
    found_cell). All relations of cells without a counterpart count as missed."""
    key = ["table_id", "a_cell", "b_cell", "direction"]
    mine, theirs = (adjacent(t).select(*key).distinct() for t in (true, found))
    to = lambda end: cells.select("table_id", F.col("cell").alias(f"{end}_cell"), F.col("found_cell").alias(f"__{end}"))
    carried = mine.join(to("a"), ["table_id", "a_cell"]).join(to("b"), ["table_id", "b_cell"]).select("table_id", F.col("__a").alias("a_cell"), F.col("__b").alias("b_cell"), "direction")
    parts = [true.select("table_id").distinct()]
    for rows, name in ((theirs.join(carried, key, "left_semi"), "correct"), (mine, "n_true"), (theirs, "n_found")):
        parts.append(rows.groupBy("table_id").agg(F.count("*").alias(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "table_id", "left")
    return out.na.fill(0)
