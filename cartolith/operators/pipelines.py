"""Whole pipelines as graphs of tables: recognisers' results in, outputs by name out."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import compose as M
from . import extractors as X
from . import lookups as U
from . import places as P
from . import plugins as R
from . import points as S
from . import segments as G

Tables = dict[str, DataFrame]


def outputs(tables: Tables, creators: dict[str, Callable[[Tables], DataFrame]]) -> Tables:
    """The pipeline's outputs by name: each creator sees all tables and gives one."""
    return {name: create(tables) for name, create in creators.items()}


def segmentation(documents: DataFrame, found: DataFrame, limit: float = 0.75) -> Tables:
    """Regions that are sure enough, of documents that have a map; the others, with the reason why
    they stop; and a record for each region."""
    kept = G.denoised(found, limit)
    stopped = M.halted(documents, {"no map": G.without_map(documents, kept)}).filter("halt_reason is not null")
    regions = kept.join(stopped.select("doc_id"), "doc_id", "left_anti")
    return outputs({"regions": regions, "stopped": stopped}, {"regions": lambda t: t["regions"], "stopped": lambda t: t["stopped"], "records": lambda t: X.output_of(t["regions"], "segmentation", "doc_id")})


def text(tiles: DataFrame) -> Tables:
    """Words of overlapping tiles as lines of their images: tiles(doc_id, tile, seq, text, x0 ... y1,
    x_offset, y_offset). A word that two tiles read at one place counts once, the first tile's."""
    moved = tiles
    for c in ("x0", "x1"):
        moved = moved.withColumn(c, F.col(c) + F.col("x_offset"))
    for c in ("y0", "y1"):
        moved = moved.withColumn(c, F.col(c) + F.col("y_offset"))
    at = [F.floor((F.col(a) + F.col(b)) / 2 / 4) for a, b in (("x0", "x1"), ("y0", "y1"))]
    first = moved.groupBy("doc_id", "text", at[0].alias("__x"), at[1].alias("__y")).agg(F.min(F.struct("tile", "seq", "x0", "y0", "x1", "y1")).alias("w"))
    words = first.select("doc_id", "text", "w.*")
    return {"words": words, "records": X.output_of(words, "text", "doc_id")}


def metadata(texts: DataFrame, regions: DataFrame, classes: list[str], load: Callable, schema: str) -> Tables:
    """Fields of each map from its texts outside the listed regions, by an extractor that sees a
    document's texts in order; and their records."""
    left = G.text_filter(texts, regions, classes)
    whole = left.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda t: t["text"]), "\n").alias("text"))
    fields = R.extracted(whole, load, schema)
    return {"texts": left, "fields": fields, "records": X.output_of(fields, "metadata", "doc_id")}


def points(symbols: DataFrame, items: DataFrame) -> Tables:
    """Symbols of all tiles in map coordinates, with the legend's names; counts by class; records."""
    merged = S.merged_tiles(symbols)
    counts = merged.groupBy("raster_id", "class_name").agg(F.count("*").alias("n"))
    named = merged.join(items.select("raster_id", "class_name", "label").dropDuplicates(["raster_id", "class_name"]), ["raster_id", "class_name"], "left")
    cells = S.point_cells(merged)
    return {"labels": named, "counts": counts, "masks": cells, "records": X.output_of(counts, "points")}


def legend_items(annotations: DataFrame, legends: DataFrame, systems: list[str]) -> DataFrame:
    """Annotations as legend items: those of the systems that count, without twins, in a legend
    region; repeated labels numbered."""
    chosen = S.without_text_twins(S.legend_precedence(annotations, systems))
    return U.suffixed(S.swatches_in_legend(chosen, legends), "raster_id", "label")


def geocoder(places: DataFrame, coords: DataFrame, old: DataFrame, look_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The known places of maps, and for maps with too few keypoints those that a look-up finds now:
    new results take the place of old ones."""
    from . import keypoints as K

    todo = places.join(K.needing_more(coords).withColumnRenamed("raster_id", "map_id"), "map_id", "left_semi")
    return U.upserted(old, look_up(todo), ["map_id", "place"], "seq")


def point_geocoder(places: DataFrame, fences: DataFrame, coords: DataFrame) -> DataFrame:
    """Keypoints from places: candidates in the fence, nearest to the map's common middle, one pair
    a place and a pixel, as many of the surest as the map still needs."""
    from . import keypoints as K

    near = P.fenced(places, fences).drop("rank")
    ranked = P.by_common_centre(near)
    first = ranked.withColumn("seq", F.col("rank"))
    pairs = P.coordinates(first).withColumnRenamed("map_id", "raster_id")
    return K.confidence_cut(pairs, K.keypoint_count(coords))
