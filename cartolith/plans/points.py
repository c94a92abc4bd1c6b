"""Queries on tiles, symbols, legends, tables and forms."""

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import forms as R
from ..operators import points as P
from ..sources.derived import derived
from .catalog import query

IMAGES = "SELECT p_partkey AS raster_id, p_size * 137 + 300 AS w, p_partkey % 977 + 900 AS h FROM part"
PARTS = "unnest(range(0, CAST({0} AS BIGINT), CAST(ceil({0} / ceil({0} / 600.0)) AS BIGINT)))"


@query("r1_even_splits", f"SELECT raster_id, CAST(a AS INT) AS a, CAST(least(a + step, w) AS INT) AS b FROM (SELECT raster_id, w, CAST(ceil(w / ceil(w / 600.0)) AS BIGINT) AS step, {PARTS.format('w')} AS a FROM ({IMAGES}))")
def even_splits(spark, sf_dir):
    return derived(spark, sf_dir, IMAGES).select("raster_id", F.explode(P.splits(F.col("w"), 600)).alias("s")).select("raster_id", "s.a", "s.b")


@query("r2_tile_grid", f"""WITH i AS ({IMAGES}), x AS (SELECT raster_id, w, CAST(ceil(w / ceil(w / 600.0)) AS BIGINT) AS sx, {PARTS.format('w')} AS x0 FROM i), y AS (SELECT raster_id, h, CAST(ceil(h / ceil(h / 600.0)) AS BIGINT) AS sy, {PARTS.format('h')} AS y0 FROM i)
SELECT raster_id, CAST(y0 // sy * CAST(ceil(w / 600.0) AS BIGINT) + x0 // sx AS INT) AS n, CAST(x0 AS INT) AS x0, CAST(y0 AS INT) AS y0, CAST(least(x0 + sx, w) AS INT) AS x1, CAST(least(y0 + sy, h) AS INT) AS y1 FROM x JOIN y USING (raster_id)""")
def tile_grid(spark, sf_dir):
    return P.tile_grid(derived(spark, sf_dir, IMAGES), 600)


ROIS = "SELECT p_partkey AS raster_id, p_partkey % 50 AS x0, p_partkey % 70 AS y0, p_partkey % 50 + p_size * 100 + 200 AS x1, p_partkey % 70 + 1500 AS y1 FROM part"


@query("r3_overlapped_tiles", f"WITH r AS ({ROIS}) SELECT raster_id, x_offset, y_offset, 1024 AS width, 1024 AS height FROM (SELECT raster_id, unnest(range(x0, x1, 925)) AS x_offset, y0, y1 FROM r), LATERAL (SELECT unnest(range(y0, y1, 925)) AS y_offset)")
def overlapped_tiles(spark, sf_dir):
    return P.overlapped_tiles(derived(spark, sf_dir, ROIS))


@query("r6_resize_ratio", f"SELECT raster_id, CASE WHEN greatest(w, h) > 3000 THEN round(3000.0 / greatest(w, h), 6) ELSE 1.0 END AS ratio FROM ({IMAGES})")
def resize_ratio(spark, sf_dir):
    return derived(spark, sf_dir, IMAGES).select("raster_id", F.round(P.resize_ratio(F.col("w"), F.col("h"), 3000), 6).alias("ratio"))


@query("a12_roi_bounds", f"SELECT raster_id % 100 AS g, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM ({ROIS}) GROUP BY raster_id % 100")
def roi_bounds(spark, sf_dir):
    return derived(spark, sf_dir, ROIS).groupBy((F.col("raster_id") % 100).alias("g")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


TILED = """SELECT l_orderkey AS raster_id, l_linenumber AS seq, CASE min(l_partkey) % 3 WHEN 0 THEN 'dip' WHEN 1 THEN 'mine' ELSE 'quarry' END AS class_name, min(l_partkey) % 1000 AS x1, min(l_suppkey) * 11 % 1000 AS y1,
 min(l_partkey) % 1000 + 20 + min(l_suppkey) % 5 AS x2, min(l_suppkey) * 11 % 1000 + 22 AS y2, CAST(min(l_partkey) % 10 AS DOUBLE) / 10 AS score, l_linenumber % 2 * 925 AS x_offset, l_linenumber % 3 * 925 AS y_offset,
 1024 AS width, 1024 AS height, 10 AS rx0, 10 AS ry0, 1900 AS rx1, 2800 AS ry1 FROM lineitem GROUP BY l_orderkey, l_linenumber"""
FLAGS = f"""WITH t AS ({TILED}), f AS (SELECT *, abs((x2 - x1) - (y2 - y1)) > 2 AND (x1 <= 1 OR y1 <= 1 OR x2 >= 1023 OR y2 >= 1023) AND ((x1 + x_offset > rx0 AND x2 + x_offset < rx1 AND y1 + y_offset > ry0 AND y2 + y_offset < ry1) OR score < 0.5) AS redundant,
 (x1 + x2) / 2.0 < 99 OR (x1 + x2) / 2.0 > 925 OR (y1 + y2) / 2.0 < 99 OR (y1 + y2) / 2.0 > 925 AS shared FROM t)"""


@query("f30_tile_edge_flags", f"{FLAGS} SELECT raster_id, seq, redundant, shared FROM f")
def tile_edge_flags(spark, sf_dir):
    redundant, shared = P.tile_edge_flags()
    return derived(spark, sf_dir, TILED).select("raster_id", "seq", redundant.alias("redundant"), shared.alias("shared"))


@query("r5_merged_tiles", f"""{FLAGS}, g AS (SELECT raster_id, class_name, seq, x1 + x_offset AS x1, y1 + y_offset AS y1, x2 + x_offset AS x2, y2 + y_offset AS y2, shared FROM f WHERE NOT redundant),
d AS (SELECT *, CASE WHEN shared THEN row_number() OVER (PARTITION BY raster_id, class_name, shared, floor((x1 + x2) / 4.0), floor((y1 + y2) / 4.0) ORDER BY seq DESC) ELSE 1 END AS r FROM g)
SELECT raster_id, class_name, seq, x1, y1 FROM d WHERE r = 1""")
def merged_tiles(spark, sf_dir):
    return P.merged_tiles(derived(spark, sf_dir, TILED)).select("raster_id", "class_name", "seq", "x1", "y1")


MATCHES = "SELECT l_orderkey AS raster_id, CASE min(l_partkey) % 2 WHEN 0 THEN 'dip' ELSE 'mine' END AS class_name, CAST(l_linenumber AS BIGINT) AS seq, CAST(min(l_partkey) % 200 AS DOUBLE) AS x, CAST(min(l_suppkey) % 100 AS DOUBLE) AS y, CAST(min(l_partkey) % 89 AS DOUBLE) / 89 AS score FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("k8_suppressed_matches")
def suppressed_matches(spark, sf_dir):
    return P.suppressed(derived(spark, sf_dir, MATCHES), 40.0)


@query("k7_match_candidates", f"SELECT raster_id, seq, CAST(row_number() OVER (PARTITION BY raster_id ORDER BY score DESC, seq) AS INT) AS rank FROM ({MATCHES}) WHERE score >= 0.5")
def match_candidates(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("raster_id").orderBy(F.col("score").desc(), "seq")
    return derived(spark, sf_dir, MATCHES).filter("score >= 0.5").select("raster_id", "seq", F.row_number().over(w).alias("rank"))


@query("k9_best_rotation", "SELECT l_orderkey AS raster_id, arg_max(l_linenumber * 5, l_partkey * 100 - l_linenumber) AS rotation FROM lineitem GROUP BY l_orderkey")
def best_rotation(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT l_orderkey AS raster_id, l_partkey AS score, l_linenumber * 5 AS rotation FROM lineitem")
    return rows.groupBy("raster_id").agg(F.max_by("rotation", F.struct(F.col("score"), -F.col("rotation"))).alias("rotation"))


@query("j22_matched_points")
def matched_points(spark, sf_dir):
    rows = derived(spark, sf_dir, MATCHES).withColumnRenamed("raster_id", "map_id")
    return P.matched_points(rows, rows.withColumn("x", F.col("x") + F.col("seq") % 3).withColumn("y", F.col("y") + 2), 10.0, 64)


@query("a23_point_f1")
def point_f1(spark, sf_dir):
    """F1 of each map and class from the matched points."""
    rows = derived(spark, sf_dir, MATCHES).withColumnRenamed("raster_id", "map_id")
    pairs = P.matched_points(rows, rows.withColumn("x", F.col("x") + F.col("seq") * 4), 10.0, 64)
    hits = pairs.groupBy("map_id").agg(F.count("*").alias("hits"))
    n = rows.groupBy("map_id").agg(F.count("*").alias("n"))
    return n.join(hits, "map_id", "left").select("map_id", F.least(R.harmonic(F.coalesce("hits", F.lit(0)), F.col("n"), F.col("n")), F.lit(1.0)).alias("f1"))


ANNOTATIONS = """SELECT p_size AS raster_id, p_partkey AS seq, CASE WHEN p_size % 3 = 0 THEN 'labelme' WHEN p_partkey % 4 = 0 THEN 'labelme' WHEN p_partkey % 4 = 1 THEN 'other' ELSE 'curated' END AS system, p_partkey % 5 <> 0 AS validated,
 CASE WHEN p_partkey % 7 = 0 THEN 'line' ELSE 'point' END AS category, p_type AS label, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_brand END AS class_name, p_partkey % 300 AS x0, p_partkey % 400 AS y0, p_partkey % 300 + p_partkey % 140 + 5 AS x1, p_partkey % 400 + 50 AS y1 FROM part"""


@query("f35_legend_precedence", f"""WITH a AS (SELECT * FROM ({ANNOTATIONS}) WHERE system IN ('curated', 'labelme') AND validated AND (system = 'labelme' OR category = 'point')), o AS (SELECT *, max(CASE WHEN system <> 'labelme' THEN 1 ELSE 0 END) OVER (PARTITION BY raster_id) AS o FROM a)
SELECT raster_id, seq, system FROM o WHERE o = 0 OR system <> 'labelme'""")
def legend_precedence(spark, sf_dir):
    return P.legend_precedence(derived(spark, sf_dir, ANNOTATIONS), ["curated", "labelme"]).select("raster_id", "seq", "system")


@query("f37_text_twins", f"SELECT raster_id, seq FROM (SELECT *, lag(label) OVER (PARTITION BY raster_id ORDER BY seq) AS b FROM ({ANNOTATIONS})) WHERE system <> 'labelme' OR label IS DISTINCT FROM b")
def text_twins(spark, sf_dir):
    return P.without_text_twins(derived(spark, sf_dir, ANNOTATIONS)).select("raster_id", "seq")



def box():
    return G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias("box")

LEGENDS = "SELECT p_size AS raster_id, min(p_partkey) AS seq, 50 AS x0, 60 AS y0, 200 + p_size AS x1, 300 AS y1 FROM part GROUP BY p_size"


@query("f31_swatches_in_legend", f"WITH a AS ({ANNOTATIONS}), l AS ({LEGENDS}) SELECT a.raster_id, a.seq FROM a JOIN l ON a.raster_id = l.raster_id WHERE (a.x0 + a.x1) / 2.0 BETWEEN l.x0 AND l.x1 AND (a.y0 + a.y1) / 2.0 BETWEEN l.y0 AND l.y1 AND (class_name <> '' OR (a.x1 - a.x0 < 120 AND a.x1 - a.x0 < 2 * (a.y1 - a.y0)))")
def swatches_in_legend(spark, sf_dir):
    items = derived(spark, sf_dir, ANNOTATIONS).select("raster_id", "seq", "class_name", box())
    return P.swatches_in_legend(items, derived(spark, sf_dir, LEGENDS).select("raster_id", box())).select("raster_id", "seq")


@query("f32_uses_ontology", f"SELECT CAST(floor(seq / 4) AS BIGINT) AS raster_id, bool_and(class_name <> '') AS all_known FROM ({ANNOTATIONS}) GROUP BY 1")
def uses_ontology(spark, sf_dir):
    return P.uses_ontology(derived(spark, sf_dir, ANNOTATIONS).withColumn("raster_id", F.floor(F.col("seq") / 4)))


@query("f33_valid_templates", f"SELECT raster_id, seq, seq % 9 > 0 AND x1 > x0 + seq % 20 AS valid FROM ({ANNOTATIONS})")
def valid_templates(spark, sf_dir):
    contour = F.when(F.col("seq") % 9 > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    box = G.box(F.col("x0") + F.col("seq") % 20, F.col("y0"), F.col("x1"), F.col("y1"))
    return derived(spark, sf_dir, ANNOTATIONS).select("raster_id", "seq", P.valid_template(box, contour).alias("valid"))


FOUND = "SELECT l_orderkey % 50 + 1 AS raster_id, 'Brand#' || CAST(l_partkey % 40 AS STRING) AS class_name, l_partkey % 500 AS x1, l_suppkey AS y1, l_partkey % 500 + 40 AS x2, l_suppkey + 40 AS y2 FROM lineitem"


@query("f34_still_missing", f"WITH a AS ({ANNOTATIONS}), f AS (SELECT raster_id, class_name, count(*) AS n FROM ({FOUND}) GROUP BY raster_id, class_name) SELECT a.raster_id, a.seq FROM a LEFT JOIN f ON a.raster_id = f.raster_id AND a.class_name = f.class_name WHERE coalesce(n, 0) < 10")
def still_missing(spark, sf_dir):
    return P.still_missing(derived(spark, sf_dir, ANNOTATIONS), derived(spark, sf_dir, FOUND), 10).select("raster_id", "seq")


@query("j25_point_features", f"WITH a AS (SELECT DISTINCT raster_id, class_name AS name FROM ({ANNOTATIONS})), f AS (SELECT raster_id, class_name AS name, count(*) AS n FROM ({FOUND}) GROUP BY raster_id, class_name) SELECT coalesce(a.raster_id, f.raster_id) AS raster_id, coalesce(a.name, f.name) AS name, coalesce(n, 0) AS n_points, a.name IS NOT NULL AS has_legend FROM a FULL JOIN f ON a.raster_id = f.raster_id AND a.name = f.name")
def point_features(spark, sf_dir):
    return P.features(derived(spark, sf_dir, ANNOTATIONS), derived(spark, sf_dir, FOUND))


@query("a21_point_cells", f"SELECT raster_id, class_name, count(DISTINCT floor((x1 + x2) / 2.0) * 100000 + floor((y1 + y2) / 2.0)) AS n_cells FROM ({FOUND}) GROUP BY raster_id, class_name")
def point_cells(spark, sf_dir):
    return P.point_cells(derived(spark, sf_dir, FOUND)).select("raster_id", "class_name", F.size("cells").cast("long").alias("n_cells"))


@query("r20_match_boxes", f"SELECT raster_id, seq, CAST(trunc(x + 12.5) AS INT) - 45 AS x0, CAST(trunc(y + 7.5) AS INT) + 45 AS y1 FROM ({MATCHES})")
def match_boxes(spark, sf_dir):
    b = P.match_box(F.col("x"), F.col("y"), F.lit(25), F.lit(15))
    return derived(spark, sf_dir, MATCHES).select("raster_id", "seq", b.alias("b")).select("raster_id", "seq", "b.x0", "b.y1")


TURNED = "SELECT c_custkey AS id, c_custkey % 300 AS x0, c_custkey % 200 AS y0, c_custkey % 300 + 40 AS x1, c_custkey % 200 + 60 AS y1, c_custkey % 310 AS ax, c_custkey % 190 AS ay, c_custkey % 310 + 40 AS bx, c_custkey % 190 + 60 AS bz FROM customer"


@query("g12_box_iou", f"SELECT id, round(greatest(least(x1, bx) - greatest(x0, ax), 0) * greatest(least(y1, bz) - greatest(y0, ay), 0) / (40.0 * 60 * 2 - greatest(least(x1, bx) - greatest(x0, ax), 0) * greatest(least(y1, bz) - greatest(y0, ay), 0)), 6) AS iou FROM ({TURNED})")
def box_iou(spark, sf_dir):
    other = G.box(*(F.col(c) for c in ("ax", "ay", "bx", "bz")))
    return derived(spark, sf_dir, TURNED).select("id", box(), other.alias("o")).select("id", F.round(G.iou(F.col("box"), F.col("o")), 6).alias("iou"))


@query("g6_ring_centroid", f"SELECT id, (x0 + x1) / 2.0 AS x, (y0 + y1) / 2.0 AS y FROM ({TURNED})")
def ring_centroid(spark, sf_dir):
    c = G.centroid(G.ring_of(F.col("box")))
    return derived(spark, sf_dir, TURNED).select("id", box()).select("id", c.alias("c")).select("id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


@query("g1_ring_box", f"SELECT id, x0, y0, x1, y1 FROM ({TURNED})")
def ring_box(spark, sf_dir):
    return derived(spark, sf_dir, TURNED).select("id", box()).select("id", G.box_of(G.ring_of(F.col("box"))).alias("b")).select("id", "b.*")


@query("j2_point_in_ring", f"SELECT id, ax BETWEEN x0 AND x1 AND ay BETWEEN y0 AND y1 AS inside FROM ({TURNED})")
def point_in_ring(spark, sf_dir):
    rows = derived(spark, sf_dir, TURNED).select("id", "ax", "ay", box()).withColumn("ring", G.ring_of(F.col("box")))
    return rows.select("id", G.point_in_ring(F.col("ax"), F.col("ay"), F.col("ring")).alias("inside"))


@query("j1_rings_meet", f"SELECT id, x0 <= bx AND x1 >= ax AND y0 <= bz AND y1 >= ay AS meet FROM ({TURNED})")
def rings_meet(spark, sf_dir):
    other = G.ring_of(G.box(*(F.col(c) for c in ("ax", "ay", "bx", "bz"))))
    rows = derived(spark, sf_dir, TURNED).select("id", box(), other.alias("o")).withColumn("ring", G.ring_of(F.col("box")))
    return rows.select("id", G.rings_meet(F.col("ring"), F.col("o")).alias("meet"))


@query("g13_scaled_ring", f"SELECT id, CAST(trunc(x0 * 0.37) AS INT) AS x, CAST(trunc(y1 * 0.37) AS INT) + 7 AS y FROM ({TURNED})")
def scaled_ring(spark, sf_dir):
    ring = G.moved(G.scaled(G.ring_of(F.col("box")), F.lit(0.37)), F.lit(0), F.lit(7))
    rows = derived(spark, sf_dir, TURNED).select("id", box()).select("id", ring.alias("r"))
    return rows.select("id", F.get("r", 3)["x"].alias("x"), F.get("r", 3)["y"].alias("y"))


@query("g9_roi_boxes", f"SELECT id, greatest(x0 - greatest(100, greatest(4000, 100 + id) * 0.04), 0.0)::DOUBLE AS ox0, least(y1 + greatest(100, greatest(4000, 100 + id) * 0.04), 100.0 + id)::DOUBLE AS oy1, (x0 + greatest(100, greatest(4000, 100 + id) * 0.04))::DOUBLE AS ix0 FROM ({TURNED})")
def roi_boxes(spark, sf_dir):
    b = G.roi_boxes(F.col("box"), F.lit(4000), F.col("id") + 100)
    return derived(spark, sf_dir, TURNED).select("id", box()).select("id", b.alias("b")).select("id", F.col("b.outer.x0").cast("double").alias("ox0"), F.col("b.outer.y1").cast("double").alias("oy1"), F.col("b.inner.x0").cast("double").alias("ix0"))


@query("m33_normalised_boxes", f"SELECT id, CAST(trunc(1000 * x0 / 333.0) AS INT) AS x0, CAST(trunc(1000 * y1 / 250.0) AS INT) AS y1, CAST(least(greatest(trunc(1000 * y1 / 250.0), 0), 1000) AS INT) AS clipped FROM ({TURNED})")
def normalised_boxes(spark, sf_dir):
    rows = derived(spark, sf_dir, TURNED).select("id", box())
    plain, cut = (G.normalised(F.col("box"), F.lit(333), F.lit(250), clip) for clip in (False, True))
    return rows.select("id", plain.alias("p"), cut.alias("c")).select("id", "p.x0", "p.y1", F.col("c.y1").alias("clipped"))


WORDS = "SELECT l_orderkey AS page, l_linenumber AS line, min(l_partkey) AS part, CASE min(l_suppkey) % 3 WHEN 0 THEN 'other' WHEN 1 THEN 'question' ELSE 'answer' END AS label, l_linenumber // 2 AS run FROM lineitem GROUP BY l_orderkey, l_linenumber"
WORDS = WORDS.replace("l_linenumber // 2", "CAST(floor(l_linenumber / 2) AS INT)")


@query("s37_bio_tags", f"SELECT page, line, CASE WHEN label = 'other' THEN 'O' WHEN line % 2 = 0 THEN 'B-' || upper(label) ELSE 'I-' || upper(label) END AS tag FROM ({WORDS})")
def bio_tags(spark, sf_dir):
    return R.bio_tags(derived(spark, sf_dir, WORDS).withColumn("pos", F.col("line") % 2), ["page"]).select("page", "line", "tag")


@query("w8_segment_ids", f"""WITH t AS ({WORDS}), n AS (SELECT *, CASE WHEN run <> lag(run) OVER (PARTITION BY page ORDER BY line) THEN 1 ELSE 0 END AS new FROM t), s AS (SELECT *, CAST(sum(new) OVER (PARTITION BY page ORDER BY line ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM n)
SELECT page, line, segment, CAST(row_number() OVER (PARTITION BY page, segment ORDER BY line) + 1 AS INT) AS position FROM s""")
def segment_ids(spark, sf_dir):
    rows = derived(spark, sf_dir, WORDS).withColumn("box", F.struct(F.col("run").alias("x0"), (F.col("run") + 5).alias("x1")))
    return R.segment_ids(rows, ["page"], "line").select("page", "line", "segment", "position")


@query("w10_line_boxes", f"SELECT page, line, min(part) OVER w AS x0, max(part + 9) OVER w AS x1 FROM ({WORDS}) WINDOW w AS (PARTITION BY page, run)")
def line_boxes(spark, sf_dir):
    rows = derived(spark, sf_dir, WORDS).withColumn("box", G.box(F.col("part"), F.lit(0), F.col("part") + 9, F.lit(1)))
    return R.line_boxes(rows, ["page", "run"]).select("page", "line", "line_box.x0", "line_box.x1")


@query("s39_token_windows", f"SELECT page, line, CAST((row_number() OVER w - 1) // 3 AS INT) AS window, CAST((row_number() OVER w - 1) % 3 AS INT) AS place FROM ({WORDS}) WINDOW w AS (PARTITION BY page ORDER BY line)")
def token_windows(spark, sf_dir):
    return R.windows_of(derived(spark, sf_dir, WORDS), ["page"], "line", 3).select("page", "line", "window", "place")


@query("w12_same_segment", f"WITH t AS ({WORDS}) SELECT a.page, a.line AS a, b.line AS b FROM t a JOIN t b ON a.page = b.page AND a.run = b.run")
def same_segment(spark, sf_dir):
    rows = derived(spark, sf_dir, WORDS)
    return rows.select("page", "run", F.col("line").alias("a")).join(rows.select("page", "run", F.col("line").alias("b")), ["page", "run"]).select("page", "a", "b")


CELLS = "SELECT l_orderkey AS table_id, l_linenumber AS cell, CAST(floor(l_linenumber / 3) AS INT) AS r0, CAST(floor(l_linenumber / 3) AS INT) AS r1, l_linenumber % 3 AS c0, CASE WHEN l_linenumber = 7 THEN 2 ELSE l_linenumber % 3 END AS c1, CASE WHEN min(l_partkey) % 5 = 0 THEN ' ' ELSE 't' || CAST(min(l_partkey) AS STRING) END AS text FROM lineitem GROUP BY l_orderkey, l_linenumber"
GRID = f"WITH x AS ({CELLS}), g AS (SELECT *, unnest(range(c0, c1 + 1)) AS c, r0 AS r FROM x)"


@query("w18_cell_grid", f"{GRID} SELECT table_id, cell, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM g")
def cell_grid(spark, sf_dir):
    return R.grid(derived(spark, sf_dir, CELLS)).select("table_id", "cell", "r", "c")


@query("w17_adjacent_cells", f"""{GRID}, n AS (SELECT * FROM g WHERE trim(text) <> ''),
h AS (SELECT table_id, cell, lead(cell) OVER w AS nx, text, lead(text) OVER w AS nt FROM n WINDOW w AS (PARTITION BY table_id, r ORDER BY c)), v AS (SELECT table_id, cell, lead(cell) OVER w AS nx, text, lead(text) OVER w AS nt FROM n WINDOW w AS (PARTITION BY table_id, c ORDER BY r))
SELECT DISTINCT table_id, cell AS a_cell, nx AS b_cell, text AS a, nt AS b, 'horizontal' AS direction FROM h WHERE nx IS NOT NULL AND nx <> cell UNION ALL SELECT DISTINCT table_id, cell, nx, text, nt, 'vertical' FROM v WHERE nx IS NOT NULL AND nx <> cell""")
def adjacent_cells(spark, sf_dir):
    return R.adjacent(derived(spark, sf_dir, CELLS))


RECTS = "SELECT l_orderkey AS page, l_linenumber AS seq, l_linenumber * 20 AS x0, min(l_suppkey) AS y0, l_linenumber * 20 + 60 AS x1, min(l_suppkey) + 50 AS y1 FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("j21_first_overlap", f"""WITH a AS ({RECTS}), b AS (SELECT page, seq, x0 + 5 AS x0, y0 + 4 AS y0, x1 + 5 AS x1, y1 + 4 AS y1 FROM a),
m AS (SELECT a.page, a.seq, b.seq AS r_seq, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS i FROM a JOIN b ON a.page = b.page) SELECT page, seq, min(r_seq) AS r_seq FROM m WHERE i / (6000.0 - i) >= 0.3 GROUP BY page, seq""")
def first_overlap(spark, sf_dir):
    rows = derived(spark, sf_dir, RECTS)
    moved = rows.select("page", "seq", G.box(F.col("x0") + 5, F.col("y0") + 4, F.col("x1") + 5, F.col("y1") + 4).alias("box"))
    return R.first_overlap(rows.select("page", "seq", box()), moved, "page", 0.3)


@query("j19_greedy_overlap")
def greedy_overlap(spark, sf_dir):
    rows = derived(spark, sf_dir, RECTS)
    moved = rows.select("page", "seq", G.box(F.col("x0") + 5, F.col("y0") + 4, F.col("x1") + 5, F.col("y1") + 4).alias("box"))
    return R.greedy_overlap(rows.select("page", "seq", box()), moved, "page", 0.3)
