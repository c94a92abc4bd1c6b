"""Queries on the smaller rules: row joins, set splits, boxes, places and records."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import control as C
from ..operators import plugins as U
from ..sources.derived import derived
from .catalog import query
from .coordinates import POINTS, fit_sql

BLOCKS = "SELECT doc_id, CAST(doc_id % 7 AS INT) AS idx, text, n_chars FROM documents"
ROWS = "SELECT l_orderkey AS doc_id, l_linenumber AS idx, min(l_partkey) % 90 AS degree, min(l_suppkey) AS y, 12 AS font FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("j10_next_row", f"SELECT doc_id, idx, degree, nd AS minutes FROM (SELECT *, lead(degree) OVER w AS nd, lead(y) OVER w AS ny, lead(idx) OVER w AS ni FROM ({ROWS}) WINDOW w AS (PARTITION BY doc_id ORDER BY idx)) WHERE ni = idx + 1 AND ny - y < font")
def next_row(spark, sf_dir):
    """A degree and the minutes below it: the next text, if it is near enough."""
    w = Window.partitionBy("doc_id").orderBy("idx")
    rows = derived(spark, sf_dir, ROWS)
    rows = rows.select("doc_id", "idx", "degree", "y", "font", F.lead("degree").over(w).alias("minutes"), F.lead("y").over(w).alias("ny"), F.lead("idx").over(w).alias("ni"))
    return rows.filter((F.col("ni") == F.col("idx") + 1) & (F.col("ny") - F.col("y") < F.col("font"))).select("doc_id", "idx", "degree", "minutes")


@query("j17_index_join", f"WITH r AS (SELECT *, max(idx) OVER (PARTITION BY doc_id) AS last FROM ({ROWS})) SELECT o_orderkey AS doc_id, o_custkey % 9 - 1 AS place, r.idx FROM orders JOIN r ON r.doc_id = o_orderkey AND r.idx = CASE WHEN o_custkey % 9 - 1 < 0 THEN r.last ELSE o_custkey % 9 - 1 END")
def index_join(spark, sf_dir):
    """Places name texts by index; -1 is the last one."""
    rows = derived(spark, sf_dir, ROWS).withColumn("last", F.max("idx").over(Window.partitionBy("doc_id")))
    asked = derived(spark, sf_dir, "SELECT o_orderkey AS doc, o_custkey % 9 - 1 AS place FROM orders")
    at = F.when(F.col("place") < 0, F.col("last")).otherwise(F.col("place"))
    return asked.join(rows, (F.col("doc") == F.col("doc_id")) & (F.col("idx") == at)).select("doc_id", "place", "idx")


@query("j26_record_ids", "SELECT c_custkey AS record_id, CASE WHEN c_custkey % 3 = 0 THEN 'cog' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) END AS cog_id FROM customer")
def record_ids(spark, sf_dir):
    names = derived(spark, sf_dir, "SELECT c_custkey AS record_id, 'cog' || CAST(c_custkey AS STRING) AS cog FROM customer WHERE c_custkey % 3 = 0")
    return derived(spark, sf_dir, "SELECT c_custkey AS record_id FROM customer").join(names, "record_id", "left").select("record_id", F.coalesce("cog", F.col("record_id").cast("string")).alias("cog_id"))


@query("x3_symmetric_difference", "(SELECT l_partkey AS v FROM lineitem WHERE l_linenumber = 1 EXCEPT SELECT l_partkey FROM lineitem WHERE l_linenumber = 2) UNION ALL (SELECT l_partkey FROM lineitem WHERE l_linenumber = 2 EXCEPT SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)")
def symmetric_difference(spark, sf_dir):
    a, b = (derived(spark, sf_dir, f"SELECT DISTINCT l_partkey AS v FROM lineitem WHERE l_linenumber = {n}") for n in (1, 2))
    return a.exceptAll(b).unionByName(b.exceptAll(a))


@query("x4_cache_lacks", "SELECT p_size AS raster_id, count(DISTINCT p_brand) FILTER (WHERE p_partkey % 2 = 0) - count(DISTINCT CASE WHEN p_partkey % 2 = 0 AND p_brand IN (SELECT q.p_brand FROM part q WHERE q.p_partkey % 2 = 1 AND q.p_size = part.p_size) THEN p_brand END) AS missing FROM part GROUP BY p_size")
def cache_lacks(spark, sf_dir):
    sets = derived(spark, sf_dir, "SELECT p_size AS raster_id, p_brand, p_partkey FROM part").groupBy("raster_id").agg(F.collect_set(F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand"))).alias("want"), F.collect_set(F.when(F.col("p_partkey") % 2 == 1, F.col("p_brand"))).alias("have"))
    return sets.select("raster_id", F.size(F.array_except("want", "have")).cast("long").alias("missing"))


@query("x5_kept_and_excluded", "SELECT l_orderkey % 100 AS g, count(*) FILTER (WHERE l_discount < 0.05) AS kept, count(*) FILTER (WHERE l_discount >= 0.05) AS excluded FROM lineitem GROUP BY 1")
def kept_and_excluded(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT l_orderkey % 100 AS g, l_discount FROM lineitem").withColumn("status", F.when(F.col("l_discount") < 0.05, "kept").otherwise("excluded"))
    return rows.groupBy("g").pivot("status", ["kept", "excluded"]).count().na.fill(0)


@query("x7_distinct_relations", "SELECT DISTINCT l_partkey % 50 AS a, l_suppkey % 20 AS b FROM lineitem")
def distinct_relations(spark, sf_dir):
    return derived(spark, sf_dir, "SELECT l_partkey % 50 AS a, l_suppkey % 20 AS b FROM lineitem").distinct()


@query("x8_prediction_union", "SELECT s_suppkey AS id, 0 AS origin FROM supplier UNION ALL SELECT s_suppkey + 5, 1 FROM supplier WHERE s_suppkey % 2 = 0")
def prediction_union(spark, sf_dir):
    return U.union_of(derived(spark, sf_dir, "SELECT s_suppkey AS id FROM supplier"), derived(spark, sf_dir, "SELECT s_suppkey + 5 AS id FROM supplier WHERE s_suppkey % 2 = 0"))


QUADS = "SELECT c_custkey AS id, c_custkey % 50 AS x1, c_custkey % 40 AS y1, c_custkey % 50 + 30 AS x2, c_custkey % 40 + 2 AS y2, c_custkey % 50 + 29 AS x3, c_custkey % 40 + 20 AS y3, c_custkey % 50 - 1 AS x4, c_custkey % 40 + 19 AS y4 FROM customer"


@query("m36_quad_to_box", f"SELECT id, least(x1, x2, x3, x4) AS x0, least(y1, y2, y3, y4) AS y0, greatest(x1, x2, x3, x4) AS x1, greatest(y1, y2, y3, y4) AS y1 FROM ({QUADS})")
def quad_to_box(spark, sf_dir):
    ring = F.array(*[F.struct(F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y")) for n in (1, 2, 3, 4)])
    return derived(spark, sf_dir, QUADS).select("id", G.box_of(ring).alias("b")).select("id", "b.*")


@query("m37_rectangularity", f"SELECT id, round(abs(x1 * y2 - x2 * y1 + x2 * y3 - x3 * y2 + x3 * y4 - x4 * y3 + x4 * y1 - x1 * y4) / 2.0 / ((greatest(x1, x2, x3, x4) - least(x1, x2, x3, x4)) * (greatest(y1, y2, y3, y4) - least(y1, y2, y3, y4))), 6) AS share FROM ({QUADS})")
def rectangularity(spark, sf_dir):
    ring = F.array(*[F.struct(F.col(f"x{n}").cast("double").alias("x"), F.col(f"y{n}").cast("double").alias("y")) for n in (1, 2, 3, 4)])
    rows = derived(spark, sf_dir, QUADS).select("id", ring.alias("ring"))
    return rows.select("id", F.round(F.abs(G.ring_area2(F.col("ring"))) / 2 / G.area(G.box_of(F.col("ring"))), 6).alias("share"))


@query("g10_limited_ring", f"SELECT id, least(greatest(x4, 0), 60) AS x, least(greatest(y3, 0), 45) AS y FROM ({QUADS})")
def limited_ring(spark, sf_dir):
    ring = G.limited(F.array(*[F.struct(F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y")) for n in (1, 2, 3, 4)]), F.lit(60).cast("long"), F.lit(45).cast("long"))
    return derived(spark, sf_dir, QUADS).select("id", ring.alias("r")).select("id", F.get("r", 3)["x"].alias("x"), F.get("r", 2)["y"].alias("y"))


@query("g3_substring_centre", "SELECT p_partkey AS id, round(p_size + 200.0 * (1 + least(5, length(p_name))) / 2 / length(p_name) + 6, 6) AS x FROM part")
def substring_centre(spark, sf_dir):
    """Where the middle of a text's characters 2 to 5 lies in its box, half a letter height on."""
    rows = derived(spark, sf_dir, "SELECT p_partkey AS id, p_name, p_size FROM part")
    n = F.length("p_name")
    return rows.select("id", F.round(F.col("p_size") + F.lit(200.0) * (1 + F.least(F.lit(5), n)) / 2 / n + 6, 6).alias("x"))


@query("m31_distance", f"SELECT id, round(sqrt(pow(x3 - x1, 2) + pow(y3 - y1, 2)), 6) AS d FROM ({QUADS})")
def distance(spark, sf_dir):
    return derived(spark, sf_dir, QUADS).select("id", F.round(F.hypot(F.col("x3") - F.col("x1"), F.col("y3") - F.col("y1")), 6).alias("d"))


@query("m32_quarter_turn", f"SELECT id, CAST(x1 - (y3 - y1) AS INT) AS x, CAST(y1 + (x3 - x1) AS INT) AS y FROM ({QUADS})")
def quarter_turn(spark, sf_dir):
    import math

    p = G.rotated(F.col("x1"), F.col("y1"), F.col("x3"), F.col("y3"), F.lit(math.pi / 2))
    return derived(spark, sf_dir, QUADS).select("id", p.alias("p")).select("id", "p.x", "p.y")


@query("m30_label_bearing", f"SELECT id, round(degrees(atan2(-(y3 - y1), x3 - x1)), 6) AS bearing FROM ({QUADS})")
def label_bearing(spark, sf_dir):
    return derived(spark, sf_dir, QUADS).select("id", F.round(F.degrees(F.atan2(-(F.col("y3") - F.col("y1")), F.col("x3") - F.col("x1"))), 6).alias("bearing"))


@query("m38_parsed_dates", "SELECT DISTINCT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS s FROM events")
def parsed_dates(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT * FROM events").select(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd-HH:00:00").alias("t")).distinct()
    return rows.select(F.unix_timestamp(F.to_timestamp("t", "yyyy-MM-dd-HH:mm:ss")).alias("s"))


@query("t36_request_ids", "SELECT DISTINCT event_type || '-' || CAST(CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS STRING) || '-pipeline' AS request_id FROM events")
def request_ids(spark, sf_dir):
    return derived(spark, sf_dir, "SELECT * FROM events").select(F.concat_ws("-", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string"), F.lit("pipeline")).alias("request_id")).distinct()


@query("f39_features_with_points", "SELECT l_suppkey AS feature, count(*) FILTER (WHERE l_partkey % 97 = 0) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) FILTER (WHERE l_partkey % 97 = 0) > 0")
def features_with_points(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT l_suppkey AS feature, l_partkey FROM lineitem").groupBy("feature").agg(F.collect_list(F.when(F.col("l_partkey") % 97 == 0, F.col("l_partkey"))).alias("points"))
    return rows.filter(F.size("points") > 0).select("feature", F.size("points").cast("long").alias("n"))


@query("f41_masked_texts", "SELECT doc_id FROM documents WHERE length(regexp_replace(text, '[^a-zA-Z0-9]', '', 'g')) > 40 AND n_chars * 24 <= 60000")
def masked_texts(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT doc_id, text, n_chars FROM documents")
    return rows.filter((F.length(F.regexp_replace("text", "[^a-zA-Z0-9]", "")) > 40) & (F.col("n_chars") * 24 <= 60_000)).select("doc_id")


@query("a18_predictions_per_class", "SELECT l_orderkey % 200 AS raster_id, l_returnflag AS class_name, count(*) AS n FROM lineitem GROUP BY 1, 2")
def predictions_per_class(spark, sf_dir):
    return derived(spark, sf_dir, "SELECT l_orderkey % 200 AS raster_id, l_returnflag AS class_name FROM lineitem").groupBy("raster_id", "class_name").agg(F.count("*").alias("n"))


@query("a31_colour_spread", "SELECT l_suppkey AS image, CASE WHEN e < 20 THEN 'mono' WHEN e < 60 THEN 'low' ELSE 'high' END AS level FROM (SELECT l_suppkey, var_pop(l_partkey % 9 + l_suppkey % 3 * 2) + var_pop(l_linenumber * (l_suppkey % 4)) AS e FROM lineitem GROUP BY l_suppkey)")
def colour_spread(spark, sf_dir):
    """An image's colour level by the mean squared distance of its pixels' chroma from the mean."""
    rows = derived(spark, sf_dir, "SELECT l_suppkey AS image, l_partkey % 9 + l_suppkey % 3 * 2 AS a, l_linenumber * (l_suppkey % 4) AS b FROM lineitem")
    e = F.var_pop("a") + F.var_pop("b")
    return rows.groupBy("image").agg(e.alias("e")).select("image", F.when(F.col("e") < 20, "mono").when(F.col("e") < 60, "low").otherwise("high").alias("level"))


@query("a14_affine_fit", f"SELECT o.raster_id, {', '.join(f'round(o.{c} + 1e-7, 3) AS {c}' for c in 'abc')}, {', '.join(f'round(t.{c} + 1e-7, 3) AS {d}' for c, d in zip('abc', 'def', strict=True))} FROM ({fit_sql('lon')}) o JOIN ({fit_sql('lat')}) t ON o.raster_id = t.raster_id")
def affine_fit(spark, sf_dir):
    """Both outputs of an affine map from its control points."""
    from ..operators import keypoints as K

    rows = derived(spark, sf_dir, POINTS)
    lon, lat = (K.polynomial_fit(rows.select("raster_id", "x", "y", F.col(c).alias("z"))) for c in ("lon", "lat"))
    return lon.toDF("raster_id", "a", "b", "c").join(lat.toDF("raster_id", "d", "e", "f"), "raster_id").select("raster_id", *[F.round(F.col(c) + 1e-7, 3).alias(c) for c in "abcdef"])


@query("m19_shifted_queries", "SELECT c_custkey AS id, CAST(k AS INT) AS k, c_custkey % 90 + CASE WHEN k = 1 THEN 1 ELSE 0 END AS x, c_custkey % 70 + CASE WHEN k = 2 THEN 1 ELSE 0 END AS y FROM customer, (SELECT unnest([0, 1, 2]) AS k)")
def shifted_queries(spark, sf_dir):
    """A query point and its neighbours to the right and below."""
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for k, (dx, dy) in enumerate(((0, 0), (1, 0), (0, 1)))])).alias("p")
    return derived(spark, sf_dir, "SELECT c_custkey AS id, c_custkey % 90 AS x, c_custkey % 70 AS y FROM customer").select("id", at).select("id", "p.*")


@query("k10_two_biggest", "SELECT g, k FROM (SELECT l_suppkey AS g, l_linenumber AS k, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_linenumber) AS r FROM lineitem GROUP BY 1, 2) WHERE r <= 2")
def two_biggest(spark, sf_dir):
    n = derived(spark, sf_dir, "SELECT l_suppkey AS g, l_linenumber AS k FROM lineitem").groupBy("g", "k").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.col("n").desc(), "k"))).filter("r <= 2").select("g", "k")


@query("k12_hit_limit", "SELECT map_id, place, seq FROM (SELECT c_nationkey AS map_id, c_custkey % 50 AS place, c_custkey AS seq, c_custkey % 2 AS bound, row_number() OVER (PARTITION BY c_nationkey, c_custkey % 50 ORDER BY c_custkey) AS r FROM customer) WHERE r <= CASE WHEN place % 2 = 0 THEN 1 ELSE 4 END")
def hit_limit(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_nationkey AS map_id, c_custkey % 50 AS place, c_custkey AS seq FROM customer")
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("map_id", "place").orderBy("seq")))
    return rows.filter(F.col("r") <= F.when(F.col("place") % 2 == 0, 1).otherwise(4)).drop("r")


@query("u20_place_list", """WITH m AS (SELECT p_partkey AS map_id, p_brand AS country, p_type AS state, p_name AS county, p_partkey % 3 AS n FROM part)
SELECT map_id, 'bound' AS kind, country AS name FROM m UNION ALL SELECT map_id, 'bound', state FROM m UNION ALL SELECT map_id, 'bound', county FROM m WHERE n = 1 UNION ALL SELECT map_id, 'point', name FROM (SELECT map_id, unnest(string_split(county, ' ')) AS name FROM m)""")
def place_list(spark, sf_dir):
    """Places to look up: country and state, counties only beside a single state, and points."""
    rows = derived(spark, sf_dir, "SELECT p_partkey AS map_id, p_brand AS country, p_type AS state, p_name AS county, p_partkey % 3 AS n FROM part")
    item = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("name"))
    bounds = F.array(item("bound", F.col("country")), item("bound", F.col("state")))
    county = F.when(F.col("n") == 1, F.array(item("bound", F.col("county")))).otherwise(F.array().cast("array<struct<kind:string,name:string>>"))
    points = F.transform(F.split("county", " "), lambda w: item("point", w))
    return rows.select("map_id", F.explode(F.concat(bounds, county, points)).alias("p")).select("map_id", "p.*")


@query("f18_places_in_roi", "SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 = 0 OR (c_custkey % 100 BETWEEN 20 AND 70 AND c_custkey % 80 BETWEEN 10 AND 60)")
def places_in_roi(spark, sf_dir):
    """Places with a pixel must lie in the map; bounds pass."""
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, c_custkey % 100 AS x, c_custkey % 80 AS y, CASE WHEN c_custkey % 3 = 0 THEN 'bound' ELSE 'point' END AS kind FROM customer")
    ring = G.ring_of(G.box(F.lit(20), F.lit(10), F.lit(70), F.lit(60)))
    return rows.filter((F.col("kind") == "bound") | G.point_in_ring(F.col("x"), F.col("y"), ring)).select("id")


@query("k3_overlap_test", f"SELECT id, sqrt(pow(x3 - x1, 2) + pow(y3 - y1, 2)) <= 30 AS near FROM ({QUADS})")
def overlap_test(spark, sf_dir):
    chosen = F.array(F.struct(F.col("x3").alias("x"), F.col("y3").alias("y")))
    near = F.exists(chosen, lambda p: F.hypot(p["x"] - F.col("x1"), p["y"] - F.col("y1")) <= 30)
    return derived(spark, sf_dir, QUADS).select("id", near.alias("near"))


@query("o11_gcp_records", "SELECT l_orderkey AS raster_id, 'gcp.' || CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, min(l_partkey)) - 1 AS STRING) AS gcp_id, l_linenumber AS seq FROM lineitem GROUP BY l_orderkey, l_linenumber")
def gcp_records(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT DISTINCT l_orderkey AS raster_id, l_linenumber AS seq FROM lineitem")
    n = F.row_number().over(Window.partitionBy("raster_id").orderBy("seq")) - 1
    return rows.select("raster_id", F.concat(F.lit("gcp."), n.cast("string")).alias("gcp_id"), "seq")


@query("w13_first_keypoint", f"SELECT doc_id, arg_min(degree, idx) AS degree FROM ({ROWS}) GROUP BY doc_id")
def first_keypoint(spark, sf_dir):
    return derived(spark, sf_dir, ROWS).groupBy("doc_id").agg(F.min_by("degree", "idx").alias("degree"))


@query("t20_flattened_words", f"SELECT doc_id, len(string_split(text, ' ')) AS n_words, string_split(text, ' ')[1] AS first_word FROM ({BLOCKS})")
def flattened_words(spark, sf_dir):
    """Words from nested blocks, by posexplode, and back to one row a document."""
    words = derived(spark, sf_dir, BLOCKS).select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    return words.groupBy("doc_id").agg(F.count("*").alias("n_words"), F.min_by("word", "pos").alias("first_word"))


@query("f27_zone_overlap", "SELECT c_custkey AS id, c_custkey % 60 + 1 AS zone, ((c_custkey % 60 + 1) * 6 - 186 <= c_custkey % 300 - 130 AND (c_custkey % 60 + 1) * 6 - 180 >= c_custkey % 300 - 150) AS overlaps FROM customer")
def zone_overlap(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, c_custkey % 60 + 1 AS zone, c_custkey % 300 - 150 AS lon_min, c_custkey % 300 - 130 AS lon_max FROM customer")
    west = F.col("zone") * 6 - 186
    return rows.select("id", "zone", ((west <= F.col("lon_max")) & (west + 6 >= F.col("lon_min"))).alias("overlaps"))


@query("a2_degrees_both_axes", "SELECT l_orderkey AS raster_id, count(DISTINCT l_partkey % 40) FILTER (WHERE l_linenumber % 2 = 0) AS lat, count(DISTINCT l_partkey % 40) FILTER (WHERE l_linenumber % 2 = 1) AS lon FROM lineitem GROUP BY l_orderkey")
def degrees_both_axes(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT l_orderkey AS raster_id, l_partkey % 40 AS d, l_linenumber % 2 AS a FROM lineitem")
    return rows.groupBy("raster_id").agg(F.count_distinct(F.when(F.col("a") == 0, F.col("d"))).alias("lat"), F.count_distinct(F.when(F.col("a") == 1, F.col("d"))).alias("lon"))


@query("w5_unsplit_documents", "SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey)")
def unsplit_documents(spark, sf_dir):
    """Documents with and without two clusters of projected values add up to all."""
    from .georeference import VALUES

    values = derived(spark, sf_dir, VALUES)
    split = C.two_clusters(values).select("doc_id").distinct()
    rest = values.select("doc_id").distinct().join(split, "doc_id", "left_anti")
    return split.unionByName(rest).agg(F.count("*").alias("n"))
