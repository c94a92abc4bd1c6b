"""Queries on whole pipelines, their outputs, the work chain's ends, and pixels."""

import numpy as np
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import geometry as G
from ..functions import text as T
from ..operators import exchange as E
from ..operators import keypoints as K
from ..operators import lookups as U
from ..operators import pipelines as O
from ..operators import places as P
from ..operators import raster as R
from ..sources import files as S
from ..sources.derived import derived
from ..streaming import work as W
from .catalog import query
from .coordinates import BOUNDS, COORDS, FENCES, PLACES
from .pixels import images
from .points import ANNOTATIONS, FLAGS, LEGENDS, TILED
from .text_layer import CLASSES, FILTERED, RANKABLE, ocr, regions

DENOISED = f"SELECT doc_id, seq, class_label, confidence FROM (SELECT *, least(0.75, first_value(confidence) OVER (PARTITION BY doc_id, class_label ORDER BY seq)) AS cut FROM ({RANKABLE})) WHERE confidence >= cut"


@query("o2_segmentation", f"WITH d AS ({DENOISED}), m AS (SELECT DISTINCT doc_id FROM d WHERE class_label = 'map') SELECT c_custkey AS doc_id, (SELECT count(*) FROM d WHERE d.doc_id = c_custkey AND d.doc_id IN (SELECT doc_id FROM m)) AS regions, c_custkey NOT IN (SELECT doc_id FROM m) AS stopped FROM customer")
def segmentation(spark, sf_dir):
    """Regions that are sure enough, and documents that stop for want of a map."""
    documents = derived(spark, sf_dir, "SELECT c_custkey AS doc_id FROM customer")
    out = O.segmentation(documents, derived(spark, sf_dir, RANKABLE))
    n = out["records"].groupBy("doc_id").agg(F.count("*").alias("regions"))
    stopped = out["stopped"].select("doc_id", F.lit(True).alias("stopped"))
    return documents.join(n, "doc_id", "left").join(stopped, "doc_id", "left").select("doc_id", F.coalesce("regions", F.lit(0)).alias("regions"), F.coalesce("stopped", F.lit(False)).alias("stopped"))


@query("o3_metadata", FILTERED + """, keep AS (SELECT doc_id, idx, text FROM cnt GROUP BY doc_id, idx, text HAVING bool_or(NOT inside OR words = 0)), f AS (SELECT doc_id, text, min(idx) AS idx FROM keep GROUP BY doc_id, text)
SELECT doc_id, first(text ORDER BY idx) AS title, count(*) AS n_lines FROM f GROUP BY doc_id""")
def metadata(spark, sf_dir):
    """An extractor sees each document's texts outside its regions; this one takes the first line."""

    def load():
        return lambda b: b.assign(title=b["text"].map(lambda t: t.split("\n")[0]), n_lines=b["text"].map(lambda t: t.count("\n") + 1))[["doc_id", "title", "n_lines"]]

    return O.metadata(ocr(spark, sf_dir), regions(spark, sf_dir), CLASSES, load, "doc_id long, title string, n_lines long")["fields"]


@query("o4_points", f"""{FLAGS}, g AS (SELECT raster_id, class_name, seq, x1 + x_offset AS x1, y1 + y_offset AS y1, x2 + x_offset AS x2, y2 + y_offset AS y2, shared FROM f WHERE NOT redundant),
d AS (SELECT *, CASE WHEN shared THEN row_number() OVER (PARTITION BY raster_id, class_name, shared, floor((x1 + x2) / 4.0), floor((y1 + y2) / 4.0) ORDER BY seq DESC) ELSE 1 END AS r FROM g)
SELECT raster_id, seq, CASE WHEN class_name <> 'dip' THEN class_name || ' of the legend' END AS label FROM d WHERE r = 1""")
def points(spark, sf_dir):
    items = derived(spark, sf_dir, "SELECT DISTINCT l_orderkey AS raster_id, 'mine' AS class_name, 'mine of the legend' AS label FROM lineitem").unionByName(derived(spark, sf_dir, "SELECT DISTINCT l_orderkey AS raster_id, 'quarry' AS class_name, 'quarry of the legend' AS label FROM lineitem"))
    return O.points(derived(spark, sf_dir, TILED), items)["labels"].select("raster_id", "seq", "label")


@query("o14_class_masks", f"""{FLAGS}, g AS (SELECT raster_id, class_name, seq, x1 + x_offset AS x1, y1 + y_offset AS y1, x2 + x_offset AS x2, y2 + y_offset AS y2, shared FROM f WHERE NOT redundant)
SELECT raster_id, class_name, count(DISTINCT (floor((x1 + x2) / 2.0), floor((y1 + y2) / 2.0))) AS n_cells FROM (SELECT *, CASE WHEN shared THEN row_number() OVER (PARTITION BY raster_id, class_name, shared, floor((x1 + x2) / 4.0), floor((y1 + y2) / 4.0) ORDER BY seq DESC) ELSE 1 END AS r FROM g) WHERE r = 1 GROUP BY raster_id, class_name""")
def class_masks(spark, sf_dir):
    """A mask for each class of a map's symbols."""
    none = spark.createDataFrame([], "raster_id long, class_name string, label string")
    return O.points(derived(spark, sf_dir, TILED), none)["masks"].select("raster_id", "class_name", F.size("cells").cast("long").alias("n_cells"))


@query("o15_class_counts", "SELECT l_orderkey % 300 AS raster_id, l_returnflag || ': ' || CAST(count(*) AS STRING) AS line FROM lineitem GROUP BY l_orderkey % 300, l_returnflag")
def class_counts(spark, sf_dir):
    """A line a class for a map's debug image."""
    n = derived(spark, sf_dir, "SELECT l_orderkey % 300 AS raster_id, l_returnflag FROM lineitem").groupBy("raster_id", "l_returnflag").agg(F.count("*").alias("n"))
    return n.select("raster_id", F.concat_ws(": ", "l_returnflag", F.col("n").cast("string")).alias("line"))


TILES = "SELECT l_orderkey AS doc_id, l_linenumber % 3 AS tile, l_linenumber AS seq, 'w' || CAST(l_linenumber % 2 AS STRING) AS text, 4 * l_linenumber AS x0, 8 AS y0, 4 * l_linenumber + 8 AS x1, 16 AS y1, -4 * (l_linenumber % 3) AS x_offset, 100 AS y_offset FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("o6_text", f"WITH m AS (SELECT doc_id, tile, seq, text, x0 + x_offset AS x0, y0 + y_offset AS y0, x1 + x_offset AS x1, y1 + y_offset AS y1 FROM ({TILES})) SELECT doc_id, seq, x0, y0 FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, text, floor((x0 + x1) / 8.0), floor((y0 + y1) / 8.0) ORDER BY tile, seq) AS r FROM m) WHERE r = 1")
def text(spark, sf_dir):
    return O.text(derived(spark, sf_dir, TILES))["words"].select("doc_id", "seq", "x0", "y0")


@query("o16_segment_records", f"WITH d AS ({DENOISED}) SELECT doc_id, 'segmentation' AS output_type, count(*) AS n, sum(seq) AS seqs FROM d WHERE doc_id IN (SELECT doc_id FROM d WHERE class_label = 'map') GROUP BY doc_id")
def segment_records(spark, sf_dir):
    documents = derived(spark, sf_dir, "SELECT c_custkey AS doc_id FROM customer")
    out = O.segmentation(documents, derived(spark, sf_dir, RANKABLE))["records"]
    return out.groupBy("doc_id", "output_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("output", "$.seq").cast("long")).alias("seqs"))


@query("u2_output_creators", "SELECT 'counts' AS output, count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem) UNION ALL SELECT 'rows', count(*) FROM lineitem")
def output_creators(spark, sf_dir):
    tables = {"lines": derived(spark, sf_dir, "SELECT l_orderkey FROM lineitem")}
    out = O.outputs(tables, {"counts": lambda t: t["lines"].distinct(), "rows": lambda t: t["lines"]})
    a, b = (out[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("output"), "n") for n in ("counts", "rows"))
    return a.unionByName(b)


@query("u18_legend_items", f"""WITH a AS (SELECT * FROM ({ANNOTATIONS}) WHERE system IN ('curated', 'labelme') AND validated AND (system = 'labelme' OR category = 'point')), o AS (SELECT *, max(CASE WHEN system <> 'labelme' THEN 1 ELSE 0 END) OVER (PARTITION BY raster_id) AS o FROM a),
c AS (SELECT * FROM o WHERE o = 0 OR system <> 'labelme'), t AS (SELECT *, lag(label) OVER (PARTITION BY raster_id ORDER BY seq) AS b FROM c), k AS (SELECT * FROM t WHERE system <> 'labelme' OR label IS DISTINCT FROM b),
s AS (SELECT k.* FROM k JOIN ({LEGENDS}) l ON k.raster_id = l.raster_id WHERE (k.x0 + k.x1) / 2.0 BETWEEN l.x0 AND l.x1 AND (k.y0 + k.y1) / 2.0 BETWEEN l.y0 AND l.y1 AND (class_name <> '' OR (k.x1 - k.x0 < 120 AND k.x1 - k.x0 < 2 * (k.y1 - k.y0))))
SELECT raster_id, seq FROM s""")
def legend_items(spark, sf_dir):
    """From annotations to legend items: precedence, twins, legend regions, numbered labels."""
    box = G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias("box")
    rows = derived(spark, sf_dir, ANNOTATIONS).withColumn("box", box).drop("x0", "y0", "x1", "y1")
    return O.legend_items(rows, derived(spark, sf_dir, LEGENDS).select("raster_id", box), ["curated", "labelme"]).select("raster_id", "seq")


KNOWN = "SELECT l_orderkey AS map_id, 'p' || CAST(l_linenumber AS STRING) AS place, l_linenumber AS seq, 0 AS gen FROM lineitem WHERE l_linenumber <= 3"


@query("u21_geocoder", f"""WITH c AS ({COORDS}), e AS (SELECT raster_id FROM c GROUP BY raster_id HAVING least(count(*) FILTER (WHERE axis = 'lat' AND status = 'ok'), count(*) FILTER (WHERE axis = 'lon' AND status = 'ok')) < 2),
o AS ({KNOWN}), n AS (SELECT map_id, place, seq + 100 AS seq, 1 AS gen FROM ({KNOWN.replace('<= 3', 'IN (2, 4)')}) WHERE map_id IN (SELECT raster_id FROM e)), b AS (SELECT * FROM o UNION ALL SELECT * FROM n)
SELECT map_id, place, max(gen) AS gen FROM b GROUP BY map_id, place""")
def geocoder(spark, sf_dir):
    """Maps with too few keypoints look their places up; what is found replaces what was known."""
    coords = derived(spark, sf_dir, COORDS)
    asked = derived(spark, sf_dir, KNOWN.replace("<= 3", "IN (2, 4)"))
    found = lambda rows: rows.withColumn("gen", F.lit(1)).withColumn("seq", F.col("seq") + 100)
    return O.geocoder(asked, coords, derived(spark, sf_dir, KNOWN), found).select("map_id", "place", "gen")


@query("u23_point_geocoder", f"""WITH p AS ({PLACES}), f AS ({FENCES}), c AS (SELECT c_nationkey AS raster_id, CASE WHEN c_custkey % 2 = 0 THEN 'lat' ELSE 'lon' END AS axis, 'ok' AS status FROM customer WHERE c_custkey < 40),
i AS (SELECT p.* FROM p JOIN f USING (map_id) WHERE lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max),
w AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY map_id, place) AS w FROM i), m AS (SELECT *, round(sum(w * lon) OVER k / sum(w) OVER k, 9) AS x, round(sum(w * lat) OVER k / sum(w) OVER k, 9) AS y FROM w WINDOW k AS (PARTITION BY map_id)),
r AS (SELECT *, count(*) OVER (PARTITION BY map_id, place) AS n, row_number() OVER (PARTITION BY map_id, place ORDER BY round((lon - x) * (lon - x) + (lat - y) * (lat - y), 6), seq) AS r FROM m),
k AS (SELECT raster_id, least(count(*) FILTER (WHERE axis = 'lat'), count(*) FILTER (WHERE axis = 'lon')) AS n FROM c GROUP BY raster_id),
s AS (SELECT r.map_id, place, CASE WHEN r.n > 1 THEN 0.4 ELSE 0.8 END AS confidence, coalesce(k.n, 0) AS have FROM r LEFT JOIN k ON r.map_id = k.raster_id WHERE r = 1)
SELECT map_id AS raster_id, place FROM (SELECT *, rank() OVER (PARTITION BY map_id ORDER BY confidence DESC) AS q FROM s) WHERE q <= greatest(4 - have, 0)""")
def point_geocoder(spark, sf_dir):
    places = derived(spark, sf_dir, PLACES).withColumn("px", F.col("place")).withColumn("py", F.col("place"))
    coords = derived(spark, sf_dir, "SELECT c_nationkey AS raster_id, CASE WHEN c_custkey % 2 = 0 THEN 'lat' ELSE 'lon' END AS axis, 'ok' AS status FROM customer WHERE c_custkey < 40")
    return O.point_geocoder(places, derived(spark, sf_dir, FENCES), coords).select("raster_id", "place")


@query("o10_named_points", "SELECT l_orderkey AS raster_id, l_linenumber AS seq, regexp_replace(md5(CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS id FROM lineitem GROUP BY l_orderkey, l_linenumber")
def named_points(spark, sf_dir):
    """Every control point has an id of its own, the same in every run."""
    rows = derived(spark, sf_dir, "SELECT DISTINCT l_orderkey AS raster_id, l_linenumber AS seq FROM lineitem")
    digest = F.md5(F.concat_ws("/", F.col("raster_id").cast("string"), F.col("seq").cast("string")).cast("binary"))
    return rows.select("raster_id", "seq", F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5").alias("id"))


# ---- the work chain's ends ---------------------------------------------------------------------


@query("q2_consumed_requests", "SELECT event_id, CASE WHEN event_id % 7 > 0 THEN event_id * 2 END AS value, CASE WHEN event_id % 7 = 0 THEN 'again' END AS error FROM events")
def consumed_requests(spark, sf_dir):
    """Requests file by file: a good one's result counts once its batch is committed, a bad one is
    to be delivered again."""
    from ..operators import compose as M

    def each(batch, n):
        return M.tried(batch.select("event_id"), F.when(F.col("event_id") % 7 > 0, F.col("event_id") * 2), "again")

    return W.drained_batches(W.event_stream(spark, f"{sf_dir}/events.parquet"), each)


def published(spark, sf_dir):
    """Results as JSON text in a folder, by a streaming sink; the folder."""
    events = W.event_stream(spark, f"{sf_dir}/events.parquet")
    rows = events.filter("event_id % 4 > 0").select(F.to_json(F.struct(F.col("event_id").alias("image_id"), F.col("event_type").alias("output_type"))).alias("value"))
    folder = W.work_folder(spark)
    query = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").format("text").start(f"{folder}/results")
    query.awaitTermination()
    return f"{folder}/results"


@query("q4_published_results", "SELECT event_id AS image_id, event_type AS output_type FROM events WHERE event_id % 4 > 0")
def published_results(spark, sf_dir):
    return spark.read.text(published(spark, sf_dir)).select(F.from_json("value", "image_id long, output_type string").alias("r")).select("r.*")


@query("q7_heard_results", "SELECT event_type AS output_type, count(*) AS n FROM events WHERE event_id % 4 > 0 GROUP BY event_type")
def heard_results(spark, sf_dir):
    """A listener on the published results, as they come in."""
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(published(spark, sf_dir))
    heard = W.drained(stream.select(F.from_json("value", "image_id long, output_type string").alias("r")).select("r.*"))
    return heard.groupBy("output_type").agg(F.count("*").alias("n"))


@query("q8_published_requests", "SELECT 'metadata-' || CAST(n_nationkey AS STRING) || '-pipeline' AS request_id, n_nationkey AS image_id FROM nation")
def published_requests(spark, sf_dir):
    """Requests go out as files, one each, and are taken in as a stream."""
    rows = derived(spark, sf_dir, "SELECT 'metadata-' || CAST(n_nationkey AS STRING) || '-pipeline' AS request_id, n_nationkey AS image_id FROM nation")
    folder = W.work_folder(spark)
    S.write_bytes(S.json_objects(rows, F.concat("request_id", F.lit(".json"))), f"{folder}/requests")
    return W.drained(spark.readStream.schema("request_id string, image_id int").option("maxFilesPerTrigger", 10).json(f"{folder}/requests"))


GCPS = "SELECT l_orderkey AS raster_id, l_linenumber AS seq, min(l_partkey) % 400 AS x, min(l_suppkey) % 300 AS y, CAST(min(l_partkey) % 180 AS DOUBLE) AS lon, CAST(min(l_suppkey) % 90 AS DOUBLE) AS lat, 1.0 AS confidence FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("q10_written_georeferences", "SELECT l_orderkey AS raster_id, CASE WHEN l_orderkey % 5 = 0 THEN '{}' ELSE CAST(l_orderkey AS STRING) || '_4267_projected.tif' END AS file_name FROM lineitem GROUP BY l_orderkey")
def written_georeferences(spark, sf_dir):
    """A georeference that can't be mapped, here for want of a reference system, becomes an empty result."""
    out = E.control_points(derived(spark, sf_dir, GCPS), F.when(F.col("raster_id") % 5 > 0, F.lit("EPSG:4267")))
    return out.select("raster_id", F.when(F.col("crs").isNull(), F.lit("{}")).otherwise(F.col("file_name")).alias("file_name"))


@query("q11_wrapped_metadata", "SELECT p_partkey AS map_id, 'own' AS system, CAST(1900 + p_partkey % 100 AS INT) AS year FROM part")
def wrapped_metadata(spark, sf_dir):
    """A metadata record in the envelope that a service takes."""
    rows = derived(spark, sf_dir, "SELECT p_partkey AS map_id, p_name AS title, CAST(1900 + p_partkey % 100 AS STRING) AS year, '1:' || CAST(p_size AS STRING) AS scale, 'NULL' AS crs FROM part").withColumn("authors", F.array(F.lit("a")))
    wrapped = E.metadata_record(rows).select("map_id", F.struct(F.col("map_id").alias("cog_id"), F.lit("own").alias("system"), F.array("record").alias("map_metadata")).alias("m"))
    return wrapped.select("map_id", "m.system", F.get("m.map_metadata", 0)["year"].alias("year"))


# ---- pixels ------------------------------------------------------------------------------------

PIXELS = "SELECT vec_id AS id, unnest(range(0, 64)) AS k, unnest(list_transform(embedding, lambda x: CAST(least(greatest(floor((CAST(x AS DOUBLE) + 0.5) * 256), 0), 255) AS INT))) AS v FROM embeddings"


def flat(rows):
    """(id, w, h, total): the weighted sum of an image's bytes."""
    weighed = F.aggregate(F.transform(F.sequence(F.lit(1), F.length("pixels")), lambda k: F.conv(F.hex(F.substring("pixels", k, F.lit(1))), 16, 10).cast("long") * k), F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select("id", "w", "h", weighed.alias("total"))


@query("r15_whitened", f"SELECT id, 8 AS w, 8 AS h, CAST(sum(CASE WHEN v BETWEEN 60 AND 190 THEN v ELSE 255 END * (k + 1)) AS BIGINT) AS total FROM ({PIXELS}) GROUP BY id")
def whitened(spark, sf_dir):
    return flat(R.mapped(images(spark, sf_dir), lambda a: R.whitened(a, 60, 190)))


@query("r7_gamma", f"SELECT id, 8 AS w, 8 AS h, CAST(sum(CAST(round_even(255 * pow(v / 255.0::DOUBLE, 0.5), 0) AS INT) * (k + 1)) AS BIGINT) AS total FROM ({PIXELS}) GROUP BY id")
def gamma(spark, sf_dir):
    return flat(R.mapped(images(spark, sf_dir), lambda a: R.gamma(a, 0.5)))


@query("r13_cropped_templates", f"WITH p AS (SELECT id, k % 8 AS x, k // 8 AS y, v FROM ({PIXELS})), b AS (SELECT id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p WHERE v < 100 GROUP BY id) SELECT i.id, CAST(coalesce(x1 - x0 + 11, 8) AS INT) AS w, CAST(coalesce(y1 - y0 + 11, 8) AS INT) AS h FROM (SELECT DISTINCT id FROM p) i LEFT JOIN b ON i.id = b.id")
def cropped_templates(spark, sf_dir):
    """Templates cut to their dark part, with a margin."""
    return R.mapped(images(spark, sf_dir), lambda a: R.cropped(a, a < 100)).select("id", "w", "h")


@query("r19_swatch_crops", f"SELECT id, 4 AS w, 3 AS h, CAST(sum(v * ((k // 8 - 2) * 4 + k % 8 - 1 + 1)) AS BIGINT) AS total FROM ({PIXELS}) WHERE k % 8 BETWEEN 1 AND 4 AND k // 8 BETWEEN 2 AND 4 GROUP BY id")
def swatch_crops(spark, sf_dir):
    return flat(R.mapped(images(spark, sf_dir), lambda a: a[2:5, 1:5]))


@query("r24_resized", f"SELECT id, 4 AS w, 4 AS h, CAST(sum(v * ((k // 8) // 2 * 4 + (k % 8) // 2 + 1)) AS BIGINT) AS total FROM ({PIXELS}) WHERE (k % 8) % 2 = 1 AND (k // 8) % 2 = 1 GROUP BY id")
def resized(spark, sf_dir):
    """Images at half their size, by nearest pixels."""
    return flat(R.mapped(images(spark, sf_dir), lambda a: R.resized(a, 4, 4)))


@query("r23_drawn_boxes", "SELECT s_suppkey AS id, CAST(2 * (6 + s_suppkey % 5) + 2 * (4 + s_suppkey % 7) - 4 AS BIGINT) AS n FROM supplier")
def drawn_boxes(spark, sf_dir):
    """The outlines of control points on an image."""
    rows = derived(spark, sf_dir, "SELECT s_suppkey AS id, s_suppkey % 5 AS a, s_suppkey % 7 AS b FROM supplier")
    blank = bytes(np.full(30 * 30, 255, np.uint8))
    rows = rows.select("id", F.lit(30).alias("w"), F.lit(30).alias("h"), F.lit(blank).alias("pixels"), F.array(*[F.col(c).cast("int") if isinstance(c, str) else F.lit(c) for c in (3, 5, "a", "b")]).alias("box"))
    drawn = R.mapped(rows, lambda p, box: R.outlined(p, [(box[0], box[1], box[0] + 5 + box[2], box[1] + 3 + box[3])]), "box")
    dark = F.size(F.filter(F.sequence(F.lit(1), F.length("pixels")), lambda k: F.hex(F.substring("pixels", k, F.lit(1))) == "00"))
    return drawn.select("id", dark.cast("long").alias("n"))


@query("r9_turned_bands", f"SELECT id, CAST(sum(v * (CASE (k % 3) WHEN 0 THEN k + 2 WHEN 2 THEN k - 2 ELSE k END + 1)) AS BIGINT) AS total FROM ({PIXELS}) WHERE k < 63 GROUP BY id")
def turned_bands(spark, sf_dir):
    """RGB pixels with their bands in reverse, as other libraries have them."""
    rows = images(spark, sf_dir).select("id", F.lit(63).alias("w"), F.lit(1).alias("h"), F.substring("pixels", 1, 63).alias("pixels"))
    return flat(R.mapped(rows, lambda a: a.reshape(-1, 3)[:, ::-1].reshape(1, -1))).select("id", "total")


# ---- smaller rules with an entry of their own --------------------------------------------------


@query("f16_point_in_fence", f"WITH p AS ({PLACES}), f AS ({FENCES}) SELECT map_id, seq, lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max AS inside FROM p JOIN f USING (map_id)")
def point_in_fence(spark, sf_dir):
    return derived(spark, sf_dir, PLACES).join(derived(spark, sf_dir, FENCES), "map_id").select("map_id", "seq", P.in_fence(F.col("lon"), F.col("lat")).alias("inside"))


@query("d9_fence_driver", f"""WITH b AS ({BOUNDS}), s AS (SELECT map_id, min(lon0) AS lon_min, max(lon1) AS lon_max FROM b WHERE feature = 'state' GROUP BY map_id), c AS (SELECT n_nationkey AS map_id, CAST(n_nationkey AS DOUBLE) AS lon FROM nation WHERE n_nationkey % 6 = 0)
SELECT n_nationkey AS map_id, CASE WHEN c.map_id IS NOT NULL THEN 0 WHEN s.map_id IS NOT NULL THEN 1 ELSE 2 END AS level, coalesce(c.lon - 1, s.lon_min, -180) AS lon_min FROM nation LEFT JOIN c ON n_nationkey = c.map_id LEFT JOIN s ON n_nationkey = s.map_id""")
def fence_driver(spark, sf_dir):
    """A clue point's fence, else the states', else the world."""
    clue = derived(spark, sf_dir, "SELECT n_nationkey AS map_id, CAST(n_nationkey AS DOUBLE) AS lon FROM nation WHERE n_nationkey % 6 = 0")
    clue = clue.select("map_id", (F.col("lon") - 1).alias("lon_min"), (F.col("lon") + 1).alias("lon_max"), F.lit(0.0).alias("lat_min"), F.lit(1.0).alias("lat_max"))
    out = P.fence_cascade(derived(spark, sf_dir, "SELECT n_nationkey AS map_id FROM nation"), clue, P.envelope(derived(spark, sf_dir, BOUNDS), "state"))
    return out.select("map_id", "level", "lon_min")


NUMBERS = "SELECT c_custkey AS id, CAST(c_custkey % 41 - 20 AS DOUBLE) AS x, CAST(c_custkey % 400 AS DOUBLE) AS dx, CAST(c_custkey % 130 AS DOUBLE) AS dy FROM customer"


@query("m1_sign", f"SELECT id, CASE WHEN x < 0 THEN -1 ELSE 1 END AS sign FROM ({NUMBERS})")
def sign(spark, sf_dir):
    return derived(spark, sf_dir, NUMBERS).select("id", geo.sign(F.col("x")).alias("sign"))


@query("m27_raster_dpi", f"SELECT id, CASE WHEN (dx + dy) / 2 < 72 THEN 300 ELSE (dx + dy) / 2 END AS dpi FROM ({NUMBERS})")
def raster_dpi(spark, sf_dir):
    return derived(spark, sf_dir, NUMBERS).select("id", geo.dpi(F.col("dx"), F.col("dy")).alias("dpi"))


@query("m34_clipped_boxes", "SELECT c_custkey AS id, CAST(least(greatest(trunc(1000 * (c_custkey % 500 - 50) / 333.0), 0), 1000) AS INT) AS x0, CAST(least(greatest(trunc(1000 * (c_custkey % 300 + 40) / 250.0), 0), 1000) AS INT) AS y1 FROM customer")
def clipped_boxes(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, c_custkey % 500 - 50 AS x0, c_custkey % 300 + 40 AS y1 FROM customer")
    box = G.normalised(G.box(F.col("x0"), F.lit(0), F.col("x0") + 30, F.col("y1")), F.lit(333), F.lit(250), clip=True)
    return rows.select("id", box.alias("b")).select("id", "b.x0", "b.y1")


@query("g15_vertices", "SELECT c_custkey AS id, CAST(n AS INT) AS n, c_custkey % 50 + CASE WHEN n IN (1, 2) THEN 20 ELSE 0 END AS x, c_custkey % 40 + CASE WHEN n >= 2 THEN 10 ELSE 0 END AS y FROM customer, (SELECT unnest([0, 1, 2, 3]) AS n)")
def vertices(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, c_custkey % 50 AS x0, c_custkey % 40 AS y0 FROM customer")
    ring = G.ring_of(G.box(F.col("x0"), F.col("y0"), F.col("x0") + 20, F.col("y0") + 10))
    return rows.select("id", F.posexplode(ring).alias("n", "p")).select("id", "n", "p.x", "p.y")


@query("d22_text_centroids", "SELECT c_custkey AS id, c_custkey % 50 + 10.0::DOUBLE AS x, c_custkey % 40 + 5.0::DOUBLE AS y FROM customer")
def text_centroids(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, CAST(c_custkey % 50 AS DOUBLE) AS x0, CAST(c_custkey % 40 AS DOUBLE) AS y0 FROM customer")
    c = G.centroid(G.ring_of(G.box(F.col("x0"), F.col("y0"), F.col("x0") + 20, F.col("y0") + 10)))
    return rows.select("id", c.alias("c")).select("id", F.round("c.x", 9).alias("x"), F.round("c.y", 9).alias("y"))


@query("d23_vertex_boxes", "SELECT c_custkey AS id, c_custkey % 50 - 3 AS x0, c_custkey % 40 AS y0, c_custkey % 50 + 20 AS x1, c_custkey % 40 + 14 AS y1 FROM customer")
def vertex_boxes(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, c_custkey % 50 AS x, c_custkey % 40 AS y FROM customer")
    corners = ((0, 0), (20, 2), (18, 14), (-3, 12))
    ring = F.array(*[F.struct((F.col("x") + a).alias("x"), (F.col("y") + b).alias("y")) for a, b in corners])
    return rows.select("id", G.box_of(ring).alias("b")).select("id", "b.*")


@query("t12_angle_parts", "SELECT s_suppkey AS id, CAST(s_suppkey % 90 AS DOUBLE) AS d, CAST(s_suppkey % 60 AS INT) AS m FROM supplier")
def angle_parts(spark, sf_dir):
    """Degrees and minutes of labels with other signs between them."""
    sign = F.when(F.col("s_suppkey") % 2 == 0, "°").otherwise("o")
    label = F.concat((F.col("s_suppkey") % 90).cast("string"), sign, F.lpad((F.col("s_suppkey") % 60).cast("string"), 2, "0"), F.lit("'"))
    return derived(spark, sf_dir, "SELECT s_suppkey FROM supplier").select(F.col("s_suppkey").alias("id"), geo.dms_parts(label).alias("p")).select("id", "p.d", "p.m")


@query("d6_scale_texts", "SELECT p_partkey AS id, p_partkey % 3 < 2 AS scale FROM part")
def scale_texts(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'SCALE of the map' WHEN 1 THEN '1:24000' ELSE 'plain' END AS text FROM part")
    return rows.select("id", T.is_scale_text(F.col("text")).alias("scale"))


@query("d5_nad83_units", "SELECT c_custkey AS id, c_custkey % 3 = 0 OR c_custkey % 5 = 0 OR 1960 + c_custkey % 50 >= 1986 AS feet FROM customer")
def nad83_units(spark, sf_dir):
    """Values of maps in the newer datum are feet."""
    rows = derived(spark, sf_dir, "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'NAD83' END AS datum, CASE WHEN c_custkey % 5 = 0 THEN 'state plane 83' ELSE 'utm' END AS system, 1960 + c_custkey % 50 AS year FROM customer")
    return rows.select("id", geo.evidence_of_nad83(F.col("datum"), F.array("system"), F.col("year")).alias("feet"))


@query("x2_places_of_all_kinds", "SELECT c_custkey AS id, c_custkey % 3 AS origin FROM customer")
def places_of_all_kinds(spark, sf_dir):
    """Bounds, points and centres one after another."""
    from ..operators import plugins as R_

    parts = [derived(spark, sf_dir, f"SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 = {n}") for n in range(3)]
    return R_.union_of(*parts).withColumn("origin", F.col("origin").cast("long"))


@query("u5_looked_up_boxes", "SELECT c_custkey AS id, CAST(c_custkey % 90 AS DOUBLE) AS x0, CAST(c_custkey % 90 + 2 AS DOUBLE) AS x2 FROM customer WHERE c_custkey % 4 > 0")
def looked_up_boxes(spark, sf_dir):
    """A geocoder's boxes as rings of four corners, the cache before the service."""
    from ..operators import plugins as R_

    def load():
        return lambda b: b.assign(lon0=b["id"] % 90.0, lon1=b["id"] % 90.0 + 2)[["id", "lon0", "lon1"]]

    rows = derived(spark, sf_dir, "SELECT c_custkey AS id FROM customer WHERE c_custkey % 4 > 0")
    cache = derived(spark, sf_dir, "SELECT c_custkey AS id, CAST(c_custkey % 90 AS DOUBLE) AS lon0, CAST(c_custkey % 90 + 2 AS DOUBLE) AS lon1 FROM customer WHERE c_custkey % 3 = 0")
    found = R_.cached(rows, cache, "id", load, "id long, lon0 double, lon1 double")
    ring = G.ring_of(G.box(F.col("lon0"), F.lit(0.0), F.col("lon1"), F.lit(1.0)))
    return found.select("id", F.get(ring, 0)["x"].alias("x0"), F.get(ring, 2)["x"].alias("x2"))


@query("s17_code_table", "SELECT lower(n_name) AS name, min(lower(substr(n_name, 1, 3))) AS code FROM nation GROUP BY 1")
def code_table(spark, sf_dir):
    """A table of names and codes from CSV: header passed over, all in lower case."""
    folder = W.work_folder(spark)
    derived(spark, sf_dir, "SELECT n_name AS name, substr(n_name, 1, 3) AS code FROM nation").write.option("header", True).csv(f"{folder}/codes")
    return spark.read.option("header", True).schema("name string, code string").csv(f"{folder}/codes").select(F.lower("name").alias("name"), F.lower("code").alias("code"))


@query("s21_state_codes", "SELECT c_custkey AS id, CASE WHEN r_regionkey <> 2 THEN lower(substr(r_name, 1, 2)) END AS state_code FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def state_codes(spark, sf_dir):
    """State names through a table of codes that a CSV file holds."""
    folder = W.work_folder(spark)
    derived(spark, sf_dir, "SELECT r_name AS name, lower(substr(r_name, 1, 2)) AS code FROM region WHERE r_regionkey <> 2").write.option("header", True).csv(f"{folder}/codes")
    codes = spark.read.option("header", True).schema("name string, code string").csv(f"{folder}/codes")
    asked = derived(spark, sf_dir, "SELECT c_custkey AS id, r_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
    return U.lookup(asked, codes, "state").select("id", F.col("code").alias("state_code"))


@query("d36_halted_outputs", "SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 4 = 0 THEN '{}' ELSE '{\"id\":' || CAST(c_custkey AS STRING) || '}' END AS output FROM customer")
def halted_outputs(spark, sf_dir):
    """A document that stops has empty outputs."""
    from ..operators import compose as M

    rows = derived(spark, sf_dir, "SELECT c_custkey AS doc_id, c_custkey AS id FROM customer")
    stopped = M.halted(rows, {"no map": derived(spark, sf_dir, "SELECT c_custkey AS doc_id FROM customer WHERE c_custkey % 4 = 0")})
    return E.envelope(stopped, F.when(F.col("halt_reason").isNull(), F.struct("id")), "doc_id").select("doc_id", "output")


@query("d35_empty_envelopes", "SELECT 'r' || CAST(s_suppkey AS STRING) AS request_id, TRUE AS success, '{}' AS output FROM supplier")
def empty_envelopes(spark, sf_dir):
    return E.envelope(derived(spark, sf_dir, "SELECT 'r' || CAST(s_suppkey AS STRING) AS request_id FROM supplier"), F.lit(None).cast("struct<a:int>"))


@query("d14_predictions", "SELECT c_custkey AS id, least(greatest(1.5::DOUBLE + 0.25::DOUBLE * (c_custkey % 400) - 0.5::DOUBLE * (c_custkey % 30), -90), 90) AS value FROM customer")
def predictions(spark, sf_dir):
    """A fit applied to points, held within the globe."""
    points = derived(spark, sf_dir, "SELECT c_custkey AS id, 1 AS raster_id, c_custkey % 400 AS x, c_custkey % 30 AS y FROM customer")
    fit = spark.createDataFrame([(1, 1.5, 0.25, -0.5)], "raster_id int, a double, b double, c double")
    return K.predicted(points, fit, 90.0).select("id", "value")


# ---- outlines ----------------------------------------------------------------------------------

PAIRS = "SELECT c_custkey AS id, c_custkey % 37 - 18 AS dx, c_custkey % 23 - 11 AS dy FROM customer"


@query("g8_merged_boxes", f"SELECT id, round(CASE WHEN abs(dx) < 10 AND abs(dy) < 6 THEN 120 - (10 - abs(dx)) * (6 - abs(dy)) ELSE 60 + abs(dx) * 6 + abs(dy) * 10 END, 6) AS area FROM ({PAIRS})")
def merged_boxes(spark, sf_dir):
    """Two text boxes as one polygon: their union if they overlap, else their hull."""
    from ..operators import outlines as L

    rows = derived(spark, sf_dir, PAIRS)
    ring = lambda x, y: G.ring_of(G.box(x, y, x + 10, y + 6))
    rows = rows.select("id", ring(F.lit(100).cast("long"), F.lit(100).cast("long")).alias("a"), ring(F.col("dx") + 100, F.col("dy") + 100).alias("b"))
    return L.merged_pairs(rows).select("id", F.round(F.abs(G.ring_area2(F.col("ring"))) / 2, 6).alias("area"))


ROW = "SELECT DISTINCT l_orderkey AS doc_id, l_suppkey % 40 * 20 AS x0 FROM lineitem"


@query("g7_united_regions", f"""WITH b AS ({ROW}), n AS (SELECT *, CASE WHEN x0 - lag(x0) OVER (PARTITION BY doc_id ORDER BY x0) < 30 THEN 0 ELSE 1 END AS new FROM b), i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY x0 ROWS UNBOUNDED PRECEDING) AS k FROM n)
SELECT doc_id, count(*) AS n, round(sum(area), 6) AS area FROM (SELECT doc_id, k, (max(x0) + 30 - min(x0)) * 10 AS area FROM i GROUP BY doc_id, k) GROUP BY doc_id""")
def united_regions(spark, sf_dir):
    """A document's regions, those that overlap united, however they are chained."""
    from ..operators import outlines as L

    ring = G.ring_of(G.box(F.col("x0"), F.lit(0).cast("long"), F.col("x0") + 30, F.lit(10).cast("long")))
    rows = derived(spark, sf_dir, ROW).groupBy("doc_id").agg(F.collect_list(ring).alias("rings"))
    out = L.merged_polygons(rows).select("doc_id", (F.abs(G.ring_area2(F.col("ring"))) / 2).alias("area"))
    return out.groupBy("doc_id").agg(F.count("*").alias("n"), F.round(F.sum("area"), 6).alias("area"))
