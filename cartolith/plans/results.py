"""Queries on scores, exchange records and the streaming work chain."""

from pyspark.sql import functions as F

from ..operators import exchange as X
from ..operators import keypoints as K
from ..operators import scoring as S
from ..sources.derived import derived
from ..streaming import work as W
from .catalog import query
from .coordinates import COORDS

TRUTH = "SELECT p_partkey AS map_id, CASE WHEN p_partkey % 11 = 0 THEN 'NULL' ELSE p_name END AS title, p_type AS kind, CAST(p_size AS STRING) AS size FROM part"
FOUND = "SELECT p_partkey AS map_id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || '.' ELSE p_brand END AS title, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS kind, CAST(p_size + p_partkey % 2 AS STRING) AS size FROM part WHERE p_partkey % 17 > 0"
FIELDS = ["title", "kind", "size"]
CLEAN = "trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+', ' ', 'g'))"
SCORED = f"""WITH t AS ({TRUTH}), p AS ({FOUND}), u AS (""" + " UNION ALL ".join(f"SELECT t.map_id, '{f}' AS field, t.{f} AS t, p.{f} AS p FROM t JOIN p USING (map_id)" for f in FIELDS) + f"""),
s AS (SELECT map_id, field, coalesce(CAST({CLEAN.format('t')} = {CLEAN.format('p')} AS DOUBLE), 0.0) AS score FROM u WHERE t IS NOT NULL AND upper(t) NOT IN ('NULL', ''))"""


@query("t10_field_scores", f"{SCORED} SELECT * FROM s")
def field_scores(spark, sf_dir):
    return S.field_scores(derived(spark, sf_dir, TRUTH), derived(spark, sf_dir, FOUND), "map_id", FIELDS)


@query("a22_mean_scores", f"{SCORED} SELECT field, count(*) AS n, round(avg(score), 6) AS score FROM s GROUP BY field")
def mean_scores(spark, sf_dir):
    return S.means(field_scores(spark, sf_dir)).select("field", "n", F.round("score", 6).alias("score"))


@query("j18_scored_maps", f"WITH t AS ({TRUTH}), p AS ({FOUND}) SELECT t.map_id, t.title AS truth, p.title AS found FROM t JOIN p USING (map_id)")
def scored_maps(spark, sf_dir):
    return derived(spark, sf_dir, TRUTH).select("map_id", F.col("title").alias("truth")).join(derived(spark, sf_dir, FOUND).select("map_id", F.col("title").alias("found")), "map_id")


@query("a24_score_deciles", "SELECT unnest([10, 20, 30, 40, 50, 60, 70, 80, 90]) AS decile, round(unnest(quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])), 4) AS value FROM lineitem")
def score_deciles(spark, sf_dir):
    return S.deciles(derived(spark, sf_dir, "SELECT * FROM lineitem"), "l_extendedprice").select("decile", F.round("value", 4).alias("value"))


@query("a25_weighted_f1", "SELECT l_suppkey AS team, round(sum(l_discount * (6 + l_linenumber % 4) / 10.0) / sum((6 + l_linenumber % 4) / 10.0), 6) AS f1 FROM lineitem GROUP BY l_suppkey")
def weighted_f1(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT l_suppkey AS team, l_discount AS f1, (6 + l_linenumber % 4) / 10.0 AS iou FROM lineitem").withColumn("iou", F.col("iou").cast("double"))
    return S.weighted(rows, "f1", "iou", "team").select("team", F.round("f1", 6).alias("f1"))


COUNTS = "SELECT l_suppkey AS team, sum(CASE WHEN l_linenumber % 3 = 0 AND l_partkey % 2 = 0 THEN 1 ELSE 0 END) AS hits, sum(CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END) AS n_true, sum(CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 0 END) AS n_found FROM lineitem GROUP BY l_suppkey"


@query("a26_precision_recall", f"""WITH c AS ({COUNTS}), r AS (SELECT team, CASE WHEN n_found > 0 THEN hits::DOUBLE / n_found ELSE 0 END AS p, CASE WHEN n_true > 0 THEN hits::DOUBLE / n_true ELSE 0 END AS r FROM c)
SELECT team, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM r""")
def precision_recall(spark, sf_dir):
    rates = S.rates(F.col("hits"), F.col("n_true"), F.col("n_found"))
    return derived(spark, sf_dir, COUNTS).select("team", *rates).select("team", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("a27_missing_truth", "SELECT count(*) AS n_maps, CAST(sum(n_true) AS BIGINT) AS n_true FROM (SELECT o_custkey, count(*) AS n_true FROM orders GROUP BY o_custkey) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 > 0)")
def missing_truth(spark, sf_dir):
    truth = derived(spark, sf_dir, "SELECT o_custkey, count(*) AS n_true FROM orders GROUP BY o_custkey")
    done = derived(spark, sf_dir, "SELECT c_custkey AS o_custkey FROM customer WHERE c_custkey % 4 > 0")
    return truth.join(done, "o_custkey", "left_anti").agg(F.count("*").alias("n_maps"), F.sum("n_true").alias("n_true"))


GEO = "SELECT l_suppkey AS map_id, CAST(l_partkey % 60 AS DOUBLE) AS lat, CAST(l_partkey % 120 - 60 AS DOUBLE) AS lon, CASE WHEN l_suppkey % 5 > 0 THEN l_partkey % 60 + l_linenumber / 100.0 END AS true_lat, CAST(l_partkey % 120 - 60 AS DOUBLE) AS true_lon FROM lineitem"


@query("a7_point_rmse", f"""WITH g AS ({GEO}), e AS (SELECT map_id, 2 * 6371.0088 * asin(sqrt(pow(sin(radians(true_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(true_lat)) * pow(sin(radians(true_lon - lon) / 2), 2))) AS km FROM g)
SELECT map_id, round(coalesce(sqrt(avg(km * km)), -1.0), 5) AS rmse FROM e GROUP BY map_id""")
def point_rmse(spark, sf_dir):
    rows = derived(spark, sf_dir, GEO).withColumn("true_lat", F.col("true_lat").cast("double"))
    return S.rmse(rows, "map_id").select("map_id", F.round("rmse", 5).alias("rmse"))


@query("a29_feature_groups", "SELECT p_type || CASE WHEN p_size % 3 = 0 THEN '_vertical' WHEN p_size % 3 = 1 THEN '_horizontal' ELSE '' END AS feature, count(*) AS n FROM part GROUP BY 1")
def feature_groups(spark, sf_dir):
    dip = F.when(F.col("p_size") % 3 == 0, 90).when(F.col("p_size") % 3 == 2, 45)
    name = F.concat("p_type", F.when(F.coalesce(dip, F.lit(0)) == 90, "_vertical").when(F.coalesce(dip, F.lit(0)) == 0, "_horizontal").otherwise(""))
    return derived(spark, sf_dir, "SELECT * FROM part").groupBy(name.alias("feature")).agg(F.count("*").alias("n"))


REGIONS = "SELECT o_orderkey AS doc_id, o_custkey AS seq, CASE o_orderkey % 4 WHEN 0 THEN 'map' WHEN 1 THEN 'legend_points_lines' WHEN 2 THEN 'legend_polygons' ELSE 'footer' END AS class_label, o_orderkey % 90 AS x, o_orderkey % 70 AS y, o_custkey % 500 AS w, o_custkey % 300 AS h, 0.5 AS confidence FROM orders"


@query("g16_exchange_areas", f"SELECT doc_id, CASE class_label WHEN 'map' THEN 'map_area' WHEN 'legend_points_lines' THEN 'line_point_legend_area' WHEN 'legend_polygons' THEN 'polygon_legend_area' ELSE 'text' END AS area_type, x AS x0, y + h AS y1 FROM ({REGIONS})")
def exchange_areas(spark, sf_dir):
    out = X.areas(derived(spark, sf_dir, REGIONS), "own", "1")
    return out.select("doc_id", "area_type", F.get("bbox", 0).alias("x0"), F.get("bbox", 3).alias("y1"))


GCPS = "SELECT l_orderkey AS raster_id, l_linenumber AS seq, min(l_partkey) % 400 AS x, min(l_suppkey) % 300 AS y, CAST(min(l_partkey) % 180 AS DOUBLE) AS lon, CAST(min(l_suppkey) % 90 AS DOUBLE) AS lat, 1.0 AS confidence FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("g17_exchange_gcps", f"WITH g AS ({GCPS}) SELECT raster_id, count(*) AS n_gcps, 'gcp.' || CAST(min(seq) AS STRING) AS first_id, arg_min(lon, seq) AS first_lon, CAST(raster_id AS STRING) || '_4267_projected.tif' AS file_name FROM g GROUP BY raster_id")
def exchange_gcps(spark, sf_dir):
    out = X.control_points(derived(spark, sf_dir, GCPS), F.lit("EPSG:4267"))
    first = F.get("gcps", 0)
    return out.select("raster_id", F.size("gcps").cast("long").alias("n_gcps"), first["gcp_id"].alias("first_id"), first["map_geom"]["lon"].alias("first_lon"), "file_name")


META = "SELECT p_partkey AS map_id, CASE WHEN p_partkey % 5 = 0 THEN 'NULL' ELSE p_name END AS title, p_brand AS a1, p_type AS a2, CASE WHEN p_partkey % 4 = 0 THEN 'c. 1950' ELSE CAST(1900 + p_partkey % 100 AS STRING) END AS year, CASE WHEN p_partkey % 3 = 0 THEN 'NULL' ELSE '1:' || CAST(p_size * 1000 AS STRING) END AS scale, 'NULL' AS crs FROM part"


@query("m39_metadata_record", f"SELECT map_id, nullif(title, 'NULL') AS title, a1 || ', ' || a2 AS authors, TRY_CAST(year AS INT) AS year, TRY_CAST(split_part(nullif(scale, 'NULL'), ':', 2) AS INT) AS scale FROM ({META})")
def metadata_record(spark, sf_dir):
    rows = derived(spark, sf_dir, META).withColumn("authors", F.array("a1", "a2"))
    return X.metadata_record(rows).select("map_id", "record.title", "record.authors", "record.year", "record.scale")


@query("d34_result_envelope", "SELECT 'r' || CAST(s_suppkey AS STRING) AS request_id, TRUE AS success, CASE WHEN s_suppkey % 3 = 0 THEN '{}' ELSE '{\"id\":' || CAST(s_suppkey AS STRING) || ',\"name\":\"' || s_name || '\"}' END AS output FROM supplier")
def result_envelope(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT 'r' || CAST(s_suppkey AS STRING) AS request_id, s_suppkey AS id, s_name AS name FROM supplier")
    return X.envelope(rows, F.when(F.col("id") % 3 > 0, F.struct("id", "name")))


@query("o8_source_summary", f"""WITH c AS ({COORDS}), s AS (SELECT raster_id, source, CAST(count(*) FILTER (WHERE axis = 'lat') AS STRING) || ';' || CAST(count(*) FILTER (WHERE axis = 'lon') AS STRING) AS v FROM c GROUP BY raster_id, source)
SELECT raster_id, coalesce(max(v) FILTER (WHERE source = 'lat_lon'), '0;0') AS lat_lon, coalesce(max(v) FILTER (WHERE source = 'utm'), '0;0') AS utm, coalesce(max(v) FILTER (WHERE source = 'state_plane'), '0;0') AS state_plane FROM s GROUP BY raster_id""")
def source_summary(spark, sf_dir):
    return X.pivoted_summary(K.source_counts(derived(spark, sf_dir, COORDS)), ["lat_lon", "utm", "state_plane"])


EVENT_KINDS = ["click", "purchase"]


@query("q1_event_ingest", "SELECT event_id, user_id, event_type, CAST(regexp_extract(props, '\"k\": *(\\d+)', 1) AS BIGINT) AS k FROM events WHERE event_type IN ('click', 'purchase')")
def event_ingest(spark, sf_dir):
    stream = W.accepted(W.event_stream(spark, f"{sf_dir}/events.parquet"), EVENT_KINDS)
    return W.drained(stream.select("event_id", "user_id", "event_type", "k"))


@query("f38_event_replay", "SELECT event_id FROM events WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'")
def event_replay(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT * FROM events")
    ends = [F.to_timestamp(F.lit(t), "yyyy-MM-dd-HH:mm:ss") for t in ("2024-01-03-00:00:00", "2024-01-09-12:00:00")]
    return rows.filter((F.col("event_type") == "click") & F.col("ts").cast("timestamp").between(*ends)).select("event_id")


CHAIN = "SELECT event_id AS image_id, CASE event_id % 4 WHEN 0 THEN 'segmentation' WHEN 1 THEN 'metadata' WHEN 2 THEN 'points' ELSE 'georeferencing' END AS stage, event_id % 5 > 0 AS success FROM events"


@query("q6_chained_requests", f"""WITH c AS ({CHAIN}), n AS (SELECT image_id, CASE stage WHEN 'segmentation' THEN 'metadata' WHEN 'metadata' THEN 'points' WHEN 'points' THEN 'georeferencing' END AS stage FROM c WHERE success)
SELECT stage || '-' || CAST(image_id AS STRING) || '-pipeline' AS request_id, image_id, stage FROM n WHERE stage IS NOT NULL""")
def chained_requests(spark, sf_dir):
    stage = F.get(F.array(*map(F.lit, W.SEQUENCE)), (F.col("event_id") % 4).cast("int"))
    events = W.event_stream(spark, f"{sf_dir}/events.parquet").select(F.col("event_id").alias("image_id"), stage.alias("stage"), (F.col("event_id") % 5 > 0).alias("success"))
    return W.drained(W.chained(events))


@query("q5_dead_letters", "SELECT event_id, event_id % 6 AS attempt, event_id % 6 >= 3 AS set_aside FROM events")
def dead_letters(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT event_id, event_id % 6 AS attempt FROM events")
    again, aside = W.split_by_deliveries(rows)
    return again.withColumn("set_aside", F.lit(False)).unionByName(aside.withColumn("set_aside", F.lit(True)))


@query("q9_dispatched_results", "SELECT event_id AS image_id, CAST(event_id AS STRING) || '_' || CASE WHEN event_id % 2 = 0 THEN 'projected.tif' ELSE 'points.json' END AS file FROM events WHERE event_id % 3 > 0")
def dispatched_results(spark, sf_dir):
    def each(batch, n):
        kind, out = F.when(F.col("event_id") % 2 == 0, "projected").otherwise("points"), F.when(F.col("event_id") % 3 > 0, "x").otherwise("{}")
        return W.dispatched(batch.select(F.col("event_id").alias("image_id"), kind.alias("output_type"), out.alias("output"))).select("image_id", "file")

    return W.drained_batches(W.event_stream(spark, f"{sf_dir}/events.parquet"), each)


@query("extra_tumbling_window", "SELECT event_type, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day_s, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1, 2")
def tumbling_window(spark, sf_dir):
    """A Spark extra: daily sums by a watermarked window, all batches drained."""
    stream = W.event_stream(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 day")
    sums = stream.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))

    folder = W.work_folder(spark)
    flat = sums.select("event_type", F.unix_timestamp("window.start").alias("day_s"), "n", F.round("value", 2).alias("value"))
    query = flat.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{folder}/rows")).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@query("extra_session_window", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, count(*) AS n, CAST(epoch(date_trunc('second', min(ts))) AS BIGINT) AS start_s FROM s GROUP BY user_id, k")
def session_window(spark, sf_dir):
    """A Spark extra: sessions of a user, parted by gaps of half an hour."""
    rows = derived(spark, sf_dir, "SELECT * FROM events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = rows.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").alias("n"))
    return out.select("user_id", "n", F.unix_timestamp("session_window.start").alias("start_s"))
