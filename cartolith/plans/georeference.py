"""Queries on projected labels, corners, control points and whole georeferences."""

from pyspark.sql import functions as F

from ..functions import geo
from ..functions import geodesy as Y
from ..operators import control as C
from ..sources.derived import derived
from .catalog import query
from .coordinates import COORDS

LABELS = """SELECT s_nationkey AS doc_id, s_suppkey AS idx, CASE s_suppkey % 6 WHEN 0 THEN CAST(3 + s_suppkey % 5 AS STRING) || ' ' || CAST(100 + s_suppkey * 7 % 900 AS STRING) || ' ' || CAST(s_suppkey % 10 AS STRING) || '00mN'
 WHEN 1 THEN CAST(100 + s_suppkey * 3 % 700 AS STRING) || CAST(s_suppkey % 10 AS STRING) || '00mE' WHEN 2 THEN 'scale 1:24000' WHEN 3 THEN CAST(200 + s_suppkey AS STRING) || ',' || CAST(s_suppkey % 10 AS STRING) || '00' WHEN 4 THEN 'utm zone 12n' ELSE 'plain text' END AS text FROM supplier"""
PROJ = f"""WITH l AS ({LABELS}), f AS (SELECT *, regexp_extract_all(lower(text), '{C.PROJECTED}', 1) AS v, regexp_extract_all(lower(text), '{C.PROJECTED}', 2) AS n FROM l WHERE NOT regexp_matches(lower(text), 'scale|:')),
p AS (SELECT doc_id, idx, CAST(regexp_replace(v[-1], '[^0-9]', '', 'g') AS DOUBLE) AS value, coalesce(n[-1], '') AS letters FROM f WHERE len(v) > 0),
d AS (SELECT *, CASE WHEN contains(letters, 'e') THEN FALSE WHEN contains(letters, 'n') THEN TRUE ELSE value > 834000 END AS northing FROM p),
g AS (SELECT * FROM d WHERE doc_id NOT IN (SELECT doc_id FROM d WHERE NOT northing AND value >= 833000))"""


def labels(spark, sf_dir):
    return C.projected_labels(derived(spark, sf_dir, LABELS))


@query("t14_projected_labels", f"{PROJ} SELECT doc_id, idx, value, letters FROM p")
def projected_labels(spark, sf_dir):
    return labels(spark, sf_dir)


@query("f26_valid_projections", f"{PROJ} SELECT doc_id, idx, value, northing FROM g")
def valid_projections(spark, sf_dir):
    return C.valid_projections(labels(spark, sf_dir)).select("doc_id", "idx", "value", "northing")


@query("a17_median_projection", f"{PROJ} SELECT doc_id, median(value) FILTER (WHERE NOT northing) AS easting, median(value) FILTER (WHERE northing) AS northing FROM g GROUP BY doc_id")
def median_projection(spark, sf_dir):
    return C.medians(C.valid_projections(labels(spark, sf_dir)))


@query("t34_stated_zone", f"SELECT doc_id, idx, TRY_CAST(nullif(regexp_extract(lower(text), '{C.ZONE}', 1), '') AS INT) AS zone, nullif(regexp_extract(lower(text), '{C.ZONE}', 2), '') AS side FROM ({LABELS})")
def stated_zone(spark, sf_dir):
    return derived(spark, sf_dir, LABELS).select("doc_id", "idx", C.stated_zone(F.col("text")).alias("z")).select("doc_id", "idx", "z.zone", "z.side")


@query("t15_feet_to_metres", f"{PROJ} SELECT doc_id, idx, round(CASE WHEN idx % 2 = 0 THEN value / 3.280839895 ELSE value END, 6) AS metres FROM p")
def feet_to_metres(spark, sf_dir):
    return labels(spark, sf_dir).select("doc_id", "idx", F.round(C.in_metres(F.col("value"), F.col("idx") % 2 == 0), 6).alias("metres"))


VALUES = "SELECT l_orderkey AS doc_id, l_linenumber AS seq, CAST(min(l_partkey) % 7 * 40000 + l_linenumber % 2 * 3000000 AS DOUBLE) AS value, CAST(min(l_suppkey) AS DOUBLE) AS x, CAST(min(l_partkey) % 101 AS DOUBLE) AS y FROM lineitem GROUP BY l_orderkey, l_linenumber"
CLUSTERS = f"""WITH v AS ({VALUES}), g AS (SELECT *, CASE WHEN value - lag(value) OVER (PARTITION BY doc_id ORDER BY value, seq) > 50000 THEN 1 ELSE 0 END AS gap FROM v), r AS (SELECT *, sum(gap) OVER (PARTITION BY doc_id ORDER BY value, seq ROWS UNBOUNDED PRECEDING) AS run FROM g),
s AS (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS size, min(seq) OVER (PARTITION BY doc_id, run) AS f FROM r), c AS (SELECT *, CASE WHEN size > 1 THEN dense_rank() OVER (PARTITION BY doc_id ORDER BY size < 2, size DESC, f) - 1 END AS k FROM s),
w AS (SELECT *, count(*) FILTER (WHERE k IS NULL) OVER (PARTITION BY doc_id) AS lone, max(k) OVER (PARTITION BY doc_id) AS top FROM c), p AS (SELECT *, CAST(CASE WHEN k <= 1 THEN k WHEN k IS NULL AND lone = 1 AND top = 0 THEN 1 END AS INT) AS part FROM w)"""


@query("w4_two_clusters", f"{CLUSTERS} SELECT doc_id, seq, value, part FROM p WHERE part IS NOT NULL")
def two_clusters(spark, sf_dir):
    return C.two_clusters(derived(spark, sf_dir, VALUES)).select("doc_id", "seq", "value", "part")


@query("w6_overlap_direction", f"{CLUSTERS}, q AS (SELECT doc_id, part, seq, abs(x - lag(x) OVER u) AS dx, abs(y - lag(y) OVER u) AS dy FROM p WHERE part IS NOT NULL WINDOW u AS (PARTITION BY doc_id, part, value ORDER BY seq)) SELECT doc_id, part, arg_min(dx < dy, seq) AS is_x FROM q WHERE dx IS NOT NULL GROUP BY doc_id, part")
def overlap_direction(spark, sf_dir):
    return C.overlap_direction(C.two_clusters(derived(spark, sf_dir, VALUES)))


DEGREES = "SELECT l_orderkey AS doc_id, l_linenumber AS seq, CAST(min(l_suppkey) * 40 AS DOUBLE) AS x, CAST(min(l_partkey) % 31 AS DOUBLE) AS y, CAST(min(l_partkey) % 5 * 25 AS DOUBLE) AS degree FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("m40_cluster_axis", f"""WITH d AS ({DEGREES}), f AS (SELECT doc_id, arg_min(degree, seq) AS d FROM d GROUP BY doc_id), s AS (SELECT doc_id, degree, max(x) - min(x) AS dx, max(y) - min(y) AS dy, count(*) AS n, min(seq) AS s FROM d GROUP BY doc_id, degree),
a AS (SELECT doc_id, s, CASE WHEN dx * 0.05 > dy THEN 'lat' WHEN dy * 0.05 > dx THEN 'lon' END AS a FROM s WHERE n > 1), b AS (SELECT doc_id, arg_min(a, s) AS spread FROM a WHERE a IS NOT NULL GROUP BY doc_id)
SELECT f.doc_id, CASE WHEN abs(d) > 90 THEN 'lon' WHEN d BETWEEN 20 AND 60 AND NOT d BETWEEN 50 AND 80 THEN 'lat' WHEN NOT d BETWEEN 20 AND 60 AND d BETWEEN 50 AND 80 THEN 'lon' ELSE spread END AS axis FROM f LEFT JOIN b ON f.doc_id = b.doc_id""")
def cluster_axis(spark, sf_dir):
    return C.cluster_axis(derived(spark, sf_dir, DEGREES), (20.0, 60.0), (50.0, 80.0))


PLACED = "SELECT l_orderkey AS raster_id, l_linenumber AS seq, CASE WHEN l_linenumber % 2 = 0 THEN 'lat' ELSE 'lon' END AS axis, CAST(min(l_partkey) % 90 AS DOUBLE) AS x, CAST(min(l_suppkey) AS DOUBLE) AS y, CAST(min(l_partkey) % 20 + 5 AS DOUBLE) AS width, min(l_partkey) % 5 = 0 AS corner, CAST(min(l_partkey) % 50 AS DOUBLE) / 50 AS confidence FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("j9_corners", f"""WITH c AS ({PLACED}), m AS (SELECT a.raster_id, a.seq AS lon_seq, b.seq AS lat_seq, a.x, b.y, row_number() OVER (PARTITION BY a.raster_id, b.seq ORDER BY a.seq) AS n FROM c a JOIN c b ON a.raster_id = b.raster_id AND a.axis = 'lon' AND b.axis = 'lat' AND abs(a.y - b.y) <= 2 * a.width AND abs(a.x - b.x) <= 2 * b.width)
SELECT raster_id, lon_seq, lat_seq, x, y FROM m WHERE n = 1""")
def corners(spark, sf_dir):
    return C.corners(derived(spark, sf_dir, PLACED))


@query("k2_control_points")
def control_points(spark, sf_dir):
    return C.control_points(derived(spark, sf_dir, PLACED)).select("raster_id", "seq", "x", "y")


ROIS = "SELECT o_orderkey AS raster_id, 10 AS x0, 15 AS y0, 80 AS x1, 85 AS y1, 20 AS margin FROM orders"


@query("k4_empty_quadrants", f"""WITH p AS ({PLACED}), r AS ({ROIS}), q AS (SELECT raster_id, unnest([0, 1, 2, 3]) AS quadrant FROM r), b AS (SELECT DISTINCT raster_id, k AS quadrant FROM p, (SELECT unnest([0, 1, 2, 3]) AS k)
 WHERE CASE WHEN k IN (1, 2) THEN x BETWEEN 45 AND 100 ELSE x BETWEEN -10 AND 45 END AND CASE WHEN k IN (2, 3) THEN y BETWEEN 50 AND 105 ELSE y BETWEEN -5 AND 50 END)
SELECT q.raster_id, q.quadrant, CASE WHEN q.quadrant IN (1, 2) THEN 80 ELSE 10 END AS x, CASE WHEN q.quadrant IN (2, 3) THEN 85 ELSE 15 END AS y FROM q LEFT JOIN b ON q.raster_id = b.raster_id AND q.quadrant = b.quadrant WHERE b.raster_id IS NULL""")
def empty_quadrants(spark, sf_dir):
    return C.empty_quadrants(derived(spark, sf_dir, PLACED), derived(spark, sf_dir, ROIS))


@query("k6_random_points")
def random_points(spark, sf_dir):
    return C.random_points(derived(spark, sf_dir, ROIS), 4)


@query("k1_sampled_places", "SELECT c_nationkey AS map_id, least(count(*), 20) AS n FROM customer GROUP BY c_nationkey")
def sampled_places(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_nationkey AS map_id, c_custkey AS seq FROM customer")
    return C.sampled(rows, 20).groupBy("map_id").agg(F.count("*").alias("n"))


@query("f13_relaxed_filter", f"""WITH c AS ({COORDS}), k AS (SELECT * FROM c WHERE status = 'outlier'), h AS (SELECT raster_id, axis, list(DISTINCT degree) AS have FROM k GROUP BY raster_id, axis), r AS (SELECT c.*, coalesce(have, []) AS have FROM c LEFT JOIN h ON c.raster_id = h.raster_id AND c.axis = h.axis WHERE c.status <> 'outlier'),
b AS (SELECT *, len(list_distinct(list_concat(have, coalesce(list(degree) OVER (PARTITION BY raster_id, axis ORDER BY confidence DESC, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), [])))) AS n FROM r)
SELECT raster_id, seq, confidence, FALSE AS relaxed FROM k UNION ALL SELECT raster_id, seq, confidence / 2, TRUE FROM b WHERE n < 2""")
def relaxed_filter(spark, sf_dir):
    rows = derived(spark, sf_dir, COORDS)
    return C.relaxed(rows.filter("status = 'outlier'"), rows).select("raster_id", "seq", "confidence", "relaxed")


BOXED = "SELECT l_orderkey AS raster_id, l_linenumber AS seq, min(l_partkey) % 200 AS bx0, min(l_suppkey) AS by0, min(l_partkey) % 200 + 20 AS bx1, min(l_suppkey) + 10 AS by1 FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("f12_ring_filter", f"SELECT raster_id, seq FROM ({BOXED}) WHERE bx0 <= 180 AND bx1 >= 20 AND by0 <= 90 AND by1 >= 5 AND NOT (bx0 > 60 AND bx1 < 140 AND by0 > 20 AND by1 < 70)")
def ring_filter(spark, sf_dir):
    roi = derived(spark, sf_dir, "SELECT o_orderkey AS raster_id, 20 AS ox0, 5 AS oy0, 180 AS ox1, 90 AS oy1, 60 AS ix0, 20 AS iy0, 140 AS ix1, 70 AS iy1 FROM orders")
    return C.in_ring(derived(spark, sf_dir, BOXED), roi).select("raster_id", "seq")


CENTRES = "SELECT c_custkey AS id, CAST(c_custkey % 120 - 60 AS DOUBLE) AS lat, CAST(c_custkey % 300 - 150 AS DOUBLE) AS lon FROM customer"


@query("m5_degree_span", f"SELECT id, round(slon, 6) AS lon, round(slat, 6) AS lat FROM ({Y.span_sql(f'({CENTRES})', 350.0)})")
def degree_span(spark, sf_dir):
    return derived(spark, sf_dir, CENTRES).select("id", Y.degree_span(F.col("lat"), F.col("lon"), 700.0).alias("s")).select("id", F.round("s.lon", 6).alias("lon"), F.round("s.lat", 6).alias("lat"))


@query("m11_degrees_per_km", f"SELECT id, round(slon, 9) AS lon, round(slat, 9) AS lat FROM ({Y.span_sql(f'({CENTRES})', 1.0)})")
def degrees_per_km(spark, sf_dir):
    return derived(spark, sf_dir, CENTRES).select("id", Y.degrees_per_km(F.col("lat"), F.col("lon")).alias("s")).select("id", F.round("s.lon", 9).alias("lon"), F.round("s.lat", 9).alias("lat"))


@query("m6_clue_point_fence", f"SELECT id, round(lon - slon, 6) AS lon_min, round(lon + slon, 6) AS lon_max, round(lat - slat, 6) AS lat_min, round(lat + slat, 6) AS lat_max FROM ({Y.span_sql(f'({CENTRES})', 250.0)})")
def clue_point_fence(spark, sf_dir):
    """A fence around a point: the degree span of 500 km, both ways."""
    rows = derived(spark, sf_dir, CENTRES).withColumn("s", Y.degree_span(F.col("lat"), F.col("lon"), 500.0))
    return rows.select("id", *[F.round(F.col(c) + k * F.col("s")[c], 6).alias(f"{c}_{n}") for c in ("lon", "lat") for k, n in ((-1, "min"), (1, "max"))])


ZONE = (34.033, 35.467, 33.5, -118.0, 2_000_000.0, 500_000.0)
NEAR = "SELECT c_custkey AS id, CAST(c_custkey % 30 AS DOUBLE) / 10 + 33 AS lat, CAST(c_custkey % 50 AS DOUBLE) / 10 - 120 AS lon FROM customer"


@query("m13_state_plane", "SELECT id, round({}, 3) AS easting, round({}, 3) AS northing FROM ({})".format(*Y.conic_sql(*ZONE), NEAR))
def state_plane(spark, sf_dir):
    """Points near a conic zone (its parallels 34.0 and 35.5 north) in its metres."""
    rows = derived(spark, sf_dir, NEAR)
    out = Y.to_conic(F.col("lat"), F.col("lon"), *ZONE)
    return rows.select("id", out.alias("p")).select("id", F.round("p.easting", 3).alias("easting"), F.round("p.northing", 3).alias("northing"))


@query("o5_georeference")
def georeference(spark, sf_dir):
    """The middle of every map and its corners, georeferenced from its keypoints."""
    coords = derived(spark, sf_dir, COORDS)
    maps = coords.select("raster_id").distinct()
    at = F.explode(F.array(*[F.struct(F.lit(n).alias("seq"), F.lit(x).alias("x"), F.lit(y).alias("y")) for n, (x, y) in enumerate(((150.0, 6.0), (0.0, 0.0), (300.0, 13.0)))])).alias("p")
    points = maps.select("raster_id", at).select("raster_id", "p.*")
    fences = maps.select("raster_id", F.lit(-120.0).alias("lon_min"), F.lit(-70.0).alias("lon_max"), F.lit(25.0).alias("lat_min"), F.lit(50.0).alias("lat_max"))
    return C.georeferenced(points, coords, fences).select("raster_id", "seq", *[F.round(c, 5).alias(c) for c in ("lon", "lat", "confidence")])


@query("m17_signed_coordinates", f"SELECT id, abs(lat) * CASE WHEN lat >= 0 THEN 1 ELSE -1 END AS lat, abs(lon) * CASE WHEN lon >= 0 THEN 1 ELSE -1 END AS lon FROM ({CENTRES})")
def signed_coordinates(spark, sf_dir):
    return derived(spark, sf_dir, CENTRES).select("id", *[geo.signed(F.col(c), geo.hemisphere(F.col(c), F.col(c))).alias(c) for c in ("lat", "lon")])


@query("j16_zone_lookup", """WITH z AS (SELECT n_nationkey AS zone, n_nationkey * 6 % 40 - 20 AS lat0, n_nationkey * 11 % 100 - 50 AS lon0 FROM nation), c AS (SELECT c_custkey AS id, CAST(c_custkey % 80 - 40 AS DOUBLE) AS lat, CAST(c_custkey * 7 % 160 - 80 AS DOUBLE) AS lon FROM customer)
SELECT id, lpad(CAST(min(zone) AS STRING), 4, '0') AS fips FROM c JOIN z ON lat BETWEEN lat0 AND lat0 + 15 AND lon BETWEEN lon0 AND lon0 + 30 GROUP BY id""")
def zone_lookup(spark, sf_dir):
    """The first zone whose polygon holds a point."""
    from ..functions import geometry as G

    zones = derived(spark, sf_dir, "SELECT n_nationkey AS zone, n_nationkey * 11 % 100 - 50 AS x0, n_nationkey * 6 % 40 - 20 AS y0, n_nationkey * 11 % 100 - 20 AS x1, n_nationkey * 6 % 40 - 5 AS y1 FROM nation")
    zones = zones.select("zone", G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias("b")).withColumn("ring", G.ring_of(F.col("b")))
    points = derived(spark, sf_dir, "SELECT c_custkey AS id, CAST(c_custkey % 80 - 40 AS DOUBLE) AS lat, CAST(c_custkey * 7 % 160 - 80 AS DOUBLE) AS lon FROM customer")
    met = points.join(zones, F.col("lon").between(F.col("b.x0"), F.col("b.x1")) & F.col("lat").between(F.col("b.y0"), F.col("b.y1"))).filter(G.point_in_ring(F.col("lon"), F.col("lat"), F.col("ring")))
    return met.groupBy("id").agg(F.lpad(F.min("zone").cast("string"), 4, "0").alias("fips"))
