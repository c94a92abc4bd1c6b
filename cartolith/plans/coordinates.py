"""Queries on angles, fences, keypoints and fits, from integer arithmetic on keys."""

from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators import keypoints as K
from ..operators import places as P
from ..sources.derived import derived
from .catalog import query

COORDS = """
SELECT l_orderkey AS raster_id, l_linenumber AS seq, CASE WHEN l_linenumber % 2 = 0 THEN 'lat' ELSE 'lon' END AS axis,
       CAST(min(l_partkey) % 40 AS DOUBLE) / 4 + 30 AS degree, CAST(min(l_suppkey) * 17 % 300 AS DOUBLE) AS px, CAST(min(l_suppkey) * 7 % 13 AS DOUBLE) AS py,
       CASE min(l_partkey) % 4 WHEN 0 THEN 'lat_lon' WHEN 1 THEN 'utm' WHEN 2 THEN 'state_plane' ELSE 'geocode' END AS source,
       CASE WHEN min(l_suppkey) % 9 = 0 THEN 'outlier' ELSE 'ok' END AS status, CAST(min(l_partkey) % 16 AS DOUBLE) / 16 AS confidence
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""


def coords(spark, sf_dir):
    return derived(spark, sf_dir, COORDS)


LABELS = """SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN CAST(s_suppkey % 90 AS STRING) || '°' || lpad(CAST(s_suppkey * 7 % 60 AS STRING), 2, '0') || '''' || lpad(CAST(s_suppkey * 11 % 60 AS STRING), 2, '0') || '"'
 WHEN 1 THEN CAST(s_suppkey % 180 AS STRING) || '°' || lpad(CAST(s_suppkey * 7 % 60 AS STRING), 2, '0') || '''' WHEN 2 THEN CAST(s_suppkey % 90 AS STRING) || '°' WHEN 3 THEN CAST(s_suppkey % 90 AS STRING) || '.25' ELSE 'lot of text' END AS label FROM supplier"""


@query("t11_angle_parse", f"""WITH i AS ({LABELS}), x AS (SELECT id, label, regexp_matches(label, '{G.DMS.replace("'", "''")}') AS dms, regexp_matches(label, '{G.DEGREES}') AS deg FROM i)
SELECT id, CASE WHEN dms THEN TRY_CAST(regexp_replace(regexp_extract(label, '{G.DMS.replace("'", "''")}', 1), '[^0-9]', '', 'g') AS DOUBLE) WHEN deg THEN TRY_CAST(regexp_extract(label, '{G.DEGREES}', 1) AS DOUBLE)
  ELSE TRY_CAST(regexp_extract(label, '{G.DECIMAL}', 1) || regexp_extract(label, '{G.DECIMAL}', 2) AS DOUBLE) END AS d,
  CASE WHEN dms THEN TRY_CAST(regexp_replace(regexp_extract(label, '{G.DMS.replace("'", "''")}', 4), '[^0-9]', '', 'g') AS INT) END AS m,
  CASE WHEN dms THEN TRY_CAST(regexp_replace(regexp_extract(label, '{G.DMS.replace("'", "''")}', 5), '[^0-9]', '', 'g') AS INT) END AS s FROM x""")
def angle_parse(spark, sf_dir):
    return derived(spark, sf_dir, LABELS).select("id", G.dms_parts(F.col("label")).alias("p")).select("id", "p.d", "p.m", "p.s")


ANGLES = "SELECT c_custkey AS id, c_custkey % 180 AS d, CASE WHEN c_custkey % 3 > 0 THEN c_custkey * 7 % 60 END AS m, CASE WHEN c_custkey % 3 > 1 THEN c_custkey * 11 % 60 END AS s FROM customer"


@query("t13_dms_degrees", f"SELECT id, round(d + coalesce(m, 0) / 60.0 + coalesce(s, 0) / 3600.0, 6) AS degree FROM ({ANGLES})")
def dms_degrees(spark, sf_dir):
    return derived(spark, sf_dir, ANGLES).select("id", F.round(G.degrees(F.col("d"), F.col("m"), F.col("s")), 6).alias("degree"))


@query("f23_consecutive_numbers", f"SELECT id, coalesce(m = d + 1 AND s = m + 1, FALSE) AS row_of_numbers FROM ({ANGLES})")
def consecutive_numbers(spark, sf_dir):
    return derived(spark, sf_dir, ANGLES).select("id", F.coalesce(G.consecutive(F.col("d"), F.col("m"), F.col("s")), F.lit(False)).alias("row_of_numbers"))


RANGES = "SELECT c_custkey AS id, CAST(c_custkey % 100 - 60 AS DOUBLE) AS low, CAST(c_custkey % 100 - 60 + c_custkey % 37 AS DOUBLE) AS high, CAST(c_custkey % 91 - 30 AS DOUBLE) AS x FROM customer"


@query("m3_absolute_range", f"SELECT id, CASE WHEN low * high < 0 THEN 0.0 ELSE least(abs(low), abs(high)) END AS low, greatest(abs(low), abs(high)) AS high FROM ({RANGES})")
def absolute_range(spark, sf_dir):
    return derived(spark, sf_dir, RANGES).select("id", G.absolute_range(F.col("low"), F.col("high")).alias("r")).select("id", "r.low", "r.high")


@query("f21_value_in_range", f"SELECT id, CASE WHEN low * high >= 0 THEN abs(x) BETWEEN least(abs(low), abs(high)) AND greatest(abs(low), abs(high)) ELSE x BETWEEN low AND high OR x BETWEEN 0 AND abs(high) END AS strict, CASE WHEN low * high >= 0 THEN abs(x) BETWEEN least(abs(low), abs(high)) AND greatest(abs(low), abs(high)) ELSE x BETWEEN low AND high OR x BETWEEN 0 AND greatest(abs(low), abs(high)) END AS loose FROM ({RANGES})")
def value_in_range(spark, sf_dir):
    c = [F.col(n) for n in ("x", "low", "high")]
    return derived(spark, sf_dir, RANGES).select("id", G.in_range(*c).alias("strict"), G.in_range(*c, strict_reference=False).alias("loose"))


@query("f22_in_interval", f"SELECT id, x BETWEEN low AND high AS inside FROM ({RANGES})")
def in_interval(spark, sf_dir):
    return derived(spark, sf_dir, RANGES).select("id", F.col("x").between(F.col("low"), F.col("high")).alias("inside"))


@query("m9_hemisphere", f"SELECT id, CASE WHEN (low + high) / 2 >= 0 THEN 1 ELSE -1 END AS hemi, abs(x) * CASE WHEN (low + high) / 2 >= 0 THEN 1 ELSE -1 END AS signed_x, CASE WHEN x < 0 THEN -1 ELSE 1 END AS sign_x FROM ({RANGES})")
def hemisphere(spark, sf_dir):
    hemi = G.hemisphere(F.col("low"), F.col("high"))
    return derived(spark, sf_dir, RANGES).select("id", hemi.alias("hemi"), G.signed(F.col("x"), hemi).alias("signed_x"), G.sign(F.col("x")).alias("sign_x"))


@query("m2_slope_signs", f"SELECT id, CASE WHEN low < 0 THEN -1 ELSE 1 END AS lon, CASE WHEN x < 0 THEN 1 ELSE -1 END AS lat FROM ({RANGES})")
def slope_signs(spark, sf_dir):
    return derived(spark, sf_dir, RANGES).select("id", G.slope_signs(F.col("low"), F.col("x")).alias("s")).select("id", "s.lon", "s.lat")


TURNS = "SELECT c_custkey AS id, c_custkey * 7 % 360 AS x, c_custkey * 13 % 360 AS a, c_custkey * 29 % 360 AS b FROM customer"


@query("f42_angle_in_range", f"SELECT id, CASE WHEN a <= b THEN x BETWEEN a AND b ELSE x >= a OR x <= b END AS inside FROM ({TURNS})")
def angle_in_range(spark, sf_dir):
    return derived(spark, sf_dir, TURNS).select("id", G.angle_in_range(*(F.col(c) for c in "xab")).alias("inside"))


@query("m29_compass_angle", f"SELECT id, CASE WHEN (360 - x) % 360 > 180 THEN (360 - x) % 360 - 180 ELSE (360 - x) % 360 END AS half, (360 - x) % 360 AS whole FROM ({TURNS})")
def compass_angle(spark, sf_dir):
    return derived(spark, sf_dir, TURNS).select("id", G.compass(F.col("x"), 180).alias("half"), G.compass(F.col("x")).alias("whole"))


SHEETS = "SELECT p_partkey AS id, CAST(p_size * 10 AS DOUBLE) AS dx, CAST(p_size * 10 + p_partkey % 20 AS DOUBLE) AS dy, CAST(p_partkey % 50 * 10000 AS DOUBLE) AS denominator, p_size * 100 + 500 AS w, p_partkey % 977 + 300 AS h, CASE p_partkey % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'ca' ELSE 'au' END AS country, 1900 + p_partkey % 110 AS year, CASE WHEN p_partkey % 7 = 0 THEN 26711 END AS epsg FROM part"


@query("m28_map_scale", f"SELECT id, CASE WHEN (dx + dy) / 2 < 72 THEN 300.0 ELSE (dx + dy) / 2 END AS dpi, round(CASE WHEN denominator > 0 THEN denominator * 2.54e-5 / CASE WHEN (dx + dy) / 2 < 72 THEN 300.0 ELSE (dx + dy) / 2 END ELSE 0 END, 9) AS km_per_pixel FROM ({SHEETS})")
def map_scale(spark, sf_dir):
    dots = G.dpi(F.col("dx"), F.col("dy"))
    return derived(spark, sf_dir, SHEETS).select("id", dots.alias("dpi"), F.round(G.km_per_pixel(F.col("denominator"), dots), 9).alias("km_per_pixel"))


@query("m20_skew_thresholds", f"SELECT id, round(w * sin(radians(20)) / 2, 6) AS sx, round(h * sin(radians(20)) / 2, 6) AS sy FROM ({SHEETS})")
def skew_thresholds(spark, sf_dir):
    return derived(spark, sf_dir, SHEETS).select("id", *[F.round(G.skew_threshold(F.col(c)), 6).alias(n) for c, n in (("w", "sx"), ("h", "sy"))])


@query("t33_reference_system", f"SELECT id, CASE WHEN epsg IS NOT NULL THEN epsg WHEN country IN ('us', 'ca') AND year >= 1990 THEN 4269 WHEN country IN ('us', 'ca') AND year >= 1930 THEN 4267 ELSE 4326 END AS epsg FROM ({SHEETS})")
def reference_system(spark, sf_dir):
    return derived(spark, sf_dir, SHEETS).select("id", G.geographic_code(F.col("epsg"), F.col("country"), F.col("year")).cast("int").alias("epsg"))


@query("f28_nad83_evidence", f"SELECT id, (contains(CASE id % 5 WHEN 0 THEN 'NAD83' ELSE 'NAD27' END, '83') OR (id % 4 = 0) OR year >= 1986) AS nad83 FROM ({SHEETS})")
def nad83_evidence(spark, sf_dir):
    datum = F.when(F.col("id") % 5 == 0, "NAD83").otherwise("NAD27")
    systems = F.when(F.col("id") % 4 == 0, F.array(F.lit("UTM"), F.lit("SP83"))).otherwise(F.array(F.lit("UTM")))
    return derived(spark, sf_dir, SHEETS).select("id", G.evidence_of_nad83(datum, systems, F.col("year")).alias("nad83"))


@query("t16_utm_northing", f"SELECT id, CASE WHEN id % 3 = 0 THEN FALSE WHEN id % 3 = 1 THEN TRUE ELSE denominator * 10 > 834000 END AS northing FROM ({SHEETS})")
def utm_northing(spark, sf_dir):
    letters = F.when(F.col("id") % 3 == 0, "me").when(F.col("id") % 3 == 1, "mn").otherwise("m")
    return derived(spark, sf_dir, SHEETS).select("id", G.is_utm_northing(F.col("denominator") * 10, letters).alias("northing"))


@query("m12_utm_round_trip", "SELECT c_custkey AS id, CAST(floor((c_custkey % 120 - 60.0 + 180) / 6) + 1 AS INT) AS zone, round(c_custkey % 160 - 79.5, 6) AS lat, round(c_custkey % 120 - 60.0, 6) AS lon FROM customer")
def utm_round_trip(spark, sf_dir):
    """Points to UTM and back."""
    p = derived(spark, sf_dir, "SELECT c_custkey AS id, CAST(c_custkey % 160 AS DOUBLE) - 79.5 AS lat, CAST(c_custkey % 120 - 60 AS DOUBLE) AS lon FROM customer").withColumn("zone", G.utm_zone(F.col("lon")))
    u = p.withColumn("u", G.to_utm(F.col("lat"), F.col("lon"), F.col("zone")))
    back = G.from_utm(F.col("u.easting"), F.col("u.northing"), F.col("zone"), F.col("lat") < 0)
    return u.withColumn("b", back).select("id", "zone", F.round("b.lat", 6).alias("lat"), F.round("b.lon", 6).alias("lon"))


BY_AXIS = f"WITH c AS ({COORDS})"


@query("f6_keypoint_count", f"{BY_AXIS} SELECT raster_id, least(count(*) FILTER (WHERE axis = 'lat' AND status = 'ok'), count(*) FILTER (WHERE axis = 'lon' AND status = 'ok')) AS n FROM c GROUP BY raster_id")
def keypoint_count(spark, sf_dir):
    return K.keypoint_count(coords(spark, sf_dir))


@query("f5_needing_more", f"{BY_AXIS} SELECT raster_id FROM c GROUP BY raster_id HAVING least(count(*) FILTER (WHERE axis = 'lat' AND status = 'ok'), count(*) FILTER (WHERE axis = 'lon' AND status = 'ok')) < 2")
def needing_more(spark, sf_dir):
    return K.needing_more(coords(spark, sf_dir))


@query("f7_has_source", f"{BY_AXIS} SELECT raster_id, bool_or(source IN ('utm', 'state_plane')) AS found FROM c GROUP BY raster_id")
def has_source(spark, sf_dir):
    return K.has_source(coords(spark, sf_dir), ["utm", "state_plane"])


@query("f8_by_source", f"{BY_AXIS} SELECT raster_id, seq FROM c WHERE source IN ('lat_lon', 'geocode')")
def by_source(spark, sf_dir):
    return K.by_sources(coords(spark, sf_dir), ["lat_lon", "geocode"]).select("raster_id", "seq")


@query("f9_projection_conflict", f"""{BY_AXIS}, g AS (SELECT raster_id, count(*) FILTER (WHERE source = 'utm') AS nu, count(*) FILTER (WHERE source = 'state_plane') AS ns,
 least(count(*) FILTER (WHERE source = 'utm' AND axis = 'lat'), count(*) FILTER (WHERE source = 'utm' AND axis = 'lon')) AS mu, least(count(*) FILTER (WHERE source = 'state_plane' AND axis = 'lat'), count(*) FILTER (WHERE source = 'state_plane' AND axis = 'lon')) AS ms,
 max(confidence) FILTER (WHERE source = 'utm') AS cu, max(confidence) FILTER (WHERE source = 'state_plane') AS cs FROM c GROUP BY raster_id),
d AS (SELECT raster_id, CASE WHEN nu > 0 AND ns > 0 THEN CASE WHEN mu = 0 THEN 'utm' WHEN ms = 0 THEN 'state_plane' WHEN cu > cs THEN 'state_plane' ELSE 'utm' END END AS loser FROM g)
SELECT c.raster_id, c.seq, c.source FROM c JOIN d USING (raster_id) WHERE d.loser IS NULL OR c.source <> d.loser""")
def projection_conflict(spark, sf_dir):
    return K.without_conflict(coords(spark, sf_dir)).select("raster_id", "seq", "source")


@query("a1_distinct_degrees", f"{BY_AXIS} SELECT raster_id, axis, count(DISTINCT degree) AS n FROM c GROUP BY raster_id, axis")
def distinct_degrees(spark, sf_dir):
    return K.distinct_degrees(coords(spark, sf_dir))


@query("a3_degree_range", f"{BY_AXIS} SELECT raster_id, axis, coalesce(min(-abs(degree)) FILTER (WHERE source IN ('utm', 'lat_lon')), 0.0) AS low, coalesce(max(-abs(degree)) FILTER (WHERE source IN ('utm', 'lat_lon')), 0.0) AS high, count(*) FILTER (WHERE source IN ('utm', 'lat_lon')) AS n FROM c GROUP BY raster_id, axis")
def degree_range(spark, sf_dir):
    return K.degree_range(coords(spark, sf_dir), ["utm", "lat_lon"], negative=True)


@query("a4_source_counts", f"{BY_AXIS} SELECT raster_id, source, CAST(count(*) FILTER (WHERE axis = 'lat') AS STRING) || ';' || CAST(count(*) FILTER (WHERE axis = 'lon') AS STRING) AS summary FROM c GROUP BY raster_id, source")
def source_counts(spark, sf_dir):
    return K.source_counts(coords(spark, sf_dir))


@query("a5_projection_confidence", f"{BY_AXIS}, a AS (SELECT raster_id, axis, product(confidence) * pow(1.1, greatest(count(*) - 2, 0)) AS p FROM c GROUP BY raster_id, axis) SELECT raster_id, round(least(product(p), 1.0), 6) AS confidence FROM a GROUP BY raster_id")
def projection_confidence(spark, sf_dir):
    return K.projection_confidence(coords(spark, sf_dir)).select("raster_id", F.round("confidence", 6).alias("confidence"))


@query("w3_degree_clusters", f"""{BY_AXIS}, g AS (SELECT *, CASE WHEN degree - lag(degree) OVER w > 0.3 THEN 1 ELSE 0 END AS gap FROM c WINDOW w AS (PARTITION BY raster_id ORDER BY degree, seq)),
r AS (SELECT *, sum(gap) OVER (PARTITION BY raster_id ORDER BY degree, seq ROWS UNBOUNDED PRECEDING) AS run FROM g),
s AS (SELECT *, count(*) OVER (PARTITION BY raster_id, run) AS size, min(seq) OVER (PARTITION BY raster_id, run) AS f FROM r)
SELECT raster_id, seq, size AS cluster_size, CAST(CASE WHEN size > 1 THEN dense_rank() OVER (PARTITION BY raster_id ORDER BY size < 2, size DESC, f) - 1 END AS INT) AS cluster FROM s""")
def degree_clusters(spark, sf_dir):
    return K.islands(coords(spark, sf_dir), "degree", 0.3, ["raster_id"]).select("raster_id", "seq", "cluster_size", "cluster")


@query("a9_keypoint_upsert", f"""{BY_AXIS}, m AS (SELECT *, px + CASE WHEN row_number() OVER (PARTITION BY raster_id, axis, degree, px ORDER BY seq) > 1 THEN 1 ELSE 0 END AS key_px FROM c)
SELECT raster_id, axis, degree, key_px, max(seq) AS seq, arg_max(confidence, seq) AS confidence FROM m GROUP BY raster_id, axis, degree, key_px""")
def keypoint_upsert(spark, sf_dir):
    return K.collided(coords(spark, sf_dir)).select("raster_id", "axis", "degree", "key_px", "seq", "confidence")


THRESHOLD = """, md AS (SELECT raster_id, axis, median(degree) AS m FROM c GROUP BY raster_id, axis), dv AS (SELECT c.raster_id, c.axis, abs(degree - m) AS d FROM c JOIN md USING (raster_id, axis)),
th AS (SELECT raster_id, axis, count(*) AS n, CASE WHEN median(d) > 0 THEN median(d) ELSE avg(d) END * CASE WHEN count(*) > 4 THEN greatest(4.0 / count(*), 0.5) ELSE 1 END AS threshold FROM dv GROUP BY raster_id, axis)"""


@query("a16_residual_threshold", f"{BY_AXIS}{THRESHOLD} SELECT raster_id, axis, n, round(threshold, 6) AS threshold FROM th")
def residual_threshold(spark, sf_dir):
    return K.residual_threshold(coords(spark, sf_dir)).select("raster_id", "axis", "n", F.round("threshold", 6).alias("threshold"))


@query("a15_line_inliers", f"""{BY_AXIS}{THRESHOLD},
l AS (SELECT a.raster_id, a.axis, a.seq AS i, b.seq AS j, (b.degree - a.degree) / (b.px - a.px) AS slope, a.degree - (b.degree - a.degree) / (b.px - a.px) * a.px AS start FROM c a JOIN c b ON a.raster_id = b.raster_id AND a.axis = b.axis AND a.seq < b.seq AND a.px <> b.px),
v AS (SELECT l.raster_id, l.axis, l.i, l.j, slope, start, count(*) FILTER (WHERE round(abs(degree - (slope * px + start)), 9) <= round(threshold, 9)) AS votes, round(sum(abs(degree - (slope * px + start))) FILTER (WHERE round(abs(degree - (slope * px + start)), 9) <= round(threshold, 9)), 6) AS rest
      FROM l JOIN c ON l.raster_id = c.raster_id AND l.axis = c.axis JOIN th ON l.raster_id = th.raster_id AND l.axis = th.axis GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raster_id, axis ORDER BY votes DESC, rest, i, j) AS r FROM v) WHERE r = 1)
SELECT c.raster_id, c.seq, coalesce(round(abs(degree - (slope * px + start)), 9) <= round(threshold, 9), TRUE) AS inlier FROM c JOIN th USING (raster_id, axis) LEFT JOIN b ON c.raster_id = b.raster_id AND c.axis = b.axis""")
def line_inliers(spark, sf_dir):
    return K.inliers(coords(spark, sf_dir)).select("raster_id", "seq", "inlier")


@query("f17_confidence_cut", f"{BY_AXIS} SELECT raster_id, seq FROM (SELECT *, rank() OVER (PARTITION BY raster_id ORDER BY confidence DESC) AS r FROM c) WHERE r <= greatest(4 - raster_id % 6, 0)")
def confidence_cut(spark, sf_dir):
    rows = coords(spark, sf_dir)
    return K.confidence_cut(rows, rows.select("raster_id").distinct().withColumn("n", F.col("raster_id") % 6)).select("raster_id", "seq")


@query("w14_degrees_per_pixel", f"""{BY_AXIS}, x AS (SELECT raster_id, axis, first(degree ORDER BY px, seq) AS d0, first(degree ORDER BY px DESC, seq) AS d1, min(px) AS p0, max(px) AS p1 FROM c GROUP BY raster_id, axis)
SELECT raster_id, axis, round(CASE WHEN p1 > p0 THEN (d1 - d0) / (p1 - p0) END, 6) AS per_pixel FROM x""")
def degrees_per_pixel(spark, sf_dir):
    return K.extremes(coords(spark, sf_dir)).select("raster_id", "axis", F.round("per_pixel", 6).alias("per_pixel"))


@query("m23_colinear_keypoints", f"{BY_AXIS}, r AS (SELECT raster_id, axis, regr_slope(py, px) AS slope, count(*) AS n FROM c GROUP BY raster_id, axis) SELECT raster_id, axis, round(slope, 6) AS slope FROM r WHERE n > 1 AND abs(slope) < 0.05 AND NOT isnan(slope)")
def colinear_keypoints(spark, sf_dir):
    return K.colinear(coords(spark, sf_dir)).select("raster_id", "axis", F.round("slope", 6).alias("slope"))


MAPS = "SELECT o_orderkey AS raster_id, o_orderkey % 100 AS x0, o_orderkey % 70 AS y0, o_orderkey % 100 + 1000 AS x1, o_orderkey % 70 + 800 AS y1, CAST(o_custkey % 80 AS DOUBLE) AS centre, 0.25 AS per_pixel FROM orders"


@query("m24_fallback_anchors", f"""WITH m AS ({MAPS}), k AS (SELECT unnest([0, 1, 2, 3]) AS n)
SELECT raster_id, n, CASE WHEN n IN (0, 3) THEN x0 ELSE x1 END + CASE WHEN n >= 2 THEN 1 ELSE 0 END AS px, CASE WHEN n < 2 THEN y0 ELSE y1 END AS py, centre + (CASE WHEN n IN (0, 3) THEN x0 ELSE x1 END - (x0 + x1) / 2) * 0.25::DOUBLE AS degree FROM m, k""")
def fallback_anchors(spark, sf_dir):
    return K.anchors(derived(spark, sf_dir, MAPS).withColumn("per_pixel", F.col("per_pixel").cast("double")))


POINTS = "SELECT l_orderkey AS raster_id, l_linenumber AS seq, CAST(min(l_partkey) % 97 AS DOUBLE) AS x, CAST(min(l_suppkey) % 89 AS DOUBLE) AS y, CAST(min(l_partkey) * 3 % 101 AS DOUBLE) AS z, CAST(min(l_partkey) * 5 % 360 - 180 AS DOUBLE) AS lon, CAST(min(l_suppkey) * 7 % 180 - 90 AS DOUBLE) AS lat FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query("w15_default_hemispheres", f"""WITH p AS ({POINTS}), e AS (SELECT raster_id, first(lon ORDER BY x, seq) AS l, first(lon ORDER BY x DESC, seq) AS r, first(lat ORDER BY y, seq) AS t, first(lat ORDER BY y DESC, seq) AS b FROM p GROUP BY raster_id)
SELECT raster_id, CASE WHEN l < 0 OR l > r THEN -1 ELSE 1 END AS lon_hemi, CASE WHEN t < 0 OR abs(t) < abs(b) THEN -1 ELSE 1 END AS lat_hemi FROM e""")
def default_hemispheres(spark, sf_dir):
    return K.default_hemispheres(derived(spark, sf_dir, POINTS))


def fit_sql(z: str) -> str:
    """SQL of the least squares fit of column z: raster_id, a, b, c."""
    d = {"x": "(x - mx)", "y": "(y - my)", "z": f"({z} - mz)"}
    sums = ", ".join(f"sum({d[p]} * {d[q]}) AS {p}{q}" for p, q in ("xx", "yy", "xy", "xz", "yz"))
    mean = f"SELECT raster_id, avg(x) AS mx, avg(y) AS my, avg({z}) AS mz FROM ({POINTS}) GROUP BY raster_id"
    all_sums = f"SELECT raster_id, any_value(mx) AS mx, any_value(my) AS my, any_value(mz) AS mz, {sums} FROM ({POINTS}) JOIN ({mean}) USING (raster_id) GROUP BY raster_id"
    det = "xx * yy - xy * xy"
    slopes = f"SELECT *, CASE WHEN {det} > 1e-9 * xx * yy THEN (xz * yy - yz * xy) / ({det}) END AS b, CASE WHEN {det} > 1e-9 * xx * yy THEN (yz * xx - xz * xy) / ({det}) END AS c FROM ({all_sums})"
    return f"SELECT raster_id, mz - b * mx - c * my AS a, b, c FROM ({slopes})"


FIT = f"""WITH p AS ({POINTS}), m AS (SELECT raster_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM p GROUP BY raster_id),
s AS (SELECT raster_id, any_value(mx) AS mx, any_value(my) AS my, any_value(mz) AS mz, sum((x - mx) * (x - mx)) AS xx, sum((y - my) * (y - my)) AS yy, sum((x - mx) * (y - my)) AS xy, sum((x - mx) * (z - mz)) AS xz, sum((y - my) * (z - mz)) AS yz FROM p JOIN m USING (raster_id) GROUP BY raster_id),
f AS (SELECT raster_id, mx, my, mz, CASE WHEN xx * yy - xy * xy > 1e-9 * xx * yy THEN (xz * yy - yz * xy) / (xx * yy - xy * xy) END AS b, CASE WHEN xx * yy - xy * xy > 1e-9 * xx * yy THEN (yz * xx - xz * xy) / (xx * yy - xy * xy) END AS c FROM s)"""


@query("a13_polynomial_fit", f"{FIT} SELECT raster_id, round(mz - b * mx - c * my + 1e-7, 4) AS a, round(b + 1e-7, 4) AS b, round(c + 1e-7, 4) AS c FROM f")
def polynomial_fit(spark, sf_dir):
    fit = K.polynomial_fit(derived(spark, sf_dir, POINTS))
    return fit.select("raster_id", *[F.round(F.col(v) + 1e-7, 4).alias(v) for v in "abc"])


@query("m15_clamped_prediction", f"{FIT} SELECT raster_id, seq, CASE WHEN b IS NOT NULL THEN round(greatest(least(mz - b * mx - c * my + b * x + c * y, 90.0), -90.0) + 1e-7, 4) END AS value FROM f JOIN p USING (raster_id)")
def clamped_prediction(spark, sf_dir):
    points = derived(spark, sf_dir, POINTS)
    return K.predicted(points, K.polynomial_fit(points), 90.0).select("raster_id", "seq", F.round(F.col("value") + 1e-7, 4).alias("value"))


PLACES = "SELECT c_nationkey AS map_id, c_custkey % 50 AS place, c_custkey AS seq, CAST(c_custkey * 7 % 360 - 180 AS DOUBLE) AS lon, CAST(c_custkey * 11 % 180 - 90 AS DOUBLE) AS lat, c_custkey * 3 % 40 AS px, c_custkey % 30 AS py FROM customer"
BOUNDS = "SELECT s_nationkey AS map_id, s_suppkey AS seq, CASE s_suppkey % 3 WHEN 0 THEN 'state' WHEN 1 THEN 'country' ELSE 'county' END AS feature, CAST(s_suppkey % 50 - 120 AS DOUBLE) AS lon0, CAST(s_suppkey % 50 - 100 AS DOUBLE) AS lon1, CAST(s_suppkey % 30 AS DOUBLE) AS lat0, CAST(s_suppkey % 30 + 25 AS DOUBLE) AS lat1 FROM supplier"
ENVELOPE = "SELECT map_id, min(lon0) AS lon_min, max(lon1) AS lon_max, min(lat0) AS lat_min, max(lat1) AS lat_max FROM b WHERE feature = '{}' GROUP BY map_id"


@query("a6_place_envelope", f"WITH b AS ({BOUNDS}) {ENVELOPE.format('state')}")
def place_envelope(spark, sf_dir):
    return P.envelope(derived(spark, sf_dir, BOUNDS), "state")


@query("m8_fence_cascade", f"""WITH b AS ({BOUNDS}), st AS ({ENVELOPE.format('state')}), co AS ({ENVELOPE.format('country')})
SELECT n_nationkey AS map_id, coalesce(st.lon_min, co.lon_min, -180.0) AS lon_min, coalesce(st.lon_max, co.lon_max, 180.0) AS lon_max, coalesce(st.lat_min, co.lat_min, -90.0) AS lat_min, coalesce(st.lat_max, co.lat_max, 90.0) AS lat_max,
 CASE WHEN st.map_id IS NOT NULL THEN 0 WHEN co.map_id IS NOT NULL THEN 1 ELSE 2 END AS level FROM nation LEFT JOIN st ON n_nationkey = st.map_id LEFT JOIN co ON n_nationkey = co.map_id""")
def fence_cascade(spark, sf_dir):
    b = derived(spark, sf_dir, BOUNDS)
    return P.fence_cascade(derived(spark, sf_dir, "SELECT n_nationkey AS map_id FROM nation"), P.envelope(b, "state"), P.envelope(b, "country"))


@query("m7_narrowed_fence", f"""WITH b AS ({BOUNDS}), w AS ({ENVELOPE.format('state')}), n AS ({ENVELOPE.format('county')}),
j AS (SELECT w.map_id, w.lon_min AS wl, w.lon_max AS wr, w.lat_min AS wb, w.lat_max AS wt, n.*, coalesce(n.lon_min >= w.lon_min AND n.lon_max <= w.lon_max AND n.lat_min >= w.lat_min AND n.lat_max <= w.lat_max, FALSE) AS fits FROM w LEFT JOIN n ON w.map_id = n.map_id)
SELECT map_id, CASE WHEN fits THEN greatest(least(lon_min, (lon_min + lon_max) / 2 - 15), wl) ELSE wl END AS lon_min, CASE WHEN fits THEN least(greatest(lon_max, (lon_min + lon_max) / 2 + 15), wr) ELSE wr END AS lon_max,
 CASE WHEN fits THEN greatest(least(lat_min, (lat_min + lat_max) / 2 - 15), wb) ELSE wb END AS lat_min, CASE WHEN fits THEN least(greatest(lat_max, (lat_min + lat_max) / 2 + 15), wt) ELSE wt END AS lat_max, fits AS narrowed FROM (SELECT * EXCLUDE (map_id_1) FROM j)""")
def narrowed_fence(spark, sf_dir):
    b = derived(spark, sf_dir, BOUNDS)
    return P.narrowed(P.envelope(b, "county"), P.envelope(b, "state"), 30.0)


FENCES = "SELECT n_nationkey AS map_id, CAST(-n_nationkey * 5 - 20 AS DOUBLE) AS lon_min, CAST(n_nationkey * 5 + 60 AS DOUBLE) AS lon_max, CAST(-40 AS DOUBLE) AS lat_min, CAST(n_nationkey + 40 AS DOUBLE) AS lat_max FROM nation"


@query("f15_fenced_places", f"""WITH p AS ({PLACES}), f AS ({FENCES}) SELECT map_id, place, seq, CAST(row_number() OVER (PARTITION BY map_id, place ORDER BY (lon - (lon_min + lon_max) / 2) * (lon - (lon_min + lon_max) / 2) + (lat - (lat_min + lat_max) / 2) * (lat - (lat_min + lat_max) / 2), seq) AS INT) AS rank
FROM p JOIN f USING (map_id) WHERE lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max""")
def fenced_places(spark, sf_dir):
    return P.fenced(derived(spark, sf_dir, PLACES), derived(spark, sf_dir, FENCES)).select("map_id", "place", "seq", "rank")


@query("a8_common_centre", f"""WITH p AS ({PLACES}), w AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY map_id, place) AS w FROM p), c AS (SELECT *, round(sum(w * lon) OVER m / sum(w) OVER m, 9) AS x, round(sum(w * lat) OVER m / sum(w) OVER m, 9) AS y FROM w WINDOW m AS (PARTITION BY map_id))
SELECT map_id, place, seq, CAST(row_number() OVER (PARTITION BY map_id, place ORDER BY round((lon - x) * (lon - x) + (lat - y) * (lat - y), 6), seq) AS INT) AS rank FROM c""")
def common_centre(spark, sf_dir):
    return P.by_common_centre(derived(spark, sf_dir, PLACES)).select("map_id", "place", "seq", "rank")


@query("u22_place_coordinates", f"""WITH p AS ({PLACES}), f AS (SELECT *, count(*) OVER (PARTITION BY map_id, place) AS n, row_number() OVER (PARTITION BY map_id, place ORDER BY seq) AS r FROM p),
x AS (SELECT *, row_number() OVER (PARTITION BY map_id, px, py ORDER BY seq) AS q FROM f WHERE r = 1) SELECT map_id, place, px, py, abs(lon) AS lon, abs(lat) AS lat, CASE WHEN n > 1 THEN 0.4 ELSE 0.8 END::DOUBLE AS confidence FROM x WHERE q = 1""")
def place_coordinates(spark, sf_dir):
    return P.coordinates(derived(spark, sf_dir, PLACES))
