"""Queries on file formats, from lines made of the flat tables, and on plug-in seams."""

from pyspark.sql import functions as F

from ..operators import plugins as U
from ..sources import readers as S
from ..sources.derived import derived
from .catalog import query

POINT_LINES = """SELECT CAST(s_nationkey AS STRING) AS file, s_suppkey AS seq, CASE s_suppkey % 9 WHEN 0 THEN 'raster_ID,row,col,NAD83_x,NAD83_y' WHEN 1 THEN 'short,1' WHEN 2 THEN 'm' || CAST(s_nationkey AS STRING) || ',' || CAST(s_suppkey AS STRING) || '.7,5.2'
 ELSE 'm' || CAST(s_nationkey AS STRING) || ',' || CAST(s_suppkey AS STRING) || ',' || CAST(s_suppkey * 3 AS STRING) || ',' || CAST(s_suppkey % 4 AS STRING) || '.5,' || CASE WHEN s_suppkey % 5 = 0 THEN '0' ELSE '40.25' END END AS line FROM supplier"""


@query("s22_query_points", f"""WITH l AS (SELECT *, string_split(line, ',') AS p FROM ({POINT_LINES}) WHERE NOT starts_with(line, 'raster_')), n AS (SELECT *, CAST(trunc(TRY_CAST(p[2] AS DOUBLE)) AS INT) AS y, CAST(trunc(TRY_CAST(p[3] AS DOUBLE)) AS INT) AS x FROM l WHERE len(p) >= 3),
e AS (SELECT *, min(CASE WHEN x >= 240 OR y >= 90 THEN seq END) OVER (PARTITION BY file) AS stop FROM n)
SELECT file, seq, p[1] AS raster_id, x, y, CASE WHEN len(p) >= 5 AND TRY_CAST(p[4] AS DOUBLE) <> 0 AND TRY_CAST(p[5] AS DOUBLE) <> 0 THEN TRY_CAST(p[4] AS DOUBLE) END AS lon, CASE WHEN len(p) >= 5 AND TRY_CAST(p[4] AS DOUBLE) <> 0 AND TRY_CAST(p[5] AS DOUBLE) <> 0 THEN TRY_CAST(p[5] AS DOUBLE) END AS lat FROM e WHERE stop IS NULL OR seq < stop""")
def query_points(spark, sf_dir):
    return S.query_points(derived(spark, sf_dir, POINT_LINES), F.lit(240), F.lit(90))


@query("s19_first_and_last", "SELECT s_nationkey AS state, s_suppkey % 3 AS zone, arg_min(s_name, s_suppkey) AS first, arg_max(s_name, s_suppkey) AS last FROM supplier GROUP BY 1, 2")
def first_and_last(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT s_nationkey AS state, s_suppkey % 3 AS zone, s_name, s_suppkey AS seq FROM supplier")
    return S.first_and_last(rows, ["state", "zone"], "s_name")


@query("s23_default_fences", "SELECT n_nationkey AS id, CASE n_nationkey % 3 WHEN 0 THEN -180.0 ELSE -180.0 END AS lon_min, CASE n_nationkey % 3 WHEN 0 THEN -66.0 ELSE 180.0 END AS lon_max, CASE n_nationkey % 3 WHEN 0 THEN 18.0 ELSE -90.0 END AS lat_min FROM nation")
def default_fences(spark, sf_dir):
    region = F.when(F.col("id") % 3 == 0, "US").when(F.col("id") % 3 == 1, "world").otherwise("atlantis")
    return derived(spark, sf_dir, "SELECT n_nationkey AS id FROM nation").select("id", S.default_fence(region).alias("f")).select("id", "f.lon_min", "f.lon_max", "f.lat_min")


JSON_LINES = "SELECT c_custkey AS seq, '{\"map_id\":\"m' || CAST(c_custkey % 400 AS STRING) || '\",\"title\":\"' || c_name || '\"' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',\"year\":\"19' || CAST(c_custkey % 90 + 10 AS STRING) || '\"' END || '}' AS line FROM customer"


@query("s30_truth_records", "SELECT 'm' || CAST(c_custkey % 400 AS STRING) AS map_id, arg_max(c_name, c_custkey) AS title, arg_max(coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '19' || CAST(c_custkey % 90 + 10 AS STRING) END, 'NULL'), c_custkey) AS year FROM customer GROUP BY 1")
def truth_records(spark, sf_dir):
    out = S.truth(derived(spark, sf_dir, JSON_LINES), "map_id string, title string, year string")
    return out.withColumn("year", F.coalesce("year", F.lit("NULL")))


@query("s31_sorted_lines", "SELECT CAST(row_number() OVER (ORDER BY c_custkey * 7 % 1009, c_custkey) AS INT) AS place, CAST(c_custkey * 7 % 1009 AS INT) AS key FROM customer")
def sorted_lines(spark, sf_dir):
    from pyspark.sql import Window

    rows = derived(spark, sf_dir, "SELECT c_custkey AS seq, '{\"' || CAST(c_custkey * 7 % 1009 AS STRING) || '\": {\"a\": 1}}' AS line FROM customer")
    # A report of one file: its lines are numbered in one task, as they are written in order.
    return S.by_first_key(rows).select(F.row_number().over(Window.orderBy("key", "seq")).alias("place"), "key")


@query("s40_xml_tables", "SELECT s_suppkey AS doc_id, CAST(k AS INT) AS n, CAST(s_suppkey + k AS STRING) || ',1 2,3' AS points FROM supplier, (SELECT unnest([0, 1]) AS k)")
def xml_tables(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT s_suppkey AS doc_id, '<document><table><Coords points=\"' || CAST(s_suppkey AS STRING) || ',1 2,3\"/></table><table><Coords points=\"' || CAST(s_suppkey + 1 AS STRING) || ',1 2,3\"/></table></document>' AS xml FROM supplier")
    return S.tables_of(rows)


@query("s41_result_xml", """WITH b AS (SELECT l_orderkey AS image_id, l_linenumber AS seq, min(l_partkey) % 100 AS x0, min(l_suppkey) AS y0, min(l_discount) * 10 AS score FROM lineitem GROUP BY 1, 2),
t AS (SELECT image_id, seq, '<table><Coords points="' || x0::STRING || ',' || y0::STRING || ' ' || x0::STRING || ',' || (y0 + 30)::STRING || ' ' || (x0 + 20)::STRING || ',' || (y0 + 30)::STRING || ' ' || (x0 + 20)::STRING || ',' || y0::STRING || '"/></table>' AS t FROM b WHERE score >= 0.7)
SELECT image_id, '<document>' || string_agg(t, '' ORDER BY seq) || '</document>' AS xml FROM t GROUP BY image_id""")
def result_xml(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT l_orderkey AS image_id, l_linenumber AS seq, min(l_partkey) % 100 AS x0, min(l_suppkey) AS y0, min(l_partkey) % 100 + 20 AS x1, min(l_suppkey) + 30 AS y1, min(l_discount) * 10 AS score FROM lineitem GROUP BY l_orderkey, l_linenumber")
    return S.result_xml(rows)


@query("s24_unquoted_lines", "SELECT CAST(s_suppkey AS STRING) || ',' || s_name || ',' || CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE CAST(s_nationkey AS STRING) END AS line FROM supplier")
def unquoted_lines(spark, sf_dir):
    return S.unquoted_lines(derived(spark, sf_dir, "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_nationkey END AS n FROM supplier"))


@query("s4_image_magic", "SELECT s_suppkey AS id, s_suppkey % 3 < 2 AS image FROM supplier")
def image_magic(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT s_suppkey AS id FROM supplier")
    head = F.when(F.col("id") % 3 == 0, F.unhex(F.lit("89504E470D0A"))).when(F.col("id") % 3 == 1, F.unhex(F.lit("49492A0008"))).otherwise(F.lit("text").cast("binary"))
    return rows.select("id", S.is_image(head).alias("image"))


@query("u11_plugged_extractor", "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'cached' ELSE upper(p_name) END AS text FROM part")
def plugged_extractor(spark, sf_dir):
    """A stand-in recogniser behind the cache: only keys that the cache lacks reach it."""
    rows = derived(spark, sf_dir, "SELECT p_partkey AS id, p_name FROM part")
    cache = rows.filter("id % 3 = 0").select("id", F.lit("cached").alias("text"))
    return U.cached(rows, cache, "id", lambda: lambda b: b.assign(text=b["p_name"].str.upper())[["id", "text"]], "id long, text string")
