"""Queries on text boxes and regions derived from documents."""

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..operators import segments as S
from ..sources.derived import derived
from ..sources.tables import table
from .catalog import query

#: A text box for each line of a document, laid out by integer arithmetic.
OCR_SQL = """
SELECT doc_id, idx, text, (doc_id * 37 + idx * 11) % 4000 AS x0, idx * 50 AS y0,
       (doc_id * 37 + idx * 11) % 4000 + length(text) * 2 + 1 AS x1, idx * 50 + 24 AS y1
FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx, unnest(string_split(text, chr(10))) AS text FROM documents)
"""

#: Three regions for each document.
SEGMENT_SQL = """
SELECT doc_id, k AS seq, CASE k WHEN 0 THEN 'cross_section' WHEN 1 THEN 'legend_points_lines' ELSE 'map' END AS class_label,
       k * 900 + doc_id % 500 AS x0, k * 100 AS y0, k * 900 + doc_id % 500 + 1800 AS x1, k * 100 + 400 AS y1
FROM documents CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) AS ks
"""


def box():
    return G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias("box")

CLASSES = ["cross_section", "legend_points_lines", "map"]


def ocr(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))
    x0, y0 = (F.col("doc_id") * 37 + F.col("idx") * 11) % 4000, F.col("idx") * 50
    return docs.select("doc_id", "idx", "text", G.box(x0, y0, x0 + F.length("text") * 2 + 1, y0 + 24).alias("box"))


def regions(spark, sf_dir):
    return derived(spark, sf_dir, SEGMENT_SQL).select("doc_id", "seq", "class_label", box())


FILTERED = f"""
WITH ocr AS ({OCR_SQL}), seg AS ({SEGMENT_SQL}),
hit AS (SELECT o.doc_id, o.idx, o.text, s.class_label, (o.x0 >= s.x0 AND o.x1 <= s.x1 AND o.y0 >= s.y0 AND o.y1 <= s.y1) AS inside,
               (o.x0 <= s.x1 AND o.x1 >= s.x0 AND o.y0 <= s.y1 AND o.y1 >= s.y0) AS meets FROM ocr o JOIN seg s ON o.doc_id = s.doc_id),
cnt AS (SELECT *, sum(CASE WHEN inside THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, class_label) AS words FROM hit)
"""


@query(
    "f20_text_filter_exclude",
    FILTERED
    + """, keep AS (SELECT doc_id, idx, text FROM cnt GROUP BY doc_id, idx, text HAVING bool_or(NOT inside OR (words > 0 AND words < 3)))
SELECT doc_id, text, min(idx) AS first_idx, max(idx) AS last_idx FROM keep GROUP BY doc_id, text""",
)
def text_filter_exclude(spark, sf_dir):
    out = S.text_filter(ocr(spark, sf_dir), regions(spark, sf_dir), CLASSES, threshold=3)
    return out.select("doc_id", "text", F.col("idx").alias("first_idx"), F.col("last_idx"))


@query(
    "f20_text_filter_include",
    FILTERED
    + """, keep AS (SELECT doc_id, idx, text FROM cnt GROUP BY doc_id, idx, text HAVING bool_or(meets))
SELECT doc_id, text, min(idx) AS first_idx, max(idx) AS last_idx FROM keep GROUP BY doc_id, text""",
)
def text_filter_include(spark, sf_dir):
    out = S.text_filter(ocr(spark, sf_dir), regions(spark, sf_dir), CLASSES, include=True)
    return out.select("doc_id", "text", F.col("idx").alias("first_idx"), "last_idx")


@query("a10_text_dedup", f"SELECT doc_id, text, min(idx) AS first_idx, max(idx) AS last_idx, arg_max(x0, idx) AS last_x0 FROM ({OCR_SQL}) GROUP BY doc_id, text")
def text_dedup(spark, sf_dir):
    out = S.deduplicated(ocr(spark, sf_dir))
    return out.select("doc_id", "text", F.col("idx").alias("first_idx"), "last_idx", F.col("box.x0").alias("last_x0"))


@query("f1_readable_text", f"SELECT doc_id, idx, text FROM ({OCR_SQL}) WHERE regexp_matches(split_part(text, chr(10), 1), '[a-zA-Z]') AND length(text) BETWEEN 4 AND 600 AND len(string_split(text, ' ')) > 1")
def readable_text(spark, sf_dir):
    return ocr(spark, sf_dir).filter(T.readable_first_line(F.col("text"), 600)).select("doc_id", "idx", "text")


@query(
    "f2_token_budget",
    f"""WITH o AS ({OCR_SQL}), b AS (SELECT unnest([600, 500, 400, 300, 200]) AS most),
s AS (SELECT doc_id, most, sum(CASE WHEN regexp_matches(text, '[a-zA-Z]') AND length(text) BETWEEN 4 AND most AND len(string_split(text, ' ')) > 1 THEN CAST(ceil(length(text) / 4.0) AS BIGINT) ELSE 0 END) AS tokens FROM o, b GROUP BY doc_id, most)
SELECT doc_id, coalesce(max(CASE WHEN tokens <= 350 THEN most END), 200) AS max_len, CAST(coalesce(arg_max(tokens, most) FILTER (WHERE tokens <= 350), max(CASE WHEN most = 200 THEN tokens END)) AS BIGINT) AS tokens FROM s GROUP BY doc_id""",
)
def token_budget(spark, sf_dir):
    """The longest text limit whose texts fit a budget; the smallest limit if none does."""
    tries = ocr(spark, sf_dir).select("doc_id", "text", F.explode(F.sequence(F.lit(600), F.lit(200), F.lit(-100))).alias("most"))
    fits = F.when(T.readable_first_line(F.col("text"), F.col("most")), F.ceil(F.length("text") / 4)).otherwise(0)
    sums = tries.groupBy("doc_id", "most").agg(F.sum(fits).alias("tokens"))
    ok = F.col("tokens") <= 350
    best = F.max(F.when(ok, F.struct("most", "tokens")))
    last = F.max(F.when(F.col("most") == 200, F.struct("most", "tokens")))
    return sums.groupBy("doc_id").agg(F.coalesce(best, last).alias("b")).select("doc_id", F.col("b.most").alias("max_len"), F.col("b.tokens").cast("long").alias("tokens"))


@query("t26_text_index", f"SELECT doc_id, '(' || text || ', ' || CAST(idx AS STRING) || ')' AS entry FROM ({OCR_SQL})")
def text_index(spark, sf_dir):
    return ocr(spark, sf_dir).select("doc_id", F.format_string("(%s, %d)", "text", F.col("idx").cast("long")).alias("entry"))


@query("t27_text_list", f"SELECT doc_id, string_agg('(' || text || ', ' || CAST(idx AS STRING) || ')', chr(10) ORDER BY idx) AS entries FROM ({OCR_SQL}) GROUP BY doc_id")
def text_list(spark, sf_dir):
    entry = F.format_string("(%s, %d)", "text", F.col("idx").cast("long"))
    rows = F.array_sort(F.collect_list(F.struct("idx", entry.alias("e"))))
    return ocr(spark, sf_dir).groupBy("doc_id").agg(F.array_join(F.transform(rows, lambda r: r["e"]), "\n").alias("entries"))


RANKABLE = """
SELECT o_custkey AS doc_id, o_orderkey AS seq, CASE o_orderkey % 4 WHEN 0 THEN 'map' WHEN 1 THEN 'legend_points_lines' WHEN 2 THEN 'cross_section' ELSE 'unknown' END AS class_label,
       CAST(o_orderkey % 100 AS DOUBLE) / 100 AS confidence, CAST(o_orderkey % 977 + 1 AS DOUBLE) AS area FROM orders
"""


@query("w1_rank_segments", f"SELECT doc_id, seq, class_label, CAST(row_number() OVER (PARTITION BY doc_id, class_label ORDER BY confidence * sqrt(area) DESC, seq) AS INT) AS rank FROM ({RANKABLE}) WHERE class_label <> 'unknown'")
def rank_segments(spark, sf_dir):
    return S.ranked(derived(spark, sf_dir, RANKABLE), CLASSES).select("doc_id", "seq", "class_label", "rank")


@query("w2_top_segments", f"SELECT doc_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence * sqrt(area) DESC, seq) AS r FROM ({RANKABLE}) WHERE class_label = 'map') WHERE r <= 2")
def top_segments(spark, sf_dir):
    return S.top_regions(derived(spark, sf_dir, RANKABLE), "map", 2).select("doc_id", "seq")


@query("f29_denoise_segments", f"SELECT doc_id, seq, class_label, confidence FROM (SELECT *, least(0.75, first_value(confidence) OVER (PARTITION BY doc_id, class_label ORDER BY seq)) AS cut FROM ({RANKABLE})) WHERE confidence >= cut")
def denoise_segments(spark, sf_dir):
    return S.denoised(derived(spark, sf_dir, RANKABLE)).select("doc_id", "seq", "class_label", "confidence")


@query("f3_map_missing", f"SELECT c_custkey AS doc_id FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM ({RANKABLE}) WHERE class_label = 'map')")
def map_missing(spark, sf_dir):
    return S.without_map(derived(spark, sf_dir, "SELECT c_custkey AS doc_id FROM customer"), derived(spark, sf_dir, RANKABLE))


@query(
    "j5_text_with_segments",
    f"""WITH o AS ({OCR_SQL}), s AS ({SEGMENT_SQL}),
f AS (SELECT o.doc_id, o.idx, any_value(o.text) AS text, min(s.seq) AS seq FROM o JOIN s ON o.doc_id = s.doc_id AND o.x0 <= s.x1 AND o.x1 >= s.x0 AND o.y0 <= s.y1 AND o.y1 >= s.y0 WHERE s.class_label = 'legend_points_lines' GROUP BY o.doc_id, o.idx)
SELECT doc_id, seq, count(*) AS n_texts, string_agg(text, ' ' ORDER BY idx) || ' ' AS text FROM f GROUP BY doc_id, seq""",
)
def text_with_segments(spark, sf_dir):
    return S.text_by_region(ocr(spark, sf_dir), regions(spark, sf_dir), "legend_points_lines")


@query("j6_box_index_join", f"WITH o AS ({OCR_SQL}), s AS ({SEGMENT_SQL}) SELECT o.doc_id, o.idx, s.seq FROM o JOIN s ON o.doc_id = s.doc_id AND o.x0 <= s.x1 AND o.x1 >= s.x0 AND o.y0 <= s.y1 AND o.y1 >= s.y0")
def box_index_join(spark, sf_dir):
    return S.box_join(ocr(spark, sf_dir), regions(spark, sf_dir), "doc_id").select("doc_id", "idx", F.col("r_seq").alias("seq"))


SYMBOLS = """
SELECT l_orderkey AS raster_id, l_linenumber AS seq, l_partkey % 40 * 20 AS x0, l_suppkey % 40 * 20 AS y0, l_partkey % 40 * 20 + 90 AS x1, l_suppkey % 40 * 20 + 90 AS y1,
       l_partkey % 97 AS dip FROM lineitem
"""


@query(
    "j7_nearest_dip",
    f"""WITH p AS ({SYMBOLS}), t AS (SELECT raster_id, seq AS idx, x0 + 13 AS x0, y0 + 7 AS y0, x0 + 43 AS x1, y0 + 27 AS y1, dip FROM ({SYMBOLS}) WHERE dip <= 90),
m AS (SELECT p.raster_id, p.seq, t.dip, row_number() OVER (PARTITION BY p.raster_id, p.seq ORDER BY pow((p.x0 + p.x1) / 2.0 - (t.x0 + t.x1) / 2.0, 2) + pow((p.y0 + p.y1) / 2.0 - (t.y0 + t.y1) / 2.0, 2), t.idx, t.dip) AS r
      FROM p JOIN t ON p.raster_id = t.raster_id AND p.x0 <= t.x1 AND p.x1 >= t.x0 AND p.y0 <= t.y1 AND p.y1 >= t.y0)
SELECT raster_id, seq, dip FROM m WHERE r = 1""",
)
def nearest_dip(spark, sf_dir):
    """A symbol's dip: of the numbers up to 90 that its box meets, the one with the nearest centre."""
    rows = derived(spark, sf_dir, SYMBOLS)
    texts = rows.filter("dip <= 90").select("raster_id", F.col("seq").alias("idx"), G.box(F.col("x0") + 13, F.col("y0") + 7, F.col("x0") + 43, F.col("y0") + 27).alias("box"), "dip")
    return S.nearest_in_box(rows.select("raster_id", "seq", box()), texts, "raster_id", "dip")


@query("documents_by_source", "SELECT source, lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY source, lang")
def documents_by_source(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))
