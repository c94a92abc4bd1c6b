"""Line deduplication over overlapping windows of three lines.

A line goes when a window of three consecutive lines that holds it also begins earlier, in the
order of (doc_id, line); the first occurrence of each window stays. Overlapping later windows merge
by the union of the line positions that they cover.

Defined cases: null text stays null and empty text empty, both with nothing removed; texts of one
or two lines have no window; windows whose three lines are empty or hold only blanks (the character
20; a tab is text) don't count; rows that share
a doc_id are told apart by their text's hash, and wholly repeated rows count as one document, each
with its result; null ids come last; an empty table gives an empty result. Only the two named
columns are read.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, saved

SPAN = 3


def _windows(rows: DataFrame) -> DataFrame:
    """doc_id, ver, pos and two independent 64-bit hashes of each window of `lines` that isn't blank.

    The lines are a column that the generator passes on, so a text is split once, and element
    access is compiled into the generator's loop.
    """
    part = [F.get(F.col("lines"), F.col("pos") + k) for k in range(SPAN)]
    at = rows.select("doc_id", "ver", "lines", F.posexplode("lines").alias("pos", "line")).filter(F.col("pos") + SPAN <= F.size("lines"))
    blank = F.trim(F.concat(*part)) == ""
    return at.filter(~blank).select("doc_id", "ver", "pos", F.xxhash64(*part).alias("h1"), F.xxhash64(F.lit(1), *part).alias("h2"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text without later occurrences, n_lines, n_removed, removed (line positions from 0).

    Windows move as 36-byte rows. A pre-aggregated minimum finds first occurrences of those that
    occur twice; a join (of which large partitions can be split) marks the later ones.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("ver"))
    lines = F.split(F.col("text"), "\n", -1)
    seen = saved(_windows(base.select("doc_id", "ver", lines.alias("lines"))), "windows")
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("d"), "ver", "pos")
    first = seen.groupBy("h1", "h2").agg(F.min(key).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = seen.join(first, ["h1", "h2"]).filter(key != F.col("first"))
    covered = F.explode(F.sequence(F.col("pos"), F.col("pos") + SPAN - 1)).alias("pos")
    gone = later.select(F.col("doc_id").alias("gone_id"), F.col("ver").alias("gone_ver"), covered).groupBy("gone_id", "gone_ver").agg(F.array_sort(F.collect_set("pos")).alias("removed"))
    out = base.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("ver") == F.col("gone_ver")), "left")
    drop = F.coalesce("removed", F.array().cast("array<int>"))
    # Positions to keep and to drop, as even and odd numbers in order, are a mask for the lines: the
    # work is linear in them but for one sort of whole numbers.
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    mask = F.sort_array(F.concat(F.transform(stay, lambda p: p * 2), F.transform(drop, lambda p: p * 2 + 1)))
    left = F.zip_with(lines, mask, lambda line, p: F.when(p % 2 == 0, line))  # array_join leaves nulls out
    kept = F.when(F.size(drop) == 0, F.col("text")).otherwise(F.array_join(left, "\n"))
    return out.select("doc_id", kept.alias("text"), F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.size(drop).alias("n_removed"), drop.alias("removed"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: lines, removed lines, and the digest of what stays."""
    out = dedup_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.octet_length("text").alias("kept_bytes"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


OP2_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, lines, unnest(range(0, CAST(len(lines) AS BIGINT) - 2)) AS pos FROM d WHERE len(lines) >= 3),
h AS (SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS win FROM w
      WHERE trim(lines[pos + 1] || lines[pos + 2] || lines[pos + 3], ' ') <> ''),
l AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS rn FROM h),
g AS (SELECT DISTINCT doc_id, pos + k AS pos FROM l, (SELECT unnest([0, 1, 2]) AS k) WHERE rn > 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM g GROUP BY doc_id),
x AS (SELECT doc_id, lines, unnest(range(0, CAST(len(lines) AS BIGINT))) AS pos FROM d WHERE text IS NOT NULL),
k AS (SELECT x.doc_id, string_agg(x.lines[x.pos + 1], chr(10) ORDER BY x.pos) AS kept
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.pos = g.pos WHERE g.doc_id IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.lines), 0) AS INT) AS n_lines, CAST(coalesce(n.n_removed, 0) AS INT) AS n_removed,
       CAST(CASE WHEN d.text IS NULL THEN NULL ELSE octet_length(encode(coalesce(k.kept, ''))) END AS INT) AS kept_bytes,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.kept, '')) END AS kept_md5
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""
