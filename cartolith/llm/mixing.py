"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a target number of words; whole passes over the source are taken as often as they
fit, and the rest by a threshold on a hash of the document: documents are ordered by hash, and
those whose middle lies below the rest's words are taken once more. The threshold is found without
sorting: words are summed by source and hash bucket, the bucket that the threshold falls into is
the only one to be summed again with finer buckets, and so on, until it holds one hash. Thresholds
nest: a larger budget takes all that a smaller one does.

Defined cases: null text counts no words; null source is a source of its own, the last by order;
the hash is of doc_id and, for null ids, of the text; rows of equal hash go by a hash of the text,
and rows equal in both by their place in the written table: which of them is taken is all one, how
many isn't; a source without words takes nothing; an empty table gives an empty result. Only the
named columns are read.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, load, saved

#: Bits of a key that one level of the histogram resolves, and all of them (15 hex digits of md5).
STEP, BITS = 10, 60


def hash60(*cols: Column) -> Column:
    """60 bits of md5: the same number in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: `share` of all words by weight, no target above `most` times
    its source; what is cut off goes to the others by weight.

    `sources` has a row a source (source, source_size); sources are dealt weights in code point
    order, null last. The level L with sum(min(most * size, L * weight)) = share * total is found
    by one ordered pass: sources reach their limits in order of limit / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("weight", F.get(cycle, ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * F.lit(float(most))
    by_limit = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    until = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(float(share)) * F.col("total") - F.coalesce(F.sum("limit").over(until), F.lit(0.0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(until), F.lit(0.0)))
    rows = (
        ranked.withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("level", level)
        .withColumn("full", F.col("ratio") <= F.col("level"))
    )
    # The level that holds is that of the first source which isn't full.
    held = F.min(F.when(~F.col("full"), F.struct("ratio", "level"))).over(every)["level"]
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least("limit", held * F.col("weight")))
    return rows.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "source_size", "target")


def thresholds(thin: DataFrame, goals: DataFrame) -> DataFrame:
    """source, source_size, target, passes, t1, t2, t3: rows whose keys (k1, k2, k3) come before these
    three are taken once more.

    goals: source, source_size, target. Each level is one pre-aggregated sum of at most 1024
    buckets a source, read from the written thin table; only rows of the boundary buckets count.
    Only where a bucket holds several rows of one key does the search go on by the next key, so
    rows that share an id, or all three columns, are told apart at the boundary.
    """
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    zero = F.lit(0).cast("long")
    state = goals.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * size)
    # The span under search: 2^bits values of key `phase` from `low` on, below which lie `below`
    # words; f1 and f2 are the earlier keys' values.
    state = state.select("*", F.lit(0).alias("phase"), F.lit(BITS).alias("bits"), zero.alias("low"), zero.alias("below"), zero.alias("f1"), zero.alias("f2"), F.lit(True).alias("open"))
    while True:
        state = saved(state, "state")
        held = state.filter("open").select(F.col("source").alias("s"), "rest", "low", "below", "phase", "bits", "f1", "f2")
        if not held.head(1):
            break
        key = F.when(F.col("phase") == 0, F.col("k1")).when(F.col("phase") == 1, F.col("k2")).otherwise(F.col("k3"))
        fixed = ((F.col("phase") < 1) | (F.col("k1") == F.col("f1"))) & ((F.col("phase") < 2) | (F.col("k2") == F.col("f2")))
        rows = thin.join(broadcast_if_small(held), F.col("source").eqNullSafe(F.col("s")) & fixed).withColumn("key", key)
        rows = rows.filter((F.col("key") >= F.col("low")) & (F.expr("shiftright(key - low, bits)") == 0))
        of = ("source", "rest", "low", "below", "phase", "bits")
        summed = rows.groupBy(*of, F.expr(f"shiftright(key - low, bits - {STEP})").alias("bucket")).agg(F.sum("size").alias("words"), F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("n"))
        run = Window.partitionBy("source").orderBy("bucket")
        ahead = F.col("below") + F.coalesce(F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # A bucket of one row goes in if its middle is below the rest; of the others, the first
        # that doesn't end below the rest holds the threshold.
        crossing = summed.withColumn("ahead", ahead).withColumn("one", (F.col("n") == 1) | ((F.col("phase") == 2) & (F.col("first") == F.col("last"))))
        stop = crossing.filter(F.when(F.col("one"), F.col("ahead") + F.col("words") / 2 > F.col("rest")).otherwise(F.col("ahead") + F.col("words") > F.col("rest")))
        cut = stop.groupBy(F.col("source").alias("s")).agg(F.min(F.struct("bucket", "ahead", "one", "first", "last")).alias("c"))
        state = (
            state.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumn("none", F.col("open") & F.col("c").isNull())
            .withColumn("same", F.col("open") & ~F.col("c.one") & (F.col("c.first") == F.col("c.last")))
            .withColumn("deep", F.col("open") & ~F.col("c.one") & (F.col("c.first") < F.col("c.last")))
            .withColumn("done", F.col("open") & F.col("c.one"))
            .select(
                "source", "source_size", "target", "passes", "rest",
                F.when(F.col("same"), F.col("phase") + 1).otherwise(F.col("phase")).alias("phase"),
                F.when(F.col("same"), BITS).when(F.col("deep"), F.col("bits") - STEP).otherwise(F.col("bits")).alias("bits"),
                F.when(F.col("none"), F.expr("low + shiftleft(1L, bits)")).when(F.col("same"), zero).when(F.col("done"), F.col("c.first"))
                .when(F.col("deep"), F.expr(f"low + shiftleft(c.bucket, bits - {STEP})")).otherwise(F.col("low")).alias("low"),
                F.when(F.col("same") | F.col("deep"), F.col("c.ahead")).otherwise(F.col("below")).cast("long").alias("below"),
                F.when(F.col("same") & (F.col("phase") == 0), F.col("c.first")).otherwise(F.col("f1")).alias("f1"),
                F.when(F.col("same") & (F.col("phase") == 1), F.col("c.first")).otherwise(F.col("f2")).alias("f2"),
                F.coalesce(F.col("same") | F.col("deep"), F.lit(False)).alias("open"),
            )
        )
    at = [F.when(F.col("phase") == n, F.col("low")) for n in range(3)]
    t1, t2, t3 = F.coalesce(at[0], "f1"), F.when(F.col("phase") > 0, F.coalesce(at[1], "f2")).otherwise(zero), F.coalesce(at[2], zero)
    return state.select("source", "source_size", "target", "passes", t1.alias("t1"), t2.alias("t2"), t3.alias("t3"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, times (0, 1, ...; how often it is taken), and the
    columns `keep`; a row for each row. Rows are numbered once, in the written table."""
    body = F.coalesce(F.col(text), F.lit(""))
    k1 = hash60(F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("?"), body)))
    own = [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("size")]
    keys = [k1.alias("k1"), F.shiftrightunsigned(F.xxhash64(body), 64 - BITS).alias("k2"), F.monotonically_increasing_id().alias("k3")]
    rows = saved(docs.select(*own, *keys, *keep), "sizes")
    thin = rows.select("source", "size", "k1", "k2", "k3")
    sums = saved(thin.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    cuts = thresholds(thin, targets(sums, weights, share, most)).withColumnRenamed("source", "s")
    out = rows.join(broadcast_if_small(cuts), F.col("source").eqNullSafe(F.col("s")))
    c = F.col
    before = (c("k1") < c("t1")) | ((c("k1") == c("t1")) & ((c("k2") < c("t2")) | ((c("k2") == c("t2")) & (c("k3") < c("t3")))))
    return out.select("doc_id", "source", "size", "source_size", "target", (c("passes") + F.when(before, 1).otherwise(0)).alias("times"), *keep)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 150 % of all words, weights 5, 2, 1, no source or document above twice."""
    out = mix(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"), "source")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim FROM s),
r AS (SELECT *, lim / weight AS ratio, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS aw FROM w),
l AS (SELECT *, (1.5::DOUBLE * total - coalesce(sum(lim) OVER u, 0)) / (aw - coalesce(sum(weight) OVER u, 0)) AS level FROM r
      WINDOW u AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT min(struct_pack(ratio := ratio, level := level)).level AS held FROM l WHERE ratio > level),
t AS (SELECT source, source_size, CASE WHEN ratio <= level THEN lim ELSE least(lim, held * weight) END AS target FROM l, h),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
c AS (SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS ahead
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST((passes + CASE WHEN ahead + size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken, source FROM c
"""
