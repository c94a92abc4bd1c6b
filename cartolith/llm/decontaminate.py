"""Benchmark decontamination by spaced-seed hashing.

A mask has fixed places that count and places that are ignored. Under each mask, the counting words
at every position of every document are hashed, and so are those of every benchmark item; equal
hashes are hits. Around a hit, document and item are laid on each other without gaps; the hit is an
overlap if some stretch of `window` words around it (the whole item, if shorter) agrees in at least
`similarity` of its places. So passages are found in spite of replaced words, also ones that lie
within a seed's span: at 13 words and 0.8 no two replaced words can hide a stretch from both masks.
Items of 8 to 12 words have two shorter masks besides, which see to the same; an item of fewer than
8 words is a seed as a whole, and overlaps where it stands word for word.

Words are lower-cased and split at ASCII white space. Defined cases: null or empty texts and items
match nothing; null ids are reported as null; rows go by their id and a hash of their text, so those
that share an id, or have none, don't meet each other's hits; the pairs of such an id are one result
row, and repeated rows count once; empty tables give an empty result. Only the named columns are read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, load, saved

#: Fixed masks of weight six; 1 counts, 0 is ignored.
MASKS = ("1101111", "111010011")
#: Further masks, of weight five, for items of LEAST words up to below 13.
SHORT_MASKS = ("111011", "110001011")
SHORT, LEAST = 13, 8
#: Tables of at most this many rows (seeds, hits: 32 bytes; items: their text) go to every task.
MOST_ROWS = 500_000


def tokens(text: Column) -> Column:
    """The lower-case words. Only the first or last can be empty, as white space is cut off by runs."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE)


def masks_for(lengths: set[int]) -> list[tuple[str, Column]]:
    """The masks that items of these numbers of words need, and which items have them."""
    n = F.size("item")
    out = [(m, n >= LEAST) for m in MASKS]
    if any(LEAST <= x < SHORT for x in lengths):
        out += [(m, n.between(LEAST, SHORT - 1)) for m in SHORT_MASKS]
    return out + [("1" * x, n == x) for x in sorted(lengths) if 0 < x < LEAST]


def seeds(rows: DataFrame, words: str, masks: list[tuple[str, Column]], of_items: bool = False) -> DataFrame:
    """rows with a row for each mask and position: `at` (position) and `seed`.

    A generator gives the positions, and plain element access the words at a mask's places: all of
    it is compiled into one loop, which arrays of functions wouldn't be. Positions at which a mask
    doesn't fit have no seed.
    """
    at = rows.select("*", F.posexplode(words).alias("at", "__word")).drop("__word")

    def seed(n: int, mask: str, own: Column) -> Column:
        places = [F.get(F.col(words), F.col("at") + k) for k, c in enumerate(mask) if c == "1"]
        fits = F.col("at") + len(mask) <= F.size(words)
        return F.when(fits & own if of_items else fits, F.xxhash64(F.lit(n), *places))

    return at.select("*", F.explode(F.array(*[seed(n, m, own) for n, (m, own) in enumerate(masks)])).alias("seed")).filter("seed is not null")


def row_key(row_id: str, text: str) -> Column:
    """A number for a row: equal for repeated rows alone."""
    return F.xxhash64(F.col(row_id).cast("string"), F.col(text))


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = 13, similarity: float = 0.8) -> DataFrame:
    """doc_id, item_id, hits (places of the item at which a mask hits), matched (most words that
    agree), item_words: one row for each pair that overlaps.

    Hits are found by a hash join of 64-bit numbers, and travel as (document, item, shift). The
    benchmark's seeds, and later the hits, are broadcast only if counted to be at most MOST_ROWS;
    more are joined by shuffle. Texts are read again for the documents that have hits.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), row_key(item_id, text).alias("item_key"), F.array_remove(tokens(F.col(text)), "").alias("item")).dropDuplicates(["item_key"])
    own = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("doc_key"), tokens(F.col(text)).alias("doc"))
    short = items.filter(F.size("item") < SHORT).select(F.size("item").alias("n")).distinct().collect()  # at most 13 numbers
    masks = masks_for({r["n"] for r in short})
    probes = seeds(items, "item", masks, of_items=True).select("item_key", F.col("at").alias("item_at"), F.col("seed").alias("item_seed")).distinct()
    hit = seeds(own.select("doc_key", "doc"), "doc", masks).select("doc_key", "at", "seed").join(_small(probes), F.col("seed") == F.col("item_seed"))
    hit = hit.select(F.col("doc_key").alias("hit_doc"), F.col("item_key").alias("hit_item"), (F.col("at") - F.col("item_at")).alias("shift"), "item_at")
    hits = saved(hit.groupBy("hit_doc", "hit_item", "shift").agg(F.collect_set("item_at").alias("seeds")), "hits")
    laid = own.join(_small(hits), F.col("doc_key") == F.col("hit_doc")).join(_small(items), F.col("hit_item") == F.col("item_key"))
    # Places in the document and in the item where the laid-over stretch begins, and its length.
    d0, i0 = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    n = F.least(F.size("doc") - d0, F.size("item") - i0)
    same = F.zip_with(F.slice("doc", d0 + 1, n), F.slice("item", i0 + 1, n), lambda a, b: (a == b).cast("int"))
    laid = laid.filter(n > 0).select("doc_id", "doc_key", "item_id", "item_key", "shift", "seeds", F.size("item").alias("item_words"), i0.alias("i0"), same.alias("same"))
    size = F.least(F.lit(window), F.col("item_words"))
    need = F.when(size < LEAST, size).otherwise(F.ceil(F.lit(similarity) * size - 1e-9))

    def agrees(k: Column) -> Column:
        """The stretch from place k on agrees enough and holds the beginning of a hit."""
        here = F.exists("seeds", lambda p: (p - F.col("i0") >= k) & (p - F.col("i0") < k + size))
        return here & (F.aggregate(F.slice("same", k + 1, size), F.lit(0), lambda x, y: x + y) >= need)

    last = F.size("same") - size
    found = F.exists(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), agrees)
    good = laid.filter((last >= 0) & found).withColumn("matched", F.aggregate("same", F.lit(0), lambda x, y: x + y))
    once = good.groupBy("doc_id", "doc_key", "item_id", "item_key", "shift").agg(F.max(F.size("seeds")).alias("hits"), F.max("matched").alias("matched"), F.max("item_words").alias("item_words"))
    return once.groupBy("doc_id", "item_id").agg(F.sum("hits").alias("hits"), F.max("matched").alias("matched"), F.max("item_words").alias("item_words"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MOST_ROWS + 1).count() <= MOST_ROWS else df


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs`, all columns, whose text overlaps no item. Rows go by their id and a hash
    of their text, as ids may be null or repeated."""
    key = row_key(doc_id, options.get("text", "text"))
    bad = overlaps(docs.withColumn("__key", key), benchmark, doc_id="__key", **options).select(F.col("doc_id").alias("__overlapping")).distinct()
    return docs.join(bad, key == F.col("__overlapping"), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the corpus that overlaps an item of the benchmark, with the items."""
    return overlaps(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
