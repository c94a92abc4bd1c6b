"""A training corpus from raw documents, in five stages, each a table that the next one reads.

When a stage begins, the result of the one before it has been written, so the tables that that one
left behind are deleted: of a stage's working tables, only the last stage's are there at the end.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolith.llm.common import deleted, load, noting, saved
from cartolith.llm.decontaminate import decontaminated
from cartolith.llm.mixing import mix
from cartolith.llm.near_dedup import near_duplicates
from cartolith.llm.quality import quality
from cartolith.llm.sharding import numbered, splitters, with_keys

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 16

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders of the working tables of the stage that was called last.
_LEFT: list[str] = []


def tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        deleted(spark, _LEFT)
        with noting(_LEFT):
            return stage(spark, docs, sf_dir)

    return begin


@tidy
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier doesn't reject, each by its own text."""
    return quality(docs, load(spark, sf_dir, "labels"), keep=COLUMNS[1:]).filter("predicted <> 0").select(*COLUMNS)


@tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id: 5-word shingles, similarity
    0.8 or more. Rows go by a number of their own, as ids may be null or repeated."""
    rows = saved(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("__row")), "rows")
    groups = near_duplicates(rows, shingle=5, doc_id="__row").select(F.col("doc_id").alias("at"), "component_id")
    named = groups.join(rows.select("__row", "doc_id"), F.col("at") == F.col("__row"))
    kept = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("k")).select(F.col("k.at").alias("__kept"))
    return rows.join(kept, F.col("__row") == F.col("__kept"), "left_semi").select(*COLUMNS)


@tidy
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminated(docs, load(spark, sf_dir, "benchmark")).select(*COLUMNS)


@tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 5, 2, 1 by source, 150 % of all words,
    nothing more than twice."""
    taken = mix(docs, keep=("text", "lang", "n_chars")).filter("times > 0")
    return taken.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


@tidy
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard of 16, of near equal bytes, and its place there."""
    rows = with_keys(docs, keep=COLUMNS[1:])
    # The splitters need no texts. Their row numbers, which only part rows that are equal in text
    # and id, are those of the same written table; were they others, only the balance would suffer.
    bounds = splitters(saved(rows.drop(*COLUMNS[1:]), "keys"), SHARDS)
    return numbered(rows, bounds).select(*COLUMNS, "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier's fit can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
