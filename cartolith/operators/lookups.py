"""Lookup joins: places, codes, classes and cached values.

Lookup tables (country and state codes, symbol classes) are fixed lists; whether one is broadcast
is left to the planner's size check.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(rows: DataFrame, codes: DataFrame, on: str, name: str = "name", code: str = "code") -> DataFrame:
    """rows with `code` and `name` of the entry whose code or name is `on`, in lower case; a text
    that is neither becomes the name."""
    low = F.lower(F.col(on))
    flat = codes.select(F.lower(name).alias("__name"), F.lower(code).alias("__code"))
    by_code, by_name = flat.toDF("__n1", "__c1"), flat.toDF("__n2", "__c2")
    out = rows.join(by_code, low == F.col("__c1"), "left").join(by_name, low == F.col("__n2"), "left")
    return out.withColumn("code", F.coalesce("__c1", "__c2")).withColumn("name", F.coalesce("__n1", "__n2", low)).drop("__n1", "__c1", "__n2", "__c2")


def state_lookup(rows: DataFrame, codes: DataFrame, on: str) -> DataFrame:
    """rows with `state_code` and `state_name`: a code, `xx-yy` with a code yy, or a name."""
    low = F.lower(F.col(on))
    flat = codes.select(F.lower("code").alias("__c"), F.lower("name").alias("__n"))
    parts = F.split(low, "-")
    second = F.get(parts, 1)
    part = F.when((F.size(parts) == 2) & (F.length(second) == 2), second)
    out = rows.join(flat, low == F.col("__c"), "left").join(flat.toDF("__c2", "__n2"), part == F.col("__c2"), "left")
    found = F.col("__c").isNotNull()
    return out.withColumn("state_code", F.when(found, F.col("__c")).otherwise(part)).withColumn("state_name", F.when(found, F.col("__n")).when(part.isNotNull(), F.coalesce("__n2", part)).otherwise(low)).drop("__c", "__n", "__c2", "__n2")


def keyword_class(rows: DataFrame, keywords: DataFrame, on: str) -> DataFrame:
    """rows with the class of the longest keyword that the label holds (keyword, class, seq); of
    equally long ones the first. A label without any keeps a null class."""
    key = [F.col(c) for c in rows.columns]
    met = rows.join(keywords, F.lower(F.col(on)).contains(F.lower(F.col("keyword"))), "left")
    return met.groupBy(*key).agg(F.max_by("class", F.struct(F.length("keyword"), -F.col("seq"))).alias("class"))


def resolved(rows: DataFrame, key: str, *sources: DataFrame) -> DataFrame:
    """rows with `value` and `origin` from the first of the sources (key, value) that has the key."""
    out = rows
    for n, s in enumerate(sources):
        out = out.join(s.select(F.col(key).alias(f"__k{n}"), F.col("value").alias(f"__v{n}")), F.col(key) == F.col(f"__k{n}"), "left")
    value = F.coalesce(*[F.col(f"__v{n}") for n in range(len(sources))])
    origin = F.coalesce(*[F.when(F.col(f"__v{n}").isNotNull(), F.lit(n)) for n in range(len(sources))])
    return out.select(*[rows[c] for c in rows.columns], value.alias("value"), origin.alias("origin"))


def cache_complete(wanted: DataFrame, cached: DataFrame, raster: str, keys: list[str]) -> DataFrame:
    """(raster, complete): every wanted row is cached, and no more than that are."""
    have = cached.select(raster, *keys).distinct().withColumn("__hit", F.lit(1))
    counts = cached.groupBy(raster).agg(F.count("*").alias("__cached"))
    found = wanted.join(have, [raster, *keys], "left").groupBy(raster).agg(F.bool_and(F.col("__hit").isNotNull()).alias("__all"), F.count("*").alias("__wanted"))
    return found.join(counts, raster, "left").select(raster, (F.col("__all") & (F.coalesce("__cached", F.lit(0)) == F.col("__wanted"))).alias("complete"))


def upserted(old: DataFrame, new: DataFrame, key: list[str], order: str, by_order: bool = False) -> DataFrame:
    """Rows by key: new ones override, the place of the first stays. With `by_order`, where `order`
    runs through both tables, what comes later in it overrides, of equal places the new row."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    rest = [c for c in old.columns if c not in (*key, order)]
    by = F.struct(order, "__new") if by_order else F.struct("__new", order)
    return both.groupBy(*key).agg(F.min(by)[order].alias(order), F.max_by(F.struct(*rest), by).alias("__r")).select(*key, order, "__r.*")


def suffixed(items: DataFrame, group: str, name: str, order: str = "seq") -> DataFrame:
    """Repeated names get _1, _2, ... in order; the first keeps its name."""
    n = F.row_number().over(Window.partitionBy(group, name).orderBy(order)) - 1
    return items.withColumn("__n", n).withColumn(name, F.when(F.col("__n") > 0, F.concat(F.col(name), F.lit("_"), F.col("__n").cast("string"))).otherwise(F.col(name))).drop("__n")


def best_by(rows: DataFrame, group: list[str], score: Column, order: str = "seq") -> DataFrame:
    """The first row of the highest score in each group."""
    rest = [c for c in rows.columns if c not in group]
    return rows.groupBy(*group).agg(F.max_by(F.struct(*rest), F.struct(score, -F.col(order))).alias("__r")).select(*group, "__r.*")
