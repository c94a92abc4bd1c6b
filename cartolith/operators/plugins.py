"""Seams for models and services: recognisers are callables, their results are tables."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extracted(rows: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Rows through a model that each task loads once and calls batch by batch."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            yield model(b)

    return rows.mapInPandas(work, schema)


def cached(rows: DataFrame, cache: DataFrame, key: str, load: Callable, schema: str) -> DataFrame:
    """Results from the cache (the schema's columns), and from the model for keys that it lacks."""
    names = [f.name for f in cache.schema.fields]
    hits = cache.join(rows.select(key).distinct(), key, "left_semi").select(*names)
    return hits.unionByName(extracted(rows.join(cache.select(key).distinct(), key, "left_anti"), load, schema).select(*names))


def union_of(*parts: DataFrame) -> DataFrame:
    """Results of several extractors, with the number of the one that each row came from."""
    out = None
    for n, p in enumerate(parts):
        p = p.withColumn("origin", F.lit(n))
        out = p if out is None else out.unionByName(p)
    return out
