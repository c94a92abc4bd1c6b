"""Inputs made from the flat tables by SQL text that Spark and DuckDB read alike."""

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of `sql`, whose names of flat tables stand for those under `sf_dir`."""
    used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)]
    text = sql.replace("{", "{{").replace("}", "}}")  # braces of the text's own stay
    text = re.sub(rf"\b(FROM|JOIN) ({'|'.join(used)})\b", r"\1 {\2}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})
