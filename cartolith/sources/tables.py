"""Readers of the flat input tables."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` under `sf_dir`, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
