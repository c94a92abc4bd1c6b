"""The catalogue of queries over the engine's operators: name -> (query, SQL or None)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

CATALOGUE: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) -> DataFrame, and the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        if name in CATALOGUE:
            raise ValueError(f"two queries named {name}")
        CATALOGUE[name] = (f, sql)
        return f

    return register
