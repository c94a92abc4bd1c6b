"""What the operators of this folder share: the shared work folder, durable tables, tokenising."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the word rule [^\x20\x09-\x0D]+ has it.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir, which all executors see.

    Only a local session may do without the setting: it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(root or _own_root()).rstrip('/')}/{uuid.uuid4().hex}"


def passing(spark: SparkSession, path: str) -> None:
    """Has the folder deleted when the driver ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` as a table in the shared folder: evaluated once, safe against lost executors, deleted
    when the driver ends."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    df.write.parquet(f"{folder}/{name}")
    passing(spark, folder)
    for names in _NOTED:
        names.append(folder)
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


_NOTED: list[list[str]] = []


@contextmanager
def noting(names: list[str]) -> Iterator[None]:
    """Adds the folders of the tables that are saved meanwhile to `names`."""
    _NOTED.append(names)
    try:
        yield
    finally:
        _NOTED.pop()


def deleted(spark: SparkSession, names: list[str]) -> None:
    """Deletes such folders, and empties the list."""
    while names:
        folder = spark._jvm.org.apache.hadoop.fs.Path(names.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def forget(df: DataFrame) -> None:
    """Deletes the files of a saved table that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """`df` marked for broadcast if it is counted to have at most `rows` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null ids give -1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))


def words(text: str) -> list[bytes]:
    """Lower-case A-Z, split at ASCII white space: exactly the words of WORD."""
    return text.encode("utf-8", "surrogatepass").lower().split()
