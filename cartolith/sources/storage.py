"""Durable work folders for tables and stream checkpoints."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share; deleted when the driver
    ends. Only a local session may do without the setting: it gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="work-")
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """`df` as a written table: worked out once, however many readers there are, and safe against
    lost executors."""
    path = f"{work_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
