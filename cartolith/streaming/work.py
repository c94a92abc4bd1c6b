"""The work chain as Structured Streaming: events in, requests from stage to stage, results out."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import work_folder

#: The order of the pipelines, as requests pass through them.
SEQUENCE = ["segmentation", "metadata", "points", "georeferencing"]
#: Deliveries of a request before it is set aside.
DELIVERIES = 3


def event_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """New event files as a stream; the schema is read from those that are there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
    if _is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Everything that the stream holds now, written once by checkpointed batches."""
    spark, folder = stream.sparkSession, work_folder(stream.sparkSession)
    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").format("parquet").start(f"{folder}/rows")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def drained_batches(stream: DataFrame, each: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """As drained(), each batch through `each`; a batch that is done again overwrites its own folder."""
    spark, folder = stream.sparkSession, work_folder(stream.sparkSession)

    def sink(batch: DataFrame, n: int) -> None:
        each(batch, n).write.mode("overwrite").parquet(f"{folder}/rows/batch={n}")

    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(sink).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch")


def accepted(events: DataFrame, kinds: list[str]) -> DataFrame:
    """Events of the kinds that start work, their JSON payload parsed."""
    payload = F.from_json("props", "k LONG")
    return events.filter(F.col("event_type").isin(kinds)).select("event_id", "ts", "user_id", "event_type", payload["k"].alias("k"))


def chained(results: DataFrame) -> DataFrame:
    """The next stage's request for every successful result; none after the last stage."""
    order = F.array(*map(F.lit, SEQUENCE))
    at = F.array_position(order, F.col("stage"))
    after = F.get(order, at.cast("int"))
    return results.filter("success").select(F.concat_ws("-", after, F.col("image_id").cast("string"), F.lit("pipeline")).alias("request_id"), "image_id", after.alias("stage")).filter("stage is not null")


def split_by_deliveries(messages: DataFrame, most: int = DELIVERIES) -> tuple[DataFrame, DataFrame]:
    """(messages to deliver again, messages set aside)."""
    return messages.filter(F.col("attempt") < most), messages.filter(F.col("attempt") >= most)


def dispatched(results: DataFrame) -> DataFrame:
    """Results with the name of the file that they go to; empty ones are dropped."""
    return results.filter(F.col("output") != "{}").withColumn("file", F.concat_ws("_", F.col("image_id").cast("string"), F.concat(F.col("output_type"), F.when(F.col("output_type") == "projected", ".tif").otherwise(".json"))))


def request_metrics(requests: DataFrame, limits: tuple[int, ...]) -> DataFrame:
    """Counters by pipeline of requests(pipeline, failed, seconds), and a cumulative histogram of
    the good ones' seconds. Works on a stream as on a table."""
    good = ~F.col("failed")
    steps = [F.count_if(good & (F.col("seconds") <= n)).alias(f"le_{n}") for n in limits]
    total = F.coalesce(F.sum(F.when(good, F.col("seconds"))), F.lit(0)).cast("long").alias("total")
    return requests.groupBy("pipeline").agg(F.count("*").alias("requests"), F.count_if("failed").alias("errors"), *steps, F.count_if(good).alias("le_inf"), total)
