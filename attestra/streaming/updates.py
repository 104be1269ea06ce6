"""The update feed as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.sources.files import append_rows
from attestra.sources.stages import own_folder


def read_events(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    """Files of a folder as a stream, with their schema."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there and returns the rows that it wrote; none if it had none."""
    spark, base = stream.sparkSession, own_folder(stream.sparkSession, f"streams/{name}")
    spark.createDataFrame([], stream.schema).write.parquet(f"{base}/out/batch=-1")

    def put(batch: DataFrame, k: int) -> None:
        # a batch that is run again replaces its own folder
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={k}")

    q = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).option("basePath", f"{base}/out").parquet(f"{base}/out/*")


def observed(stream: DataFrame, date: Column, late: str = "7 days") -> DataFrame:
    """A stream whose watermark follows the day on which a record was observed, not the day that it tells of."""
    return stream.withColumn("observed_at", date.cast("timestamp")).withWatermark("observed_at", late)


def windowed_counts(spark: SparkSession, folder: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts by tumbling window and event type, with a watermark that bounds state."""
    e = read_events(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    out = drained(g.select(F.col("w.start").alias("start"), "event_type", "n", "total"), "counts", "update")
    # later batches hold newer values of a window
    return out.groupBy("start", "event_type").agg(F.max_by("n", "n").alias("n"), F.max_by("total", "n").alias("total"))


def latest_states(spark: SparkSession, folder: str) -> DataFrame:
    """The newest event per user. The stream only appends to a log, so it holds no state; what an upsert would hold is a view of the log."""
    out = drained(read_events(spark, folder).select("user_id", "ts", "event_id", "event_type"), "latest")
    return out.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("last")).select("user_id", F.col("last.event_id").alias("event_id"), F.col("last.event_type").alias("event_type"))


def with_priors(stream: DataFrame, priors: DataFrame, key: str) -> DataFrame:
    """Updates with the first phase's probabilities of their candidate: a stream joined to a table, without state. Updates without a prior go."""
    return drained(stream.join(priors, key), "priors")


def append_log(stream: DataFrame, path: str, name: str, clean: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Appends a stream's batches to a log, each once: a batch's number is a column, and one that is there already is not written again."""
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).withColumn("batch", F.lit(0).cast("long")).write.mode("append").parquet(path)

    def put(batch: DataFrame, k: int) -> None:
        if not spark.read.parquet(path).where(F.col("batch") == k).limit(1).count():
            append_rows(clean(batch).withColumn("batch", F.lit(k).cast("long")), path)

    q = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{own_folder(spark, f'streams/{name}')}/state").trigger(availableNow=True).start()
    q.awaitTermination()
