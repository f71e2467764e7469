"""Deliveries as a stream: counts by window, one copy of each message, and a table kept up to date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import folded
from tidemark.operators import latest_wins, payload
from tidemark.session import staging_path
from tidemark.sources.schemas import BAR_KEYS, BAR_VALUES
from tidemark.sources.versioned import VersionedTable


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A Parquet dataset, a folder or one file, as a stream of its files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        # the file source watches folders
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def window_counts(deliveries: DataFrame, late: str = "30 days", width: str = "7 days") -> DataFrame:
    """Deliveries and records by source and window of arrival; windows that the watermark has passed take no more and leave the state.

    For the output mode update (counts so far of windows that changed) or append (windows that are closed).
    """
    return (
        deliveries.withWatermark("ingested_at", late)
        .groupBy(F.window("ingested_at", width), folded(F.col("source")).alias("source"))
        .agg(F.count(F.lit(1)).alias("n_deliveries"), F.sum(F.col("record_count").cast("long")).alias("n_records"))
        .select(F.col("window.start").alias("window_start"), "source", "n_deliveries", "n_records")
    )


def once(deliveries: DataFrame, key: Column, late: str = "30 days") -> DataFrame:
    """The first copy of each message that arrives; state of messages is dropped once the watermark has passed them."""
    return deliveries.withColumn("_key", key).withWatermark("ingested_at", late).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def run_to_end(stream: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Run a stream over all that is there and return what it wrote to the shared folder.

    Without ``keys`` in append mode. With them in update mode: every batch's changed rows are written to a folder of
    its own, written over if the batch is repeated, and the newest row of each key is the result.
    """
    spark, out = stream.sparkSession, staging_path(stream.sparkSession, name)
    if keys:

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        writer = stream.writeStream.foreachBatch(write).outputMode("update")
    else:
        writer = stream.writeStream.format("parquet").option("path", out).outputMode("append")
    writer.option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    if not keys:
        return spark.read.schema(stream.schema).parquet(out)
    written = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    rest = [c for c in stream.columns if c not in keys]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("v"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"v.{c}").alias(c) for c in stream.columns])


def merge_bars(table: VersionedTable) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges the bars of delivered payloads into a table.

    Merging a batch twice changes nothing, so a batch that is repeated after a failure does no harm.
    """

    def merge(batch: DataFrame, number: int) -> None:
        latest_wins.merge_latest(table, payload.bars(payload.delivered_bars(batch)), BAR_KEYS, BAR_VALUES)

    return merge


def follow(deliveries: DataFrame, table: VersionedTable, state: str) -> None:
    """Merge all deliveries that are there into a table of bars, and remember in ``state`` what was merged."""
    query = deliveries.writeStream.foreachBatch(merge_bars(table)).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
