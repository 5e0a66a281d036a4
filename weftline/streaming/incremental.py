"""Daily batches as a file stream: new article files are read once, and their records are added to a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import scalars as S


def item_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON Lines items that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).json(folder)


def accept_batch(store: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: items whose id the store doesn't have are appended, the first of equal ids in a batch.

    A batch that is delivered again after a failure finds its ids stored and adds nothing.
    """

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn("doc_id", S.item_id(F.col("url"))).where("url is not null")
        fresh = keyed.dropDuplicates(["doc_id"])
        at = spark._jvm.org.apache.hadoop.fs.Path(store)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            fresh = fresh.join(spark.read.parquet(store).select("doc_id"), "doc_id", "left_anti")
        fresh.write.mode("append").parquet(store)

    return run


def ingest(spark: SparkSession, folder: str, schema: str, store: str, checkpoint: str):
    """A query that takes all that has arrived and stops."""
    rows = item_stream(spark, folder, schema)
    return rows.writeStream.foreachBatch(accept_batch(store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(items: DataFrame, late: str = "2 days") -> DataFrame:
    """Items per source and day of collection, with items up to `late` behind the newest still counted."""
    return items.withWatermark("collected_at", late).groupBy(F.window("collected_at", "1 day"), "source_id").agg(F.count("*").alias("n"))
