"""Incremental ingest: file streams into chunk tables, and event-time aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, folder: str, schema: str, transform: Callable[[DataFrame], DataFrame], target: str, state: str, key: list[str], max_files: int = 1000) -> StreamingQuery:
    """Parquet files that arrive in folder -> transform -> rows appended to target, each file exactly once.

    The checkpoint in `state` lists the files done; rows whose key is in target already are left out, so a file sent again
    or a batch run again after a failure adds nothing. Runs until the files at hand are done.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        fresh = transform(rows).dropDuplicates(key)
        if target_exists(spark, target):
            fresh = fresh.join(spark.read.parquet(target).select(*key), key, "left_anti")
        fresh.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", state).trigger(availableNow=True).start()


def target_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def windowed_counts(events: DataFrame, *, time: str = "ts", group: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, group, n, total) over tumbling windows, for a stream or a table; a stream drops rows later than `late`."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    out = rows.groupBy(F.window(time, width).alias("w"), group).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), group, "n", "total")
