"""Counters over canonical observations that arrive as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflux.schema import SCHEMA


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """New parquet files of `folder` as a stream under the canonical schema plus `acquired_at`."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in SCHEMA] + [T.StructField("acquired_at", T.TimestampNTZType())])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def window_counts(stream: DataFrame, width: str = "30 days", late: str = "365 days") -> DataFrame:
    """(start, site, measure_type, n, n_null, total) per time window; rows later than `late` behind the newest are dropped by the watermark.

    A null site is `unknown`; a row without a time belongs to no window.
    """
    timed = stream.withColumn("at", F.col("acquired_at").cast("timestamp")).withWatermark("at", late)
    keys = [F.window("at", width).alias("w"), F.coalesce("site", F.lit("unknown")).alias("site"), F.lower(F.trim("measure_type")).alias("measure_type")]
    return timed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("n_null"), F.sum("value").alias("total")
    ).select(F.col("w.start").alias("start"), "site", "measure_type", "n", "n_null", "total")


def run_counters(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the counters of what has arrived in the table `path`: each batch adds the rows that it changed, state older than
    the watermark goes. A batch that is run again replaces its own rows."""

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return window_counts(stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters as they stand: of each window, site and measure the row of the last batch that changed it."""
    keys = ["start", "site", "measure_type"]
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by(F.struct("n", "n_null", "total"), "batch").alias("c")).select(*keys, "c.*")
