"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strataflux")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session within one machine may lack the setting; a cluster's nodes
    would write where no other one reads, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no folder that all nodes share")
    return "file://" + os.path.join(tempfile.gettempdir(), f"spark-strataflux-{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a columnar table into the shared folder and read it back.

    Used where several jobs read one costly intermediate result: the copy outlives lost executors,
    and columns that a reader doesn't need stay on disk. The tables go when the folder is cleared;
    `release` drops one earlier.
    """
    path = f"{shared_folder(df.sparkSession)}/strataflux/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete the files behind tables made by `materialize`, after their last reader was stored itself."""
    for df in tables:
        spark = df.sparkSession
        for name in {f.rpartition("/")[0] for f in df.inputFiles() if "/strataflux/" in f}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
