"""Parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of `folder`: one file or a directory of files called `<name>.parquet`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
