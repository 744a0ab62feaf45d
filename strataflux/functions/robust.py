"""Robust statistics inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.operators.scaling import median_and_mad, null_safe_join

MAD_TO_SIGMA = 1.4826


def euler_number(holes: Column) -> Column:
    """Euler number of a surface from its hole count; null stays null."""
    return F.lit(2.0) - F.lit(2.0) * holes


def with_robust_z(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """`df` with `name` = (value - median) / (1.4826 MAD) inside the groups of `by`.

    0 for a whole group (null values included) whose MAD is 0 or undefined, null for null values
    elsewhere. Null keys form a group. Medians are exact; hot groups are ranked without gathering them.
    """
    by = list(by)
    stats = median_and_mad(df.select(*by, value), by, value).select(*by, F.col("center").alias("__center"), F.col("mad").alias("__mad"))
    joined = null_safe_join(df, stats, by)
    z = (F.col(value) - F.col("__center")) / (F.col("__mad") * MAD_TO_SIGMA)
    flat = F.col("__mad").isNull() | (F.col("__mad") == 0)
    return joined.withColumn(name, F.when(flat, F.lit(0.0)).otherwise(z)).drop("__center", "__mad")
