"""False discovery rate control per declared family of tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_fdr(tests: DataFrame, family: Sequence[str], p: str = "p_value", testable: str | None = None) -> DataFrame:
    """`tests` with `q_value`, the Benjamini-Hochberg adjusted p within each family.

    Rows with a null p, or where the column `testable` isn't true, stay out of their family and get null.
    Ties share the smallest adjusted value.
    """
    family = list(family)
    in_family = F.col(p).isNotNull() if testable is None else F.col(p).isNotNull() & F.coalesce(F.col(testable), F.lit(False))
    marked = tests.withColumn("__in", in_family)
    groups = Window.partitionBy(*family, "__in")
    size = F.count(F.lit(1)).over(groups)
    rank = F.count(F.lit(1)).over(groups.orderBy(p).rangeBetween(Window.unboundedPreceding, 0))
    raw = marked.withColumn("__raw", F.when(F.col("__in"), F.col(p) * size / rank))
    lowest = F.min("__raw").over(groups.orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0))
    return raw.withColumn("q_value", F.when(F.col("__in"), F.least(F.lit(1.0), lowest))).drop("__in", "__raw")
