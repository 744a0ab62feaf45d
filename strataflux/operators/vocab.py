"""Canonical region and measure names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: what counts as blank at the ends of a name
BLANKS = " \t\n\x0b\f\r"


def measure_key(text: Column) -> Column:
    return F.lower(F.btrim(text, F.lit(BLANKS)))


def name_key(text: Column) -> Column:
    """Stored spelling without outer blanks, letter case and the difference of `_` and `-`."""
    return F.translate(measure_key(text), "_", "-")


def region_aliases(region_set: DataFrame) -> DataFrame:
    """(alias, side, canon_region): every spelling of a region; side is '' unless a bare structure needs it."""
    named = region_set.select(
        F.explode(F.concat(F.array("region"), F.coalesce("source_names", F.array().cast("array<string>")))).alias("a"),
        F.lit("").alias("side"),
        F.col("region").alias("canon_region"),
    )
    bare = region_set.select(
        F.col("structure").alias("a"), F.lower(F.trim("hemisphere")).alias("side"), F.col("region").alias("canon_region")
    )
    return (
        named.unionByName(bare)
        .select(name_key(F.col("a")).alias("alias"), "side", "canon_region")
        .filter(F.col("alias").isNotNull())
        .groupBy("alias", "side")
        .agg(F.min("canon_region").alias("canon_region"))
    )


def with_canonical_names(df: DataFrame, region_set: DataFrame) -> DataFrame:
    """Replace region and measure_type by their canonical form.

    A spelling that the vocabulary doesn't know stays, as its comparison key, so no row is lost.
    The vocabulary has a few dozen entries; whether it is broadcast is left to the planner's size check.
    """
    by_side = F.map_from_entries(F.collect_list(F.struct("side", "canon_region")))
    aliases = region_aliases(region_set).groupBy(F.col("alias").alias("__alias")).agg(by_side.alias("__sides"))
    side = F.coalesce(F.lower(F.trim("hemisphere")), F.lit(""))
    return (
        df.withColumn("__k", name_key(F.col("region")))
        .join(aliases, F.col("__k") == F.col("__alias"), "left")
        .withColumns(
            {
                "region": F.coalesce(F.try_element_at("__sides", F.lit("")), F.try_element_at("__sides", side), "__k"),
                "measure_type": measure_key(F.col("measure_type")),
            }
        )
        .drop("__k", "__alias", "__sides")
    )
