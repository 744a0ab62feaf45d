"""Percentiles of very large numeric columns from merging centroid digests.

A digest is a list of centroids (mean, weight) whose weights follow a size function of the quantile:
narrow at the tails, wide in the middle. Digests are built from sorted values in one pass, merged by
sorting their centroids and clustering again, and every estimate is certified by counting the values
around it. All of it is windows and aggregates, so nothing leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflux.operators.scaling import null_safe_join
from strataflux.operators.vocab import with_canonical_names
from strataflux.session import materialize

GROUP = ["site", "region", "measure_type"]
#: clusters per digest are at most half of it; one clustering moves a rank by at most pi / compression
COMPRESSION = 1_000
#: the stated error, as a share of the group's values: three clusterings, rounded up
RANK_ERROR = 0.01
ROWS_PER_DIGEST = 500_000
#: digests of one hot group are first merged in so many folds, so that no task clusters all of them
FOLDS = 256
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def loads_of(observations: DataFrame) -> DataFrame:
    """(dataset_version, load): the different loads, numbered in the order of their names; null comes first."""
    names = observations.select("dataset_version").distinct()
    return names.withColumn("load", F.row_number().over(Window.orderBy(F.col("dataset_version").asc_nulls_first())))


def groups_of(observations: DataFrame, region_set: DataFrame) -> DataFrame:
    """(gid, GROUP): every group that cells can have, from the different spellings of site, region and measure."""
    spelled = observations.select("site", "region", "hemisphere", "measure_type").distinct()
    return with_canonical_names(spelled, region_set).select(*GROUP).distinct().select(group_id().alias("gid"), *GROUP)


def group_id() -> Column:
    return F.xxhash64(F.to_json(F.struct(*GROUP)))


def distinct_cells(observations: DataFrame, region_set: DataFrame, loads: DataFrame) -> DataFrame:
    """(gid, load, value, salt): finite values, each repeated cell once, in its first load; salt spreads a group's rows."""
    rows = observations.select("dataset_version", "subject_id", "session_id", "site", "region", "hemisphere", "measure_type", "value")
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    named = null_safe_join(with_canonical_names(rows.filter(finite), region_set), loads, ["dataset_version"], "inner")
    return (
        named.select("subject_id", "session_id", group_id().alias("gid"), "value", "load")
        .groupBy("subject_id", "session_id", "gid", "value")
        .agg(F.min("load").alias("load"))
        .select("gid", "load", "value", F.hash("subject_id", "session_id").alias("salt"))
    )


def _cluster(q: Column, compression: int) -> Column:
    """Number of the cluster of the quantile q; a unit of it is narrow where q is near 0 or 1."""
    return F.floor(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * q - 1))) * (compression / (2 * math.pi))).cast("int")


def build_digests(values: DataFrame, keys: Sequence[str], value: str = "value", compression: int = COMPRESSION,
                  rows_per_digest: int = ROWS_PER_DIGEST, salt: str | None = None) -> DataFrame:
    """(keys, mean, weight, low, high): centroid rows of one or more digests per group.

    A group of more than `rows_per_digest` values is dealt out to several digests by the column `salt`, so no task sorts a
    whole hot group; these are merged to FOLDS digests at most, of which `merge_digests` makes one. Without a salt, equal
    values are counted first and dealt out by a hash of the value.
    """
    keys = list(keys)
    sizes = materialize(values.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_digest).cast("int").alias("parts")), "sizes")
    if salt:
        points = values.select(*keys, F.col(value).alias("v"), F.lit(1).cast("bigint").alias("w"), F.col(salt).alias("s"))
    else:
        points = values.groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("w")).withColumn("s", F.xxhash64("v"))
    salted = null_safe_join(points, sizes, keys, "inner").withColumn("part", F.pmod("s", F.col("parts")).cast("int"))
    order = Window.partitionBy(*keys, "part").orderBy("v")
    upto = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0))
    q = (upto - F.col("w") / 2) / F.sum("w").over(Window.partitionBy(*keys, "part"))
    parts = (
        salted.select(*keys, "part", "v", "w")
        .withColumn("c", _cluster(q, compression))
        .groupBy(*keys, "part", "c")
        .agg(
            (F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("mean"),
            F.sum("w").alias("weight"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
        )
        .drop("c")
    )
    folded = parts.withColumn("fold", F.pmod("part", F.lit(FOLDS))).drop("part")
    return merge_digests(folded, [*keys, "fold"], compression).drop("fold")


def merge_digests(centroids: DataFrame, keys: Sequence[str], compression: int = COMPRESSION) -> DataFrame:
    """One digest per group of `keys` from the centroid rows of any number of digests, by clustering again."""
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy("mean", "weight", "low", "high")
    total = F.sum("weight").over(Window.partitionBy(*keys))
    upto = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0))
    q = (upto - F.col("weight") / 2) / total
    return (
        centroids.withColumn("c", _cluster(q, compression))
        .groupBy(*keys, "c")
        .agg(
            (F.sum(F.col("mean") * F.col("weight")) / F.sum("weight")).alias("mean"),
            F.sum("weight").alias("weight"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .drop("c")
    )


def pack_digests(centroids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group: the digest as a sorted array, for storage; its size is bounded by the compression."""
    return centroids.groupBy(*keys).agg(
        F.sum("weight").alias("n"), F.array_sort(F.collect_list(F.struct("mean", "weight", "low", "high"))).alias("centroids")
    )


def unpack_digests(packed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return packed.select(*keys, F.explode("centroids").alias("c")).select(*keys, "c.*")


def estimates(centroids: DataFrame, keys: Sequence[str], percentiles: Sequence[float]) -> DataFrame:
    """(keys, n, estimates): an array with one estimate per percentile, between the two centroids around its rank."""
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy("mean", "weight", "low", "high")
    upto = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0))
    mids = centroids.select(*keys, "weight", "low", "high", "mean", upto.alias("upto"))

    def point(mid: Column) -> Column:
        return F.struct(mid.cast("double").alias("mid"), F.col("mean"))

    # equal values occupy their whole span of ranks, others are placed at the middle of theirs
    span = F.array(point(F.col("upto") - F.col("weight")), point(F.col("upto")))
    points = F.when(F.col("low") == F.col("high"), span).otherwise(F.array(point(F.col("upto") - F.col("weight") / 2)))
    digest = mids.groupBy(*keys).agg(
        F.sum("weight").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.array_sort(F.flatten(F.collect_list(points))).alias("c"),
    )

    def estimate(p: float) -> Column:
        rank = F.col("n") * F.lit(float(p))
        below = F.filter("c", lambda x: x["mid"] <= rank)
        above = F.filter("c", lambda x: x["mid"] > rank)
        edge = lambda mid, mean: F.struct(mid.cast("double").alias("mid"), mean.alias("mean"))
        a = F.coalesce(F.try_element_at(below, F.lit(-1)), edge(F.lit(0.0), F.col("low")))
        b = F.coalesce(F.get(above, F.lit(0)), edge(F.col("n"), F.col("high")))
        share = F.coalesce(F.try_divide(rank - a["mid"], b["mid"] - a["mid"]), F.lit(0.0))
        return a["mean"] + (b["mean"] - a["mean"]) * share

    return digest.select(*keys, "n", F.array(*[estimate(p) for p in percentiles]).alias("estimates"))


def certify(values: DataFrame, estimated: DataFrame, keys: Sequence[str], percentiles: Sequence[float], value: str = "value") -> DataFrame:
    """(keys, percentile, n, estimate, rank_error): the second pass counts the values below and up to each estimate.

    rank_error is the distance of the percentile from the share interval that the estimate occupies.
    """
    keys = list(keys)
    joined = null_safe_join(values.select(*keys, F.col(value).alias("v")), estimated, keys, "inner")
    # every row of a group carries the same estimates, so the first one stands for all
    counts = [F.sum((F.col("v") < F.col("estimates")[i]).cast("bigint")).alias(f"lt{i}") for i in range(len(percentiles))]
    counts += [F.sum((F.col("v") <= F.col("estimates")[i]).cast("bigint")).alias(f"le{i}") for i in range(len(percentiles))]
    counted = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("estimates").alias("estimates"), *counts)

    def entry(i: int, p: float) -> Column:
        low, high = F.col(f"lt{i}") / F.col("n"), F.col(f"le{i}") / F.col("n")
        error = F.greatest(low - F.lit(float(p)), F.lit(float(p)) - high, F.lit(0.0))
        return F.struct(F.lit(float(p)).alias("percentile"), F.col("estimates")[i].alias("estimate"), error.alias("rank_error"))

    rows = F.explode(F.array(*[entry(i, p) for i, p in enumerate(percentiles)])).alias("e")
    return counted.select(*keys, "n", rows).select(*keys, "e.percentile", "n", "e.estimate", "e.rank_error")


def certified_percentiles(
    values: DataFrame, keys: Sequence[str], percentiles: Sequence[float] = PERCENTILES, compression: int = COMPRESSION,
    rank_error: float = RANK_ERROR, salt: str | None = None,
) -> DataFrame:
    """(keys, percentile, n, estimate, rank_error, certified) over (keys, load, value).

    Digests are made per group and load and merged over the loads, so separate loads combine in the same
    way. `certified` tells that the counted rank error is at most `rank_error`, or one value where a group
    is so small that a value is more than that. Values must be finite; null keys are groups; ties share
    one rank interval; groups without values don't appear.
    """
    keys = list(keys)
    per_load = build_digests(values, [*keys, "load"], compression=compression, salt=salt)
    merged = merge_digests(per_load, keys, compression)
    estimated = materialize(estimates(merged, keys, percentiles), "estimates")  # stored, so that its size is known before the counting pass
    counted = certify(values, estimated, keys, percentiles)
    bound = F.greatest(F.lit(rank_error), 1 / F.col("n"))
    return counted.withColumn("certified", F.col("rank_error") <= bound)


def stored_cells(observations: DataFrame, region_set: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, groups, loads) as tables: `distinct_cells`, which the digests and the counting pass both read, and its names."""
    loads = materialize(loads_of(observations), "loads")
    return materialize(distinct_cells(observations, region_set, loads), "cells"), materialize(groups_of(observations, region_set), "groups"), loads
