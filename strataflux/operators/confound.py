"""How strongly batches are confounded with time, and what to do with small batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflux.session import materialize

TIME = "time_from_baseline_years"
# fixed values: R2 of time by batch -> severity
SEVERITIES = ((0.5, "severe"), (0.2, "moderate"), (0.05, "mild"))


def batch_sizes(df: DataFrame, batch: str, min_size: int) -> DataFrame:
    """(batch, n_observations, n_subjects, small) per non-null batch."""
    return (
        df.filter(F.col(batch).isNotNull())
        .groupBy(F.col(batch).alias("batch"))
        .agg(F.count(F.lit(1)).alias("n_observations"), F.countDistinct("subject_id").alias("n_subjects"))
        .withColumn("small", F.col("n_subjects") < min_size)
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by a total order, without windowing the whole group."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return picked.select(*keys, "__r.*")


def batch_composition(df: DataFrame, batch: str, min_size: int) -> DataFrame:
    """(batch, n_subjects, n_female, n_male, n_patient, n_control, age_mean, age_sd) of the small batches.

    Every subject counts once per batch, with its earliest row.
    """
    subjects = first_rows(
        df.filter(F.col(batch).isNotNull()).select(F.col(batch).alias("batch"), "subject_id", "sex", "dx_baseline", "age_baseline", TIME, "session_id", "region"),
        ["batch", "subject_id"], [TIME, "session_id", "region"],
    )
    return (
        subjects.groupBy("batch")
        .agg(
            F.count(F.lit(1)).alias("n_subjects"), F.count_if(F.col("sex") == "F").alias("n_female"), F.count_if(F.col("sex") == "M").alias("n_male"),
            F.count_if(F.col("dx_baseline") == "patient").alias("n_patient"), F.count_if(F.col("dx_baseline") == "control").alias("n_control"),
            F.avg("age_baseline").alias("age_mean"), F.stddev_samp("age_baseline").alias("age_sd"),
        )
        .filter(F.col("n_subjects") < min_size)
    )


def time_r2(df: DataFrame, batch: str) -> DataFrame:
    """One row: n, n_batches, r2 = between-batch share of the variation of time (null if time is constant)."""
    known = df.filter(F.col(batch).isNotNull() & F.col(TIME).isNotNull())
    per = known.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n"), F.avg(TIME).alias("m"), F.coalesce(F.var_pop(TIME), F.lit(0.0)).alias("v")
    )
    sums = per.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_batches"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("nmm"), F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    between = F.col("nmm") - F.col("n") * F.col("gm") * F.col("gm")
    return sums.select("n", "n_batches", F.try_divide(between, between + F.col("within")).alias("r2"))


def time_correlation(df: DataFrame, batch: str) -> DataFrame:
    """One row: Pearson correlation of time with the alphabetical batch code, 0 if either is constant."""
    known = df.filter(F.col(batch).isNotNull() & F.col(TIME).isNotNull()).select(F.col(batch).alias("batch"), TIME)
    # one row per batch, so ranking them in one task is bounded by their number
    codes = known.select("batch").distinct().withColumn("code", F.dense_rank().over(Window.orderBy("batch")) - 1)
    joined = known.join(codes, "batch")
    r = joined.agg(F.covar_pop("code", TIME).alias("c"), (F.stddev_pop("code") * F.stddev_pop(TIME)).alias("s"))
    return r.select(F.coalesce(F.try_divide(F.col("c"), F.col("s")), F.lit(0.0)).alias("correlation"))


def time_bins(df: DataFrame, bins: int = 4) -> DataFrame:
    """`df` with `time_bin` 0..bins-1: equal widths over the range of time, closed on the right, the lowest edge included."""
    low, high = df.agg(F.min(TIME), F.max(TIME)).first()
    if low is None:
        return df.withColumn("time_bin", F.lit(None).cast("int"))
    edges = [low + (high - low) * i / bins for i in range(1, bins)]
    code: Column = F.lit(bins - 1)
    for i in reversed(range(bins - 1)):
        code = F.when(F.col(TIME) <= edges[i], i).otherwise(code)
    return df.withColumn("time_bin", F.when(F.col(TIME).isNotNull(), code))


def time_crosstab(df: DataFrame, batch: str, bins: int = 4) -> DataFrame:
    """(batch, bin_0 .. bin_n): observations per batch and time bin."""
    binned = time_bins(df.filter(F.col(batch).isNotNull() & F.col(TIME).isNotNull()), bins)
    counts = [F.count_if(F.col("time_bin") == i).alias(f"bin_{i}") for i in range(bins)]
    return binned.groupBy(F.col(batch).alias("batch")).agg(*counts)


def severity(df: DataFrame, batch: str) -> DataFrame:
    """One row: n_batches, r2, correlation, severity, interpretable."""
    both = time_r2(df, batch).withColumn("k", F.lit(1)).join(time_correlation(df, batch).withColumn("k", F.lit(1)), "k").drop("k")
    level = F.lit("none")
    for bound, name in reversed(SEVERITIES):
        level = F.when(F.col("r2") >= bound, name).otherwise(level)
    verdict = F.when(F.coalesce("n_batches", F.lit(0)) < 2, "not_assessable").when(F.col("r2").isNull(), "unknown").otherwise(level)
    return both.select("n_batches", "r2", "correlation", verdict.alias("severity")).withColumn(
        "interpretable", F.col("severity").isin("none", "mild")
    )


def batch_policy(df: DataFrame, batch: str, min_size: int, policy: str) -> DataFrame:
    """`df` with `batch` (the label that is harmonized) and `estimable`; the stored column is never rewritten.

    report_and_exclude: small batches are not estimable. pool: small batches with the same scanner signature
    become one batch; one that stays alone is not estimable. passthrough: all are estimable.
    """
    if policy == "passthrough":
        return df.withColumns({"batch": F.col(batch), "estimable": F.col(batch).isNotNull()})
    # stored, since every reader of the labels would count again
    sizes = materialize(batch_sizes(df, batch, min_size).withColumnRenamed("batch", "__b").select("__b", "small"), "batch-sizes")
    labelled = df.join(sizes, F.col(batch) == F.col("__b"), "left").drop("__b")
    if policy == "report_and_exclude":
        return labelled.withColumns({"batch": F.col(batch), "estimable": ~F.coalesce("small", F.lit(True))}).drop("small")
    pools = pool_labels(df, batch, min_size).select(F.col("batch").alias("__b"), "pool")
    pooled = labelled.join(pools, F.col(batch) == F.col("__b"), "left").drop("__b")
    return pooled.withColumns(
        {"batch": F.coalesce("pool", F.col(batch)), "estimable": F.coalesce(~F.col("small"), F.lit(False)) | F.col("pool").isNotNull()}
    ).drop("small", "pool")


def pool_labels(df: DataFrame, batch: str, min_size: int) -> DataFrame:
    """(batch, signature, pool): small batches with the scanner signature of their first row; pool is null for one alone."""
    small = batch_sizes(df, batch, min_size).filter("small").select("batch")
    signature = F.concat_ws("/", F.coalesce("scanner_manufacturer", F.lit("?")), F.coalesce("scanner_model", F.lit("?")), F.coalesce(F.col("field_strength_tesla").cast("string"), F.lit("?")))
    rows = df.filter(F.col(batch).isNotNull()).select(F.col(batch).alias("batch"), signature.alias("signature"), "subject_id", "session_id", "region", "measure_type")
    first = first_rows(rows, ["batch"], ["subject_id", "session_id", "region", "measure_type"]).join(small, "batch").select("batch", "signature")
    together = first.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("batch")).alias("members"))
    pool = F.when(F.col("n") > 1, F.concat(F.lit("pool:"), F.array_join("members", "+")))
    return first.join(together, "signature").select("batch", "signature", pool.alias("pool"))
