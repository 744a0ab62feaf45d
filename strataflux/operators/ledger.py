"""Loss accounting: every row that a step drops has a counted cause, and each boundary must reconcile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.operators.confound import first_rows
from strataflux.operators.scaling import null_safe_join

ID = ["subject_id", "session_id"]
SMD_NOTABLE = 0.1


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, value, n) of several columns in one pass; null is `<null>`, an absent column gives no rows."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "field string, value string, n bigint")
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias("value")) for c in present])
    return df.select(F.explode(cells).alias("c")).groupBy("c.field", "c.value").agg(F.count(F.lit(1)).alias("n"))


def sessions_per_subject(df: DataFrame) -> DataFrame:
    """(n_sessions, n_subjects): how many subjects have how many different sessions."""
    per = df.select(*ID).distinct().groupBy("subject_id").agg(F.count(F.lit(1)).alias("n_sessions"))
    return per.groupBy("n_sessions").agg(F.count(F.lit(1)).alias("n_subjects"))


def metadata_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, n_rows, n_present, coverage)."""
    stats = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in columns])
    return stats.unpivot(["n_rows"], list(columns), "field", "n_present").withColumn("coverage", F.try_divide(F.col("n_present"), F.col("n_rows")))


def group_counts(df: DataFrame, group: str, cause: str) -> DataFrame:
    """(group, cause, n); a null group is `unknown`."""
    return df.groupBy(F.coalesce(F.col(group).cast("string"), F.lit("unknown")).alias("group"), F.col(cause).alias("cause")).agg(
        F.count(F.lit(1)).alias("n")
    )


def roster_of(sessions: DataFrame) -> DataFrame:
    """One row per expected session; of repeated rows the one registered first."""
    columns = ["subject_id", "session_id", "site", "visit_index", "missing_cause", "time_from_baseline_years"]
    return first_rows(sessions.select(*columns, "registered_at"), ID, ["registered_at", "visit_index", "site"]).select(*columns)


def discovered_of(subject_sessions: DataFrame) -> DataFrame:
    """(subject_id, session_id, files): one row per session found, ids without outer blanks in upper and lower case as the roster has them."""
    subject = F.upper(F.trim("subject_id"))
    files = F.coalesce("stats_files", F.array().cast("array<string>"))
    return (
        subject_sessions.select(subject.alias("subject_id"), F.lower(F.trim("session_id")).alias("session_id"), files.alias("files"))
        .groupBy(*ID)
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("files")))).alias("files"))
    )


def expected_and_found(roster: DataFrame, found: DataFrame) -> DataFrame:
    """(subject_id, expected, observed, class): completer, partial or absent; sessions outside the roster don't count."""
    hit = roster.select(*ID).distinct().join(found.select(*ID).distinct().withColumn("hit", F.lit(1)), ID, "left")
    per = hit.groupBy("subject_id").agg(F.count(F.lit(1)).alias("expected"), F.coalesce(F.sum("hit"), F.lit(0)).cast("bigint").alias("observed"))
    cls = F.when(F.col("observed") == 0, "absent").when(F.col("observed") == F.col("expected"), "completer").otherwise("partial")
    return per.withColumn("class", cls)


def baseline_rows(observations: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per subject: the first non-null value of each column by `order`."""
    key = F.struct(*order)
    return observations.groupBy("subject_id").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), key)).alias(c) for c in columns])


def continuous_summary(df: DataFrame, cls: str, columns: Sequence[str]) -> DataFrame:
    """(class, field, n, mean, sd): sd is 0 for a single value."""
    long = df.select(F.col(cls).alias("class"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["class"], list(columns), "field", "x")
    agg = long.filter("x IS NOT NULL").groupBy("class", "field").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"))
    return agg.withColumn("sd", F.when(F.col("n") == 1, 0.0).otherwise(F.col("sd")))


def standardized_differences(summary: DataFrame, a: str = "completer", b: str = "partial") -> DataFrame:
    """(field, n_a, n_b, smd, notable): difference of means over the pooled SD, null without spread."""
    sides = summary.groupBy("field").agg(
        *[F.max(F.when(F.col("class") == c, F.col(k))).alias(f"{k}_{s}") for s, c in (("a", a), ("b", b)) for k in ("n", "mean", "sd")]
    )
    pooled = F.sqrt((F.col("sd_a") * F.col("sd_a") + F.col("sd_b") * F.col("sd_b")) / 2)
    smd = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.when(pooled != 0, pooled))
    return sides.select("field", "n_a", "n_b", smd.alias("smd")).withColumn("notable", F.coalesce(F.abs("smd") >= SMD_NOTABLE, F.lit(False)))


def category_shares(df: DataFrame, cls: str, column: str) -> DataFrame:
    """(class, level, n, share) within each class; classes are few, so the window runs on a small table."""
    from pyspark.sql import Window

    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(cls).alias("class"), F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("class")))


def file_for(measure: Column, hemisphere: Column) -> Column:
    """The table that a region of the vocabulary comes from."""
    return F.when(measure == "volume", F.lit("aseg.stats")).otherwise(F.concat(hemisphere, F.lit(".aparc.stats")))


def sound_files(discovered: DataFrame, failures: DataFrame) -> DataFrame:
    """`discovered` with only those files that have no verdict, and `n_files`, the number of all."""
    bad = failures.select(F.col("source_file").alias("file"), F.lit(True).alias("bad")).distinct()
    files = discovered.select(*ID, F.explode("files").alias("file")).join(bad, "file", "left")
    kept = files.groupBy(*ID).agg(F.collect_set(F.when(F.col("bad").isNull(), F.col("file"))).alias("sound"))
    return discovered.withColumn("n_files", F.size("files")).join(kept, ID, "left").withColumn("files", F.coalesce("sound", F.array().cast("array<string>"))).drop("sound")


def region_losses(observations: DataFrame, discovered: DataFrame, region_set: DataFrame) -> DataFrame:
    """(subject_id, session_id, region, cause) of every region of the vocabulary that a producing session lacks.

    Regions present are collected per session (at most the vocabulary's size) and taken from the vocabulary,
    so the loss is found without pairing sessions and regions in a join.
    """
    vocabulary = region_set.select("region", file_for(F.col("measure_type"), F.col("hemisphere")).alias("file")).agg(
        F.collect_set(F.struct("region", "file")).alias("vocabulary")
    )
    known = region_set.select("region", F.lit(True).alias("known"))
    present = observations.join(known, "region").groupBy(*ID).agg(F.collect_set("region").alias("present"))
    names = F.transform("files", lambda f: F.lower(F.substring_index(f, "/", -1)))
    with_files = present.join(discovered.withColumn("names", names).select(*ID, "names"), ID, "left")
    # the vocabulary is one row
    absent = with_files.join(vocabulary, F.lit(True), "inner").select(
        *ID, "names", F.explode(F.filter("vocabulary", lambda v: ~F.array_contains("present", v["region"]))).alias("v")
    )
    cause = (
        F.when(F.col("names").isNull(), "observation_loss_cause_unavailable")
        .when(F.array_contains("names", F.col("v.file")), "absent_from_source")
        .otherwise("source_unavailable")
    )
    return absent.select(*ID, "v.region", cause.alias("cause"))


def discovery_losses(roster: DataFrame, discovered: DataFrame) -> DataFrame:
    """(subject_id, session_id, cause) of expected sessions that were not found."""
    cause = F.when(F.col("missing_cause") == "missing_acquisition", F.col("missing_cause")).otherwise("undocumented_absence")
    return roster.join(discovered.select(*ID), ID, "left_anti").select(*ID, cause.alias("cause"))


def resolution_losses(discovered: DataFrame, observations: DataFrame) -> DataFrame:
    """(subject_id, session_id, cause) of found sessions without observations; all_files_rejected needs `n_files` of `sound_files`."""
    cause = F.when(F.size("files") == 0, "missing_derivative").otherwise("no_recognised_regions")
    if "n_files" in discovered.columns:
        cause = F.when((F.col("n_files") > 0) & (F.size("files") == 0), "all_files_rejected").otherwise(cause)
    return discovered.join(observations.select(*ID).distinct(), ID, "left_anti").select(*ID, cause.alias("cause"))


def model_exclusions(qc: DataFrame, fits: DataFrame, complete: Column) -> DataFrame:
    """(cause, n) of included rows that no fit used: region not attempted, design not identifiable, incomplete covariates."""
    regions = fits.groupBy("region", "measure_type").agg(F.max("estimable").alias("estimable"))
    rows = null_safe_join(qc.filter(F.coalesce("analysis_included", F.lit(False))), regions, ["region", "measure_type"])
    cause = (
        F.when(F.col("estimable").isNull(), "outside_modeled_region_set")
        .when(~F.col("estimable"), "design_not_identifiable")
        .when(~complete, "incomplete_model_covariates")
    )
    return rows.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("n")).filter("cause IS NOT NULL")


def boundary(position: int, name: str, unit: str, count: DataFrame, losses: DataFrame | None) -> DataFrame:
    """One funnel row: (position, boundary, unit, count, lost, causes, explained); `losses` has one row per lost unit, or a count `n`."""
    units = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint") if "n" in count.columns else F.count(F.lit(1))
    n = count.agg(units.alias("count")).withColumn("k", F.lit(1))
    if losses is None:
        caused = n.select("k", F.lit(0).cast("bigint").alias("lost"), F.lit("").alias("causes"))
    else:
        amount = F.sum("n") if "n" in losses.columns else F.count(F.lit(1))
        per = losses.groupBy("cause").agg(amount.cast("bigint").alias("n"))
        text = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "cause", F.col("n").cast("string")))), "; ")
        caused = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("lost"), text.alias("causes")).withColumn("k", F.lit(1))
    return n.join(caused, "k").select(F.lit(position).alias("position"), F.lit(name).alias("boundary"), F.lit(unit).alias("unit"), "count", "lost", "causes")


def funnel(
    roster: DataFrame, discovered: DataFrame, observations: DataFrame, qc: DataFrame, region_set: DataFrame,
    failures: DataFrame | None = None, modeled: DataFrame | None = None, exclusions: DataFrame | None = None,
) -> DataFrame:
    """The loss funnel from expected sessions to modeled observations.

    Parsed files are a boundary where `failures` (source_file, failure_code) is given, and only files without a verdict
    then make a region's source available; modeled observations are one where `modeled` (n, per fit) and
    `exclusions` (cause, n) are given. They count all rows that the inclusion policy lets into the models.
    Sessions that were found but not expected, and observations outside the vocabulary, are none of its units.
    """
    expected = discovered.join(roster.select(*ID), ID, "left_semi")
    known = observations.join(region_set.select("region", "measure_type"), ["region", "measure_type"], "left_semi").join(expected.select(*ID), ID, "left_semi")
    judged = qc.join(region_set.select("region", "measure_type"), ["region", "measure_type"], "left_semi").join(expected.select(*ID), ID, "left_semi")
    found, parsed = discovered, expected
    if failures is not None:
        found, parsed = sound_files(discovered, failures), sound_files(expected, failures)
    passing = F.coalesce(F.col("qc_status") == "PASS", F.lit(False))
    parts = [
        boundary(1, "expected sessions", "sessions", roster, None),
        boundary(2, "discovered sessions", "sessions", expected, discovery_losses(roster, discovered)),
        boundary(3, "sessions with observations", "sessions", known.select(*ID).distinct(), resolution_losses(parsed, known)),
        boundary(4, "canonical observations", "observations", known, region_losses(known, found, region_set)),
        boundary(5, "QC-passing observations", "observations", judged.filter(passing), judged.filter(~passing).select(F.lit("excluded_qc").alias("cause"))),
    ]
    if failures is not None:
        files = expected.select(F.explode("files").alias("source_file"))
        rejects = failures.groupBy("source_file").agg(F.min("failure_code").alias("cause")).join(files, "source_file", "left_semi")
        parts.append(boundary(6, "parsed files", "files", parsed.select(F.explode("files")), rejects.select("cause")))
    if modeled is not None:
        parts.append(boundary(7, "modeled observations", "observations", modeled, exclusions))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(funnel_rows: DataFrame, regions: int, files: int | None = None, included: int | None = None) -> list[str]:
    """Messages for every boundary where the count before, less the counted losses, isn't the count after.

    `files` and `included` are the units before the boundaries of parsed files and of modeled observations.
    """
    rows = {r.position: r for r in funnel_rows.collect()}
    wanted = {2: rows[1]["count"], 3: rows[2]["count"], 4: rows[3]["count"] * regions, 5: rows[4]["count"]}
    wanted |= {i: n for i, n in ((6, files), (7, included)) if i in rows and n is not None}
    return [
        f"{rows[i].boundary}: {before} before, {rows[i].lost} lost, {rows[i]['count']} after"
        for i, before in wanted.items()
        if before - rows[i].lost != rows[i]["count"]
    ]


def merge_counters(counters: DataFrame) -> DataFrame:
    """(metric, key, n) frames of separate runs added up."""
    return counters.groupBy("metric", "key").agg(F.sum("n").cast("bigint").alias("n"))
