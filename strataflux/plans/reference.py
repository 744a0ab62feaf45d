"""Queries of the analysis operators over the domain tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux import schema
from strataflux.config import AnalysisConfig, QcConfig, QcThresholds
from strataflux.functions.multiplicity import with_fdr
from strataflux.functions.robust import with_robust_z
from strataflux.operators import canonical, confound, harmonize, ledger, mixed, quality, rejects
from strataflux.operators.vocab import with_canonical_names
from strataflux.session import materialize
from strataflux.sources import stats_files
from strataflux.sources.tables import table

#: thresholds at which every flag occurs in the tables
RULES = QcThresholds(euler_min=-40.0, etiv_min=1.1e6, etiv_max=1.9e6)
MIN_BATCH = 60
COVARIATES = ("age_baseline", "sex", "dx_baseline", "time_from_baseline_years")
ID = ["subject_id", "session_id"]


def observations(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.canonical_observations(table(spark, folder, "observations"), table(spark, folder, "region_set"))


def _qc(spark: SparkSession, folder: str) -> DataFrame:
    return quality.apply_qc(materialize(observations(spark, folder), "canonical"), QcConfig(thresholds=RULES))


def _modeled(spark: SparkSession, folder: str) -> DataFrame:
    """Volumes and thicknesses with decoded covariates: what harmonization and models work on."""
    rows = observations(spark, folder).filter(F.col("measure_type").isin("volume", "thickness"))
    return canonical.covariate_codes(rows)


def canonical_long(spark: SparkSession, folder: str) -> DataFrame:
    return observations(spark, folder).select(*schema.KEY, "hemisphere", "site", "value", "etiv", "surface_holes_lh", "unit", "ingested_at")


def dup_keys(spark: SparkSession, folder: str) -> DataFrame:
    return schema.duplicate_keys(with_canonical_names(table(spark, folder, "observations"), table(spark, folder, "region_set")))


def null_violations(spark: SparkSession, folder: str) -> DataFrame:
    return schema.null_violations(table(spark, folder, "observations"))


def value_counts_null(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.value_counts(table(spark, folder, "observations"), ["site", "sex", "dx_baseline", "hemisphere", "freesurfer_version"])


def sessions_per_subject(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.sessions_per_subject(observations(spark, folder))


def metadata_coverage(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["scanner_manufacturer", "scanner_model", "field_strength_tesla", "freesurfer_version", "etiv"]
    return ledger.metadata_coverage(observations(spark, folder), fields)


def _roster(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.roster_of(table(spark, folder, "sessions"))


def expected_vs_found(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.expected_and_found(_roster(spark, folder), observations(spark, folder))


def missing_by_site(spark: SparkSession, folder: str) -> DataFrame:
    lost = ledger.discovery_losses(_roster(spark, folder), ledger.discovered_of(table(spark, folder, "subject_sessions")))
    return ledger.group_counts(lost.join(_roster(spark, folder).select(*ID, "site"), ID), "site", "cause")


def missing_by_time(spark: SparkSession, folder: str) -> DataFrame:
    lost = ledger.discovery_losses(_roster(spark, folder), ledger.discovered_of(table(spark, folder, "subject_sessions")))
    return ledger.group_counts(lost.join(_roster(spark, folder).select(*ID, "visit_index"), ID), "visit_index", "cause")


def region_loss_causes(spark: SparkSession, folder: str) -> DataFrame:
    losses = ledger.region_losses(observations(spark, folder), ledger.discovered_of(table(spark, folder, "subject_sessions")), table(spark, folder, "region_set"))
    return losses.groupBy("region", "cause").agg(F.count(F.lit(1)).alias("n"))


def baseline_first(spark: SparkSession, folder: str) -> DataFrame:
    order = ["time_from_baseline_years", "session_id", "region", "measure_type"]
    return ledger.baseline_rows(observations(spark, folder), ["site", "age_baseline", "sex", "dx_baseline", "etiv_baseline"], order)


def _completers(spark: SparkSession, folder: str) -> DataFrame:
    obs = materialize(canonical.covariate_codes(observations(spark, folder)), "canonical")
    base = ledger.baseline_rows(obs, ["age_baseline", "sex", "dx_baseline", "etiv_baseline"], ["time_from_baseline_years", "session_id", "region", "measure_type"])
    classes = ledger.expected_and_found(_roster(spark, folder), obs)
    return base.join(classes.select("subject_id", "class"), "subject_id")


def completer_smd(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.standardized_differences(ledger.continuous_summary(_completers(spark, folder), "class", ["age_baseline", "etiv_baseline"]))


def category_share(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.category_shares(_completers(spark, folder), "class", "sex")


def batch_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return confound.batch_sizes(observations(spark, folder), "site", MIN_BATCH)


def small_batch_composition(spark: SparkSession, folder: str) -> DataFrame:
    return confound.batch_composition(canonical.covariate_codes(observations(spark, folder)), "site", MIN_BATCH)


def robust_z(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialize(observations(spark, folder).select(*schema.KEY, "site", "value"), "values")
    return with_robust_z(rows, "value", ["site", "region", "measure_type"], "z").select(*schema.KEY, F.round("z", 6).alias("z"))


def etiv_euler_flags(spark: SparkSession, folder: str) -> DataFrame:
    return quality.session_flags(materialize(observations(spark, folder), "canonical"), RULES).select(
        *ID, "site", "euler", F.round("euler_z", 6).alias("euler_z"), "etiv_implausible", "euler_low"
    )


def asymmetry_flags(spark: SparkSession, folder: str) -> DataFrame:
    return quality.asymmetry(materialize(observations(spark, folder), "canonical"), RULES).select(
        *ID, "structure", "measure_type", F.round("asymmetry", 8).alias("asymmetry"), F.round("asymmetry_z", 6).alias("asymmetry_z"), "asymmetry_outlier"
    )


def qc_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _qc(spark, folder).select(*schema.KEY, "qc_status", F.array_join("qc_flags", "; ").alias("flags"), F.round("qc_score", 6).alias("qc_score"), "qc_notes", "analysis_included")


def qc_flag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _qc(spark, folder).select(F.explode("qc_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def qc_status_by_site(spark: SparkSession, folder: str) -> DataFrame:
    return _qc(spark, folder).groupBy("site", "qc_status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(*ID).alias("n_sessions"))


def inclusion_policy(spark: SparkSession, folder: str) -> DataFrame:
    wide = AnalysisConfig(include_qc_status=("PASS", "WARNING"))
    rows = _qc(spark, folder).withColumn("included", quality.included(F.col("qc_status"), wide))
    return rows.groupBy("measure_type").agg(F.count_if("included").alias("n_included"), F.count_if("analysis_included").alias("n_pass"), F.count(F.lit(1)).alias("n"))


def qc_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """FAIL or WARNING of the session flags against readings that no scan can give (holes negative or not whole)."""
    sessions = quality.session_flags(materialize(observations(spark, folder), "canonical"), RULES)
    truth = table(spark, folder, "observations").groupBy(*ID).agg(
        F.max(((F.col("surface_holes_lh") < 0) | (F.col("surface_holes_lh") > 80) | (F.col("etiv") < 6e5) | (F.col("etiv") > 2.5e6))).alias("bad")
    )
    flagged = sessions.withColumn("flagged", F.col("etiv_implausible") | F.col("euler_low")).join(truth, ID, "left")
    return quality.confusion(flagged, "flagged", "bad")


def time_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return confound.time_crosstab(materialize(observations(spark, folder), "canonical"), "site")


def confound_r2(spark: SparkSession, folder: str) -> DataFrame:
    """Time by site, and by a batch that changes with the fourth year, which is confounded by construction."""
    rows = materialize(observations(spark, folder).withColumn("era", F.when(F.col(confound.TIME) >= 0.5, "late").when(F.col("site").isNotNull(), F.col("site"))), "canonical")
    parts = [confound.severity(rows, b).withColumn("batch_column", F.lit(b)) for b in ("site", "era")]
    return parts[0].unionByName(parts[1]).select(
        "batch_column", "n_batches", F.round("r2", 8).alias("r2"), F.round("correlation", 8).alias("correlation"), "severity", "interpretable"
    )


def pool_signature(spark: SparkSession, folder: str) -> DataFrame:
    return confound.pool_labels(observations(spark, folder), "site", 150)


def batch_policy_mask(spark: SparkSession, folder: str) -> DataFrame:
    masked = confound.batch_policy(observations(spark, folder), "site", MIN_BATCH, "report_and_exclude")
    return masked.groupBy("batch", "estimable").agg(F.count(F.lit(1)).alias("n"))


def _batched(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(confound.batch_policy(_modeled(spark, folder), "site", 20, "report_and_exclude"), "batched")


def _included(spark: SparkSession, folder: str) -> DataFrame:
    """What models are fitted on: rows that pass quality control, with decoded covariates and their batch."""
    # what quality control, harmonization and models read; other columns would be stored and sent along four times
    needed = [*schema.KEY, "hemisphere", "site", "value", "time_from_baseline_years", "age_baseline", "sex", "dx_baseline", "etiv", "etiv_baseline", "surface_holes_lh", "surface_holes_rh"]
    judged = quality.apply_qc(materialize(observations(spark, folder).select(*needed), "canonical"), QcConfig(thresholds=RULES))
    rows = canonical.covariate_codes(judged.filter(F.col("analysis_included") & F.col("measure_type").isin("volume", "thickness")))
    modeled = [*schema.KEY, "site", "value", "time_from_baseline_years", "age_baseline", "sex", "dx_baseline", "etiv_baseline"]
    return confound.batch_policy(materialize(rows.select(*modeled), "included"), "site", 20, "report_and_exclude")


def combat_moments(spark: SparkSession, folder: str) -> DataFrame:
    rows = harmonize.moments(_batched(spark, folder).filter("estimable"), harmonize.Design((), {}))
    return rows.select("region", "measure_type", "batch", "n", F.round("y", 8).alias("mean"), F.round("yy", 8).alias("variance"))


def combat_no_eb(spark: SparkSession, folder: str) -> DataFrame:
    """Location and scale per feature and batch, without covariates and shrinkage."""
    design = harmonize.Design((), {})
    params = harmonize.parameters(harmonize.moments(_batched(spark, folder).filter("estimable"), design), design)
    rounded = [F.round(c, 6).alias(c) for c in ("grand", "sigma", "gamma", "delta")]
    return params.select("region", "measure_type", "batch", "n", *rounded)


def combat_priors(spark: SparkSession, folder: str) -> DataFrame:
    design = harmonize.Design((), {})
    params = harmonize.parameters(harmonize.moments(_batched(spark, folder).filter("estimable"), design), design)
    return harmonize.batch_priors(params).select("batch", "n_features", *[F.round(c, 6).alias(c) for c in ("gamma_mean", "gamma_var", "delta_mean", "delta_var")])


def combat_eb(spark: SparkSession, folder: str) -> DataFrame:
    _, params, _ = harmonize.combat(_included(spark, folder), COVARIATES, estimate_on="estimable")
    return params.select("region", "measure_type", "batch", "n", "grand", "sigma", "gamma", "gamma_star", "delta", "delta_star", "iterations", "converged", "skip")


def harmonized(spark: SparkSession, folder: str) -> DataFrame:
    adjusted, _, _ = harmonize.combat(_included(spark, folder), COVARIATES, estimate_on="estimable")
    return adjusted.select(*schema.KEY, "site", "value", "value_adjusted")


def site_r2_after(spark: SparkSession, folder: str) -> DataFrame:
    """(region, r2_before, r2_after): share of the variation of values between sites, before and after harmonization."""
    rows = harmonized(spark, folder).filter("site IS NOT NULL AND value IS NOT NULL")
    per = rows.groupBy("region", "site").agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}_{c}") for c in ("value", "value_adjusted") for k, f in (("m", F.avg), ("v", F.var_pop))]
    )

    def r2(c: str) -> F.Column:
        total = F.sum("n")
        grand = F.sum(F.col("n") * F.col(f"m_{c}")) / total
        between = F.sum(F.col("n") * F.col(f"m_{c}") * F.col(f"m_{c}")) - total * grand * grand
        return F.try_divide(between, between + F.sum(F.col("n") * F.col(f"v_{c}")))

    return per.groupBy("region").agg(r2("value").alias("r2_before"), r2("value_adjusted").alias("r2_after"))


def ols_slope_by_region(spark: SparkSession, folder: str) -> DataFrame:
    rows = _modeled(spark, folder).filter("value IS NOT NULL AND time_from_baseline_years IS NOT NULL")
    time = F.col("time_from_baseline_years")
    slope = F.try_divide(F.covar_pop(time, "value"), F.var_pop(time))
    return rows.groupBy("region", "measure_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(slope, 6).alias("slope"), F.round(F.avg("value") - slope * F.avg(time), 4).alias("intercept")
    )


def reml_fit(spark: SparkSession, folder: str) -> DataFrame:
    return mixed.fit_regions(_included(spark, folder))


def results_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return mixed.results_table(reml_fit(spark, folder))


def arms_compare(spark: SparkSession, folder: str) -> DataFrame:
    """The primary effect with and without harmonization."""
    rows = _included(spark, folder)
    adjusted, _, _ = harmonize.combat(rows, COVARIATES, estimate_on="estimable")
    fits = mixed.fit_arms(adjusted, {"harmonized": "value_adjusted", "as_is": "value"})
    return mixed.compare_arms(mixed.results_table(fits["harmonized"]), mixed.results_table(fits["as_is"]))


def bh_fdr(spark: SparkSession, folder: str) -> DataFrame:
    """Per structure and measure the test whether a site's means of both sides lie off the overall ones, adjusted over the sites.

    The sum of the two squared z scores has a chi-squared distribution of two degrees of freedom (sides taken as
    independent), of which the tail probability is exp(-x / 2).
    """
    rows = _modeled(spark, folder).filter("value IS NOT NULL AND site IS NOT NULL AND hemisphere IN ('lh', 'rh')")
    per = rows.groupBy("region", "hemisphere", "measure_type", "site").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"))
    whole = rows.groupBy("region", "measure_type").agg(F.avg("value").alias("gm"), F.stddev_pop("value").alias("sd"))
    z = (F.col("m") - F.col("gm")) / (F.col("sd") / F.sqrt("n"))
    sides = per.join(whole, ["region", "measure_type"]).select(quality.structure_of(F.col("region"), F.col("hemisphere")).alias("structure"), "measure_type", "site", (z * z).alias("zz"))
    both = sides.groupBy("structure", "measure_type", "site").agg(F.sum("zz").alias("x"), F.count(F.lit(1)).alias("k")).filter("k = 2")
    tests = both.withColumn("p_value", F.round(F.exp(-F.col("x") / 2), 9))
    return with_fdr(tests, ["structure", "measure_type"]).select("structure", "measure_type", "site", "p_value", F.round("q_value", 8).alias("q_value"))


def model_exclusions(spark: SparkSession, folder: str) -> DataFrame:
    qc = materialize(canonical.covariate_codes(_qc(spark, folder)), "qc")
    rows = qc.filter(F.coalesce("analysis_included", F.lit(False)) & F.col("measure_type").isin("volume", "thickness"))
    subjects = mixed.model_rows(rows).groupBy("region", "measure_type").agg(F.countDistinct("subject_id").alias("k"))
    fits = subjects.select("region", "measure_type", (F.col("k") >= mixed.MIN_SUBJECTS).alias("estimable"))
    complete = F.lit(True)
    for c in ("value", "time_from_baseline_years", "age_baseline", "sex", "dx_baseline", "etiv_baseline"):
        complete = complete & F.col(c).isNotNull()
    complete = complete & F.col("dx_baseline").isin("patient", "control")
    return ledger.model_exclusions(qc, fits, F.coalesce(complete, F.lit(False)))


def funnel(spark: SparkSession, folder: str) -> DataFrame:
    qc = materialize(_qc(spark, folder), "qc")
    roster = materialize(_roster(spark, folder), "roster")
    discovered = materialize(ledger.discovered_of(table(spark, folder, "subject_sessions")), "discovered")
    return ledger.funnel(roster, discovered, qc, qc, table(spark, folder, "region_set")).drop("position")


def merge_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters per load, as separate runs leave them, added up."""
    obs = table(spark, folder, "observations")
    per = obs.groupBy("dataset_version", F.lower(F.trim("measure_type")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return ledger.merge_counters(per.select(F.lit("rows_by_measure").alias("metric"), "key", "n"))


def checksum(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_stats").select("file_id", F.sha2(F.encode("content", "UTF-8"), 256).alias("checksum"), F.octet_length("content").cast("bigint").alias("size_bytes"))


def header_kv(spark: SparkSession, folder: str) -> DataFrame:
    return stats_files.header_fields(table(spark, folder, "raw_stats"))


def file_versions(spark: SparkSession, folder: str) -> DataFrame:
    fields = stats_files.header_fields(table(spark, folder, "raw_stats")).filter("key = 'cvs_version'")
    return fields.groupBy("value").agg(F.count(F.lit(1)).alias("n_files")).select(F.col("value").alias("declaration"), stats_files.version_of(F.col("value")).alias("version"), "n_files")


def parse_failures(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_stats")
    return stats_files.all_verdicts(raw, rejects.read_permissively(raw))


def parsed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return stats_files.canonical_rows(table(spark, folder, "raw_stats"), table(spark, folder, "region_set"))


def file_globals(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_stats")
    return stats_files.session_globals(raw, rejects.read_permissively(raw))


def wide_to_long(spark: SparkSession, folder: str) -> DataFrame:
    """A wide table of one row per session and one column per volume, in long form again."""
    regions = table(spark, folder, "region_set").filter("measure_type = 'volume'").select("region")
    names = sorted(r.region for r in regions.limit(10_000).collect())
    rows = observations(spark, folder).filter("measure_type = 'volume'").withColumn("key", F.concat_ws("|", *ID))
    wide = rows.groupBy("key").pivot("region", names).agg(F.max("value"))
    return canonical.wide_to_long(wide, "key", regions.select(F.col("region").alias("source_name"), "region"), "volume", "mm^3")


QUERIES = {
    f.__name__: f
    for f in (
        canonical_long, dup_keys, null_violations, value_counts_null, sessions_per_subject, metadata_coverage, expected_vs_found, missing_by_site,
        missing_by_time, region_loss_causes, baseline_first, completer_smd, category_share, batch_sizes, small_batch_composition, robust_z,
        etiv_euler_flags, asymmetry_flags, qc_flags, qc_flag_counts, qc_status_by_site, inclusion_policy, qc_confusion, time_crosstab, confound_r2,
        pool_signature, batch_policy_mask, combat_moments, combat_no_eb, combat_priors, combat_eb, harmonized, site_r2_after, ols_slope_by_region,
        reml_fit, results_pivot, arms_compare, bh_fdr, model_exclusions, funnel, merge_counters, checksum, header_kv, file_versions, parse_failures,
        parsed_rows, file_globals, wide_to_long,
    )
}
