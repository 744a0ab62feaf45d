"""The stages from files to results; every stage reads and writes tables, so each can run alone."""

from __future__ import annotations

import json
import platform
import subprocess
from datetime import datetime, timezone
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux import __version__, schema
from strataflux.config import RunConfig
from strataflux.operators import confound, harmonize, ledger, mixed, quality, rejects
from strataflux.sources import stats_files
from strataflux.sources.adapters import Adapter, build_adapter, listing

ID = ["subject_id", "session_id"]


def save(df: DataFrame, outdir: str, name: str) -> DataFrame:
    path = f"{outdir}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load(spark: SparkSession, outdir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{outdir}/{name}.parquet")


def adapter_of(spark: SparkSession, config: RunConfig, subject: str | None = None) -> Adapter:
    if not config.dataset.root:
        raise ValueError("the configuration names no dataset root")
    return build_adapter(spark, config.dataset.adapter, config.dataset.root, subject, config.dataset.phenotype)


def unmatched_files(listed: DataFrame, owned: DataFrame, whole: bool) -> DataFrame:
    """(source_file, failure_code, line_number) of files that the join of discovery and reading would lose.

    `UNCLAIMED_FILE` belongs to no discovered session (in a run over one subject, other subjects' files do not count),
    `NOT_READ` was discovered but is not among the files that were read.
    """
    names = lambda a, b: a.select("source_file").join(b.select("source_file"), "source_file", "left_anti")
    code = lambda df, c: df.select("source_file", F.lit(c).alias("failure_code"), F.lit(0).cast("bigint").alias("line_number"))
    missing = code(names(owned, listed), "NOT_READ")
    return missing.unionByName(code(names(listed, owned), "UNCLAIMED_FILE")) if whole else missing


def ingest(spark: SparkSession, config: RunConfig, region_set: DataFrame, outdir: str, subject: str | None = None) -> DataFrame:
    """observations, parse_failures, discovered, roster and counters from the files of a dataset."""
    adapter = adapter_of(spark, config, subject)
    discovered = save(adapter.discover(), outdir, "discovered")
    save(adapter.roster(), outdir, "roster")
    listed = stats_files.list_files(spark, config.dataset.root).withColumn("file_id", F.xxhash64("source_file"))
    owned = discovered.select(*ID, F.explode("files").alias("source_file"))
    lost = unmatched_files(listed, owned, whole=subject is None)
    raw = save(listed.join(owned, "source_file"), outdir, "raw_files")
    lines = rejects.read_permissively(raw)
    failures = stats_files.all_verdicts(raw, lines).join(raw.select("file_id", "source_file"), "file_id").select("source_file", "failure_code", "line_number")
    failures = save(failures.unionByName(lost), outdir, "parse_failures")
    owner = raw.select("file_id", *ID, "source_file", stats_files.table_type(F.col("source_file"), F.col("content")).alias("kind"))
    per_file = stats_files.session_globals(raw, lines).join(owner, "file_id")
    # volume and hole counts are the subcortical table's, the version is the first that a file of the session declares
    values = per_file.groupBy(*ID).agg(
        *[F.max(F.when(F.col("kind") == "aseg", F.col(c))).alias(c) for c in ("etiv", "surface_holes_lh", "surface_holes_rh")],
        F.min_by("freesurfer_version", F.when(F.col("freesurfer_version").isNotNull(), F.struct(F.col("kind") != "aseg", "source_file"))).alias("freesurfer_version"),
    )
    save(per_file.select("source_file", "version_declaration", "freesurfer_version", "measures_overwritten"), outdir, "file_versions")
    rows = stats_files.canonical_rows(raw, region_set).join(raw.select("file_id", *ID, "source_file_checksum"), "file_id")
    full = rows.join(values, ID, "left").join(adapter.metadata(discovered), ID, "left").drop("file_id")
    now = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
    stamped = full.withColumns(
        {"dataset": F.lit(config.dataset.name), "dataset_version": F.lit(config.dataset.version), "parser_version": F.lit(__version__), "ingested_at": F.lit(now)}
    )
    observations = schema.one_row_per_key(schema.conform(stamped), F.col("source_file"))
    schema.write_canonical(observations, f"{outdir}/observations.parquet")
    observations = schema.read_canonical(spark, f"{outdir}/observations.parquet")
    counts = [
        raw.select(F.lit("files").alias("metric"), F.lit("discovered").alias("key")),
        failures.select(F.lit("files_rejected").alias("metric"), F.col("failure_code").alias("key")),
        observations.select(F.lit("observations").alias("metric"), F.col("measure_type").alias("key")),
        observations.filter("freesurfer_version IS NOT NULL").select(F.lit("observations_by_version").alias("metric"), F.col("freesurfer_version").alias("key")),
    ]
    counters = counts[0]
    for c in counts[1:]:
        counters = counters.unionByName(c)
    save(counters.groupBy("metric", "key").agg(F.count(F.lit(1)).alias("n")), outdir, "ingest_counters")
    return observations


def run_qc(spark: SparkSession, config: RunConfig, outdir: str) -> DataFrame:
    observations = schema.read_canonical(spark, f"{outdir}/observations.parquet")
    return save(quality.apply_qc(observations, config.qc, config.analysis), outdir, "qc_observations")


def run_harmonize(spark: SparkSession, config: RunConfig, outdir: str) -> DataFrame:
    """harmonized_observations (value replaced, value_original kept) and the parameters; unchanged where it can't apply."""
    h = config.harmonization
    rows = load(spark, outdir, "qc_observations")
    labelled = confound.batch_policy(rows, h.batch_column, h.min_batch_size, h.small_batch_policy)
    usable = labelled.filter("estimable").agg(F.countDistinct("batch")).first()[0]
    save(confound.severity(rows, h.batch_column), outdir, "confounding")
    if not h.enabled or usable < 2:
        return save(rows.withColumn("value_original", F.col("value")), outdir, "harmonized_observations")
    judged = rows.agg(F.max(F.col("analysis_included").isNotNull())).first()[0]
    use = F.col("estimable") & (F.coalesce("analysis_included", F.lit(False)) if h.estimation_set == "analysis_included" and judged else F.lit(True))
    adjusted, params, design = harmonize.combat(
        labelled.withColumn("estimate_on", use), h.covariates, estimate_on="estimate_on", empirical_bayes=h.empirical_bayes, tolerance=h.eb_tolerance,
        max_iterations=h.eb_max_iterations,
    )
    save(params, outdir, "harmonization_parameters")
    changed = harmonize.n_values_changed(adjusted)
    skipped = params.filter("skip <> ''").groupBy("skip").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("skipped: "), "skip").alias("note"), "n")
    dropped = [(f"covariate {c}: {why}", 1) for c, why in sorted(design.dropped.items())]
    record = spark.createDataFrame([("values changed", changed), *dropped], "note string, n bigint").unionByName(skipped)
    save(record, outdir, "harmonization_record")
    out = adjusted.withColumns({"value_original": F.col("value"), "value": F.col("value_adjusted")})
    return save(out.drop("value_adjusted", "batch", "estimable", "estimate_on", *design.names), outdir, "harmonized_observations")


def run_model(spark: SparkSession, config: RunConfig, outdir: str) -> DataFrame:
    """model_results of the harmonized arm, model_results_unharmonized, and arm_comparison."""
    included = F.coalesce("analysis_included", F.lit(False))
    harmonized = load(spark, outdir, "harmonized_observations").filter(included)
    fits = mixed.fit_regions(harmonized)
    results = save(mixed.results_table(fits), outdir, "model_results")
    save(mixed.family_sizes(fits), outdir, "test_families")
    changed = listing(spark, f"{outdir}/harmonization_record.parquet") and load(spark, outdir, "harmonization_record").filter("note = 'values changed' AND n > 0").count()
    if not changed:
        # both arms have the same numbers, which would be no comparison
        save(mixed.compare_arms(results, results, config.analysis.alpha).filter(F.lit(False)), outdir, "arm_comparison")
        return results
    other = save(mixed.results_table(mixed.fit_regions(load(spark, outdir, "qc_observations").filter(included))), outdir, "model_results_unharmonized")
    save(mixed.compare_arms(results, other, config.analysis.alpha), outdir, "arm_comparison")
    return results


def run_accounting(spark: SparkSession, config: RunConfig, region_set: DataFrame, outdir: str) -> list[str]:
    """Writes the funnel; returns the boundaries that don't reconcile."""
    qc = load(spark, outdir, "qc_observations")
    discovered = load(spark, outdir, "discovered")
    roster = load(spark, outdir, "roster")
    if roster.isEmpty():
        roster = discovered.select(*ID, F.lit(None).cast("string").alias("missing_cause"), F.lit(None).cast("string").alias("site"))
    failures = load(spark, outdir, "parse_failures")
    files = discovered.join(roster.select(*ID), ID, "left_semi").select(F.explode("files").alias("file")).distinct().count()
    modeled = exclusions = included = None
    if listing(spark, f"{outdir}/model_results.parquet"):
        fits = load(spark, outdir, "model_results")
        modeled = fits.filter("estimable").groupBy("region", "measure_type").agg(F.max("n_observations").alias("n"))
        taken = load(spark, outdir, "harmonized_observations")
        exclusions = ledger.model_exclusions(taken, fits, mixed.is_complete())
        included = taken.filter(F.coalesce("analysis_included", F.lit(False))).count()
    rows = save(ledger.funnel(roster, discovered, qc, qc, region_set, failures, modeled, exclusions), outdir, "accounting_funnel")
    return ledger.reconcile(rows, region_set.count(), files, included)


def _git(*args: str) -> str | None:
    done = subprocess.run(["git", *args], capture_output=True, text=True, cwd=Path(__file__).parent)
    return done.stdout.strip() if done.returncode == 0 else None


def provenance(spark: SparkSession, config: RunConfig) -> dict:
    return {
        "version": __version__, "schema_version": "1.0.0", "spark": pyspark.__version__, "python": platform.python_version(),
        "captured_at": datetime.now(timezone.utc).isoformat(), "commit": _git("rev-parse", "HEAD"), "dirty": bool(_git("status", "--porcelain")),
        "settings": {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone")},
        "config": config.model_dump(mode="json"),
    }


def run(spark: SparkSession, config: RunConfig, region_set: DataFrame, outdir: str) -> list[str]:
    """All stages; the return value lists boundaries that don't reconcile."""
    from strataflux.plans import report

    ingest(spark, config, region_set, outdir)
    run_qc(spark, config, outdir)
    run_harmonize(spark, config, outdir)
    run_model(spark, config, outdir)
    errors = run_accounting(spark, config, region_set, outdir)
    Path(outdir, "provenance.json").write_text(json.dumps(provenance(spark, config), indent=2))
    Path(outdir, "report.html").write_text(report.render(report.collect_summaries(spark, config, outdir), provenance(spark, config), errors))
    return errors


def collect(spark: SparkSession, sources: list[str], outdir: str) -> None:
    """Put the ingest results of several runs together: tables are united, counters added up."""
    schema.write_canonical(schema.read_canonical(spark, *[f"{s}/observations.parquet" for s in sources]), f"{outdir}/observations.parquet")
    for name in ("parse_failures", "discovered", "roster"):
        save(spark.read.parquet(*[f"{s}/{name}.parquet" for s in sources]).distinct(), outdir, name)
    save(ledger.merge_counters(spark.read.parquet(*[f"{s}/ingest_counters.parquet" for s in sources])), outdir, "ingest_counters")


__all__ = ["adapter_of", "collect", "ingest", "provenance", "run", "run_accounting", "run_harmonize", "run_model", "run_qc"]
