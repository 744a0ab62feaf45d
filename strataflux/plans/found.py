"""Queries of the general training-data operators (p1 to p6) over the tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.operators import drift, orphans, profile, rejects, spikes, widen
from strataflux.sources.tables import table

PROFILED_NUMERIC = ("surface_holes_lh", "field_strength_tesla")
PROFILED_TEXT = ("freesurfer_version", "sex")


def _implausible(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    observations, regions = table(spark, folder, "observations"), table(spark, folder, "region_set")
    return spikes.implausible_readings(spikes.readings_of(observations, regions), sources=spikes.sources_of(observations, regions))


def p1_tests(spark: SparkSession, folder: str) -> DataFrame:
    """Every flag of the tests with its score, whether or not the exact rule confirms it."""
    return _implausible(spark, folder)[0]


def p1_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Limits, stuck runs, and as `apart` those spikes and shifted readings that the exact rule confirms."""
    kind = F.when(F.col("kind").isin("spike", "shift"), "apart").otherwise(F.col("kind"))
    return p1_tests(spark, folder).filter("beyond").select(*spikes.SOURCE, *spikes.SESSION, kind.alias("kind")).distinct()


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_flags(spark, folder).select("field", "subject_id", "session_id", "region").distinct()


def p1_level_shifts(spark: SparkSession, folder: str) -> DataFrame:
    return _implausible(spark, folder)[1]


def p2_wide(spark: SparkSession, folder: str) -> DataFrame:
    observations, regions = table(spark, folder, "observations"), table(spark, folder, "region_set")
    return widen.widen(widen.cells_of(observations, regions), attributes=widen.attributes_of(observations, regions))


def p2_wide_table(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table without the columns that only serve the operator, conflicts as their number."""
    wide = p2_wide(spark, folder)
    return wide.withColumn("n_conflicts", F.size("conflicts").cast("bigint")).drop("signature", "n_attributes", "conflicts")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return widen.conflicting_cells(p2_wide(spark, folder))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.schema_changes(table(spark, folder, "parsed_files"))


def p3_fused_schema(spark: SparkSession, folder: str) -> DataFrame:
    return drift.fused_schema(table(spark, folder, "parsed_files"))


def p3_consistent_table(spark: SparkSession, folder: str) -> DataFrame:
    return drift.consistent_table(table(spark, folder, "parsed_files"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    lines = rejects.read_permissively(table(spark, folder, "raw_stats"))
    return rejects.rejected(lines).drop("_corrupt_record")


def p4_loaded_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.loaded_rows(rejects.read_permissively(table(spark, folder, "raw_stats")))


def p4_loaded_measures(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.loaded_measures(rejects.read_permissively(table(spark, folder, "raw_stats")))


def _profiled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    accepted = table(spark, folder, "profile_baseline")
    return profile.profile(table(spark, folder, "observations"), "dataset_version", PROFILED_NUMERIC, PROFILED_TEXT, accepted), accepted


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    profiled, accepted = _profiled(spark, folder)
    return profile.departures(profiled, accepted).withColumnRenamed("load", "dataset_version")


def p5_profile(spark: SparkSession, folder: str) -> DataFrame:
    profiled, _ = _profiled(spark, folder)
    return profiled.select(
        F.col("load").alias("dataset_version"), "column_name", "n_rows", "n_null", F.col("n_distinct").cast("bigint").alias("n_distinct"),
        "min_num", "max_num", "min_txt", "max_txt", "q1", "median", "q3", "top_value", F.round("top_share", 6).alias("top_share"),
    )


def _chosen(spark: SparkSession, folder: str) -> DataFrame:
    long = profile.long_values(table(spark, folder, "observations"), "dataset_version", (), PROFILED_TEXT)
    return profile.induced_expressions(profile.value_counts(long))


def p5_expressions(spark: SparkSession, folder: str) -> DataFrame:
    return profile.expression_report(_chosen(spark, folder), table(spark, folder, "profile_baseline"))


def p5_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return profile.coverage_between_loads(_chosen(spark, folder))


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    parents = orphans.parent_keys(table(spark, folder, "subjects"), table(spark, folder, "sessions"), table(spark, folder, "file_manifest"))
    return orphans.orphan_references(orphans.child_keys(table(spark, folder, "subject_sessions")), parents)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder).drop("at")


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_flags, p1_tests, p1_level_shifts, p2_found, p2_wide_table, p3_found, p3_fused_schema, p3_consistent_table, p4_found,
        p4_loaded_rows, p4_loaded_measures, p5_found, p5_profile, p5_expressions, p5_coverage, p6_found, p6_report,
    )
}
