"""Quality control of canonical observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.config import AnalysisConfig, QcConfig, QcThresholds
from strataflux.functions.robust import euler_number, with_robust_z
from strataflux.operators.scaling import null_safe_join
from strataflux.schema import QC, QC_FLAGS
from strataflux.session import materialize

SESSION = ["dataset", "subject_id", "session_id"]
CLEAN_NOTE = "no QC flag triggered"
DISABLED_NOTE = "QC disabled by configuration"


def session_frame(observations: DataFrame) -> DataFrame:
    """One row per session with its site, eTIV and hole counts (constant within a session, else the greatest)."""
    return observations.groupBy(*SESSION).agg(*[F.max(c).alias(c) for c in ("site", "etiv", "surface_holes_lh", "surface_holes_rh")])


def session_flags(observations: DataFrame, rules: QcThresholds) -> DataFrame:
    """(SESSION, site, etiv, euler, euler_z, etiv_implausible, euler_low); a check without data raises no flag."""
    euler = F.least(euler_number(F.col("surface_holes_lh")), euler_number(F.col("surface_holes_rh")))
    # stored, since the percentiles read it several times
    sessions = materialize(session_frame(observations).withColumn("euler", euler), "sessions")
    scored = with_robust_z(sessions, "euler", ["site"], "euler_z")
    low = (F.col("euler") < rules.euler_min) | (F.col("euler_z") < -rules.euler_mad_z)
    outside = (F.col("etiv") < rules.etiv_min) | (F.col("etiv") > rules.etiv_max)
    return scored.select(
        *SESSION, "site", "etiv", "euler", F.when(F.col("euler").isNotNull(), F.col("euler_z")).alias("euler_z"),
        F.coalesce(outside, F.lit(False)).alias("etiv_implausible"),
        F.coalesce(F.col("euler").isNotNull() & low, F.lit(False)).alias("euler_low"),
    )


def structure_of(region: Column, hemisphere: Column) -> Column:
    """The region's name without its side."""
    prefix = F.concat(hemisphere, F.lit("-"))
    return F.when(F.startswith(region, prefix), F.substring(region, F.length(prefix) + 1, F.length(region))).otherwise(region)


def asymmetry(observations: DataFrame, rules: QcThresholds) -> DataFrame:
    """(SESSION, structure, measure_type, lh, rh, asymmetry, asymmetry_z, asymmetry_outlier) of every left-right pair."""
    sided = observations.filter(F.col("hemisphere").isin("lh", "rh")).withColumn(
        "structure", structure_of(F.col("region"), F.col("hemisphere"))
    )
    pairs = (
        sided.groupBy(*SESSION, "structure", "measure_type")
        .agg(
            F.max(F.when(F.col("hemisphere") == "lh", F.col("value"))).alias("lh"),
            F.max(F.when(F.col("hemisphere") == "rh", F.col("value"))).alias("rh"),
            F.max("site").alias("site"),
        )
        .filter("structure IS NOT NULL AND measure_type IS NOT NULL AND lh IS NOT NULL AND rh IS NOT NULL")
    )
    mean = (F.col("lh") + F.col("rh")) / 2
    indexed = materialize(pairs.withColumn("asymmetry", F.when(mean != 0, (F.col("lh") - F.col("rh")) / mean)), "pairs")
    scored = with_robust_z(indexed, "asymmetry", ["site", "structure", "measure_type"], "asymmetry_z")
    return scored.withColumn("asymmetry_outlier", F.coalesce(F.abs("asymmetry_z") > rules.asymmetry_mad_z, F.lit(False)))


def flag_columns(observations: DataFrame, rules: QcThresholds) -> DataFrame:
    """`observations` with value_z and the four boolean flags."""
    scored = with_robust_z(observations, "value", ["site", "region", "measure_type"], "value_z").withColumn(
        "region_outlier", F.coalesce(F.abs("value_z") > rules.outlier_mad_z, F.lit(False))
    )
    with_session = null_safe_join(scored, session_flags(observations, rules).select(*SESSION, "etiv_implausible", "euler_low"), SESSION)
    flagged = asymmetry(observations, rules).filter("asymmetry_outlier").select(*SESSION, "structure", "measure_type", "asymmetry_outlier")
    keyed = with_session.withColumn("structure", structure_of(F.col("region"), F.col("hemisphere")))
    marked = null_safe_join(keyed, flagged, [*SESSION, "structure", "measure_type"])
    return marked.withColumn("asymmetry_outlier", F.coalesce("asymmetry_outlier", F.lit(False))).drop("structure")


def included(status: Column, analysis: AnalysisConfig) -> Column:
    return status.isin(list(analysis.include_qc_status))


def apply_qc(observations: DataFrame, qc: QcConfig = QcConfig(), analysis: AnalysisConfig = AnalysisConfig()) -> DataFrame:
    """`observations` with the five QC columns filled. An implausible eTIV fails, any other flag warns."""
    base = observations.drop(*QC)
    if not qc.enabled:
        return base.withColumns(
            {
                "qc_status": F.lit("PASS"), "qc_flags": F.array().cast("array<string>"), "qc_score": F.lit(None).cast("double"),
                "qc_notes": F.lit(DISABLED_NOTE), "analysis_included": included(F.lit("PASS"), analysis),
            }
        )
    flagged = flag_columns(base, qc.thresholds)
    flags = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in QC_FLAGS]))
    status = F.when(F.col("etiv_implausible"), "FAIL").when(F.size(flags) > 0, "WARNING").otherwise("PASS")
    notes = F.when(F.size(flags) > 0, F.array_join(flags, "; ")).otherwise(CLEAN_NOTE)
    return flagged.withColumns(
        {"qc_status": status, "qc_flags": flags, "qc_score": F.abs("value_z"), "qc_notes": notes, "analysis_included": included(status, analysis)}
    ).drop("value_z", *QC_FLAGS)


def confusion(flagged: DataFrame, predicted: str, truth: str) -> DataFrame:
    """One row: tp, fp, fn, tn, recall, false_positive_rate, precision of a boolean flag against a boolean truth."""
    p, t = F.coalesce(F.col(predicted), F.lit(False)), F.coalesce(F.col(truth), F.lit(False))
    counts = flagged.agg(
        F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn")
    )
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(a) + F.col(b))
    return counts.withColumns(
        {"recall": ratio("tp", "fn"), "false_positive_rate": ratio("fp", "tn"), "precision": ratio("tp", "fp")}
    )
