"""The canonical observation table, its vocabularies, and the checks at its boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the canonical columns in their order
IDENTITY = ("dataset", "dataset_version", "subject_id", "session_id", "time_from_baseline_years")
ACQUISITION = ("site", "scanner_manufacturer", "scanner_model", "field_strength_tesla")
MEASUREMENT = ("region", "hemisphere", "measure_type", "value", "unit")
COVARIATES = ("age_at_session", "age_baseline", "sex", "dx_baseline", "dx_at_session")
GLOBALS = ("etiv", "etiv_baseline", "surface_holes_lh", "surface_holes_rh")
PROVENANCE = ("source_file", "source_file_checksum", "freesurfer_version", "parser_version", "ingested_at")
QC = ("qc_status", "qc_flags", "qc_score", "qc_notes", "analysis_included")
COLUMNS = (*IDENTITY, *ACQUISITION, *MEASUREMENT, *COVARIATES, *GLOBALS, *PROVENANCE, *QC)
DOUBLES = {
    "time_from_baseline_years", "field_strength_tesla", "value", "age_at_session", "age_baseline", "etiv", "etiv_baseline",
    "surface_holes_lh", "surface_holes_rh", "qc_score",
}
REQUIRED = (
    "dataset", "dataset_version", "subject_id", "session_id", "region", "measure_type", "source_file", "source_file_checksum",
    "parser_version", "ingested_at",
)
KEY = ("dataset", "subject_id", "session_id", "region", "measure_type")
# fixed values: flags in the order of their mention
QC_FLAGS = ("etiv_implausible", "euler_low", "region_outlier", "asymmetry_outlier")


def _type_of(column: str) -> T.DataType:
    if column in DOUBLES:
        return T.DoubleType()
    if column == "qc_flags":
        return T.ArrayType(T.StringType())
    return T.BooleanType() if column == "analysis_included" else T.StringType()


SCHEMA = T.StructType([T.StructField(c, _type_of(c), c not in REQUIRED) for c in COLUMNS])


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def conform(df: DataFrame) -> DataFrame:
    """Canonical order and types; absent nullable columns as nulls, further columns last; an absent required one is an error."""
    absent = [c for c in REQUIRED if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are absent: {', '.join(absent)}")
    own = [F.col(c).cast(_type_of(c)).alias(c) if c in df.columns else F.lit(None).cast(_type_of(c)).alias(c) for c in COLUMNS]
    return df.select(*own, *[c for c in df.columns if c not in COLUMNS])


def null_violations(df: DataFrame) -> DataFrame:
    """(column_name, n_null) of every required column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    return counts.unpivot([], list(REQUIRED), "column_name", "n_null")


def duplicate_keys(df: DataFrame) -> DataFrame:
    """(key columns, n) of every primary key that occurs more than once."""
    return df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def validate(df: DataFrame) -> None:
    """Raise on nulls in required columns or repeated keys, naming one example."""
    bad = [r for r in null_violations(df).collect() if r.n_null]
    if bad:
        raise ValueError("nulls in required columns: " + ", ".join(f"{r.column_name} ({r.n_null})" for r in bad))
    example = duplicate_keys(df).limit(1).collect()
    if example:
        raise ValueError(f"repeated key: {example[0].asDict()}")


def read_canonical(spark: SparkSession, *paths: str) -> DataFrame:
    """Canonical parquet tables under the fixed schema; without paths the empty table."""
    if not paths:
        return empty(spark)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in SCHEMA])
    return spark.read.schema(nullable).parquet(*paths)


def write_canonical(df: DataFrame, path: str) -> None:
    """Conform, validate, write as snappy parquet."""
    out = conform(df)
    validate(out)
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def finite_or_null(x: Column) -> Column:
    """NaN and infinities are no values past the canonical boundary."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def one_row_per_key(df: DataFrame, *order: Column) -> DataFrame:
    """The first row of each primary key by `order`; a total order makes it deterministic."""
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)))
    return ranked.filter("__n = 1").drop("__n")
