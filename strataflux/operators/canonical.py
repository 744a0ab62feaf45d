"""Tables of one delivery folder as canonical observations, and sources that become them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux.operators.vocab import with_canonical_names
from strataflux.schema import DOUBLES, conform, finite_or_null, one_row_per_key


def canonical_observations(observations: DataFrame, region_set: DataFrame) -> DataFrame:
    """One conforming row per primary key: canonical names, finite values, the hemisphere of the region.

    Of several rows of a key the one ingested last is kept, the greater value on a tie, so rows that
    were sent twice or contradict each other leave one answer.
    """
    named = with_canonical_names(observations, region_set)
    side = F.when(F.col("region").startswith("lh-"), "lh").when(F.col("region").startswith("rh-"), "rh").otherwise(F.col("hemisphere"))
    clean = named.withColumns({c: finite_or_null(F.col(c).cast("double")) for c in DOUBLES if c in named.columns} | {"hemisphere": side})
    kept = one_row_per_key(clean, F.col("ingested_at").desc_nulls_last(), F.col("value").desc_nulls_last(), F.col("source_file_checksum").asc_nulls_last())
    return conform(kept)


def covariate_codes(df: DataFrame) -> DataFrame:
    """sex as F or M and diagnosis as patient or control where the stored code is a known spelling of them, else as stored.

    Blank, null and unknown codes are no level of a covariate; the caller drops those rows.
    """
    sex = F.lower(F.trim("sex"))
    return df.withColumn("sex", F.when(sex.isin("f", "female", "2"), "F").when(sex.isin("m", "male", "1"), "M"))


def decode(value: Column, codes: dict[str, str]) -> Column:
    """Numeric or text codes through a map, `1.0` like `1`; unknown codes pass through."""
    text = F.regexp_replace(F.trim(value.cast("string")), r"\.0$", "")
    pairs = [x for k, v in codes.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), text), text) if pairs else text


def site_from_subject_id(subject_id: Column, collapse_samples: bool = False) -> Column:
    """The site of an id `<site>_<number>` or `<site>_<sample>_<number>`, null for any other id.

    The sample, one small letter or a number, is part of the site unless `collapse_samples`.
    """
    parts = F.split(subject_id, "_")
    numbered = (F.size(parts) > 1) & F.element_at(parts, -1).rlike("^[0-9]+$")
    words = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    if collapse_samples:
        sampled = (F.size(words) > 1) & F.try_element_at(words, F.lit(-1)).rlike("^([a-z]|[0-9]+)$")
        words = F.when(sampled, F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words)
    site = F.array_join(words, "_")
    return F.when(numbered & (site != ""), site)


def wide_to_long(wide: DataFrame, subject: str, names: DataFrame, measure: str, unit: str) -> DataFrame:
    """Unpivot a wide table with one row per subject: (subject_id, source_name, region, measure_type, unit, value).

    `names` maps source_name to region; columns that it doesn't know are left out, values that are no
    number become null.
    """
    columns = [c for c in wide.columns if c != subject]
    long = wide.select(F.col(subject).cast("string").alias("subject_id"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(
        ["subject_id"], columns, "source_name", "raw"
    )
    return long.join(names.select("source_name", "region"), "source_name").select(
        "subject_id", "source_name", "region", F.lit(measure).alias("measure_type"), F.lit(unit).alias("unit"),
        finite_or_null(F.col("raw").try_cast("double")).alias("value"),
    )
