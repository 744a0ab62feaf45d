"""References to records that do not exist, are withdrawn or arrive later.

Parent and child keys are tagged, united in long form and grouped by parent table and key; children come in
pre-aggregated, so a key that a third of all rows refer to is a few rows by then. Groups without a parent,
and groups whose parents don't cover the whole time of their references, are suspects; only references
to suspects are looked at one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KEY = ["ref_table", "ref_id"]


def key_of(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))


def session_key(subject: Column, session: Column) -> Column:
    """Null if either part is; the parts can't run into each other."""
    return F.concat(key_of(subject), F.lit("\u0001"), key_of(session))


def parent_keys(subjects: DataFrame, sessions: DataFrame, manifest: DataFrame) -> DataFrame:
    """(ref_table, ref_id, since, until) of every record that can be referred to."""
    parts = [
        subjects.select(F.lit("subjects").alias("ref_table"), key_of(F.col("subject_id")).alias("ref_id"), F.col("registered_at").alias("since"), F.col("withdrawn_at").alias("until")),
        sessions.select(F.lit("sessions").alias("ref_table"), session_key(F.col("subject_id"), F.col("session_id")).alias("ref_id"), F.col("registered_at").alias("since"), F.col("withdrawn_at").alias("until")),
        manifest.select(F.lit("file_manifest").alias("ref_table"), key_of(F.col("source_file")).alias("ref_id"), F.col("received_at").alias("since"), F.col("withdrawn_at").alias("until")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("ref_id IS NOT NULL")


def child_keys(discovered: DataFrame) -> DataFrame:
    """(discovery_id, at, ref_table, ref_id, ref_key): every reference of every discovery, null references left out."""
    files = F.array_distinct(F.transform(F.coalesce("stats_files", F.array().cast("array<string>")), key_of))

    def entry(name: str, ref_id: Column, ref_key: Column) -> Column:
        return F.struct(F.lit(name).alias("ref_table"), ref_id.alias("ref_id"), ref_key.alias("ref_key"))

    subject, session = F.col("subject_id"), F.col("session_id")
    refs = F.concat(
        F.array(entry("subjects", key_of(subject), key_of(subject)), entry("sessions", session_key(subject, session), key_of(session))),
        F.transform(files, lambda f: entry("file_manifest", f, f)),
    )
    return discovered.select("discovery_id", F.col("discovered_at").alias("at"), F.explode(refs).alias("r")).select(
        "discovery_id", "at", "r.*"
    ).filter("ref_id IS NOT NULL")


def orphan_references(children: DataFrame, parents: DataFrame) -> DataFrame:
    """(discovery_id, ref_table, ref_key, at, state) of every reference without a valid target at its time.

    state: `missing` (no such key), `late` (every record of the key begins after the reference), else
    `deleted` (withdrawn at or before it). Null keys are no references; blank keys are. A record without
    a begin is always there, one without an end never withdrawn; a reference without a time can only be
    `missing`. Repeated parent rows count once, repeated children give their rows once each. Empty inputs
    and extra columns are fine.
    """
    spans = parents.groupBy(*KEY).agg(F.collect_set(F.struct("since", "until")).alias("spans"))
    seen = children.groupBy(*KEY, F.date_trunc("month", F.col("at").cast("timestamp")).alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    tagged = spans.select(
        *KEY, F.lit(True).alias("is_parent"), "spans", F.lit(None).cast("timestamp_ntz").alias("first_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_at"), F.lit(0).cast("bigint").alias("n"),
    ).unionByName(
        seen.select(*KEY, F.lit(False).alias("is_parent"), F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"),
                    F.col("first_at").cast("timestamp_ntz").alias("first_at"), F.col("last_at").cast("timestamp_ntz").alias("last_at"), "n")
    )
    groups = tagged.groupBy(*KEY).agg(
        F.max("is_parent").alias("has_parent"), F.first("spans", ignorenulls=True).alias("spans"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("n").alias("n"),
    )

    def begun(s: Column, at: Column) -> Column:
        return F.coalesce(s["since"] <= at, F.lit(True))

    def lasting(s: Column, at: Column) -> Column:
        return F.coalesce(s["until"] > at, F.lit(True))

    covers = F.exists("spans", lambda s: begun(s, F.col("first_at")) & lasting(s, F.col("last_at")))
    suspects = groups.filter((F.col("n") > 0) & ~(F.col("has_parent") & F.coalesce(covers, F.lit(False)))).select(
        *KEY, "has_parent", "spans"
    )
    at = F.col("at")
    state = (
        F.when(~F.col("has_parent"), "missing")
        .when(F.exists("spans", lambda s: begun(s, at) & lasting(s, at)), F.lit(None))
        .when(F.exists("spans", lambda s: begun(s, at)), "deleted")
        .otherwise("late")
    )
    return children.join(suspects, KEY).select("discovery_id", "ref_table", "ref_key", "at", state.alias("state")).filter("state IS NOT NULL")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """(ref_table, period, state, n_references, n_keys): orphan references per parent table and month."""
    return orphans.groupBy("ref_table", F.date_format("at", "yyyy-MM").alias("period"), "state").agg(
        F.count(F.lit(1)).alias("n_references"), F.countDistinct("ref_key").alias("n_keys")
    )
