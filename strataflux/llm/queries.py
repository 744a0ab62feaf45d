"""Queries of the operators for language-model data (p7 to p10) over the tables of one folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.llm import digests, mixing, packing, spans
from strataflux.plans.oracles import CANONICAL
from strataflux.session import materialize
from strataflux.sources.tables import table


def p7_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    cells, groups, _ = digests.stored_cells(table(spark, folder, "observations"), table(spark, folder, "region_set"))
    rows = digests.certified_percentiles(cells, ["gid"], salt="salt").join(groups, "gid")
    return rows.select(*digests.GROUP, "percentile", "n", "estimate", "rank_error", "certified")


def p7_certified(spark: SparkSession, folder: str) -> DataFrame:
    """What a percentile is certified for, without the estimates, which no SQL engine gives in the same way."""
    return p7_percentiles(spark, folder).select(*digests.GROUP, "percentile", "n", "certified")


def p7_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One stored digest per group and load; any set of them can be merged later."""
    cells, groups, loads = digests.stored_cells(table(spark, folder, "observations"), table(spark, folder, "region_set"))
    keys = ["gid", "load"]
    packed = digests.pack_digests(digests.merge_digests(digests.build_digests(cells, keys, salt="salt"), keys), keys)
    return packed.join(groups, "gid").join(loads, "load").select(*digests.GROUP, "dataset_version", "n", "centroids")


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_sizes(table(spark, folder, "documents")), table(spark, folder, "pack_limits"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_report(p8_packed(spark, folder))


def p8_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What every packing has to keep, per limit: texts, containers above the capacity, tokens lost or doubled, texts split though they fit."""
    sizes = packing.token_sizes(table(spark, folder, "documents"))
    packed = materialize(packing.pack(sizes, table(spark, folder, "pack_limits")), "packed")
    total = sizes.agg(F.sum("n_tokens").alias("total"), F.count(F.lit(1)).alias("texts")).first()
    used = packed.groupBy("limit_name", "capacity_tokens", "container").agg(F.sum("n_tokens").alias("used"))
    over = used.groupBy("limit_name").agg(F.count_if(F.col("container").isNotNull() & (F.col("used") > F.col("capacity_tokens"))).alias("n_overfull"))
    split = packed.groupBy("limit_name", "capacity_tokens", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("n"))
    counted = split.groupBy("limit_name").agg(
        F.count(F.lit(1)).alias("n_texts"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("n_split_in_vain"),
        (F.sum("n") - F.lit(total.total or 0)).alias("tokens_off"),
    )
    return counted.join(over, "limit_name")


def p9_blend(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(packing.token_sizes(table(spark, folder, "documents")), table(spark, folder, "mix_targets"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    sizes, targets = packing.token_sizes(table(spark, folder, "documents")), table(spark, folder, "mix_targets")
    return mixing.reached_shares(mixing.mix(sizes, targets), targets)


def p9_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What every blend has to keep, per source: whether it takes part, its tokens short of its share of the budget by less than
    its largest text and never above it, and no more repeats than allowed."""
    sizes, targets = packing.token_sizes(table(spark, folder, "documents")), table(spark, folder, "mix_targets")
    shares = mixing.reached_shares(mixing.mix(sizes, targets), targets)
    drawn, budget = mixing.weights(sizes, targets)
    largest = sizes.groupBy("source").agg(F.max("n_tokens").alias("largest"))
    aimed = shares.join(drawn.select("source", "weight"), "source", "left").join(largest, "source", "left")
    aim = F.col("weight") * budget
    near = (F.col("n_tokens") <= aim + 0.5) & (F.col("n_tokens") > aim - F.col("largest"))
    return aimed.select(
        "source", "target_share", F.col("weight").isNotNull().alias("takes_part"), F.coalesce(near, F.col("n_tokens") == 0).alias("near_target"),
        (F.col("times_used") <= F.col("max_repeats")).alias("within_repeats"),
    )


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.records_with_shared_spans(table(spark, folder, "documents"))


def p10_shared_shares(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_shares(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (p7_percentiles, p7_certified, p7_digests, p8_packed, p8_report, p8_kept, p9_blend, p9_shares, p9_kept, p10_found, p10_shared_shares)
}

SQL: dict[str, str] = {}

SQL["p7_certified"] = f"""
WITH {CANONICAL},
cells AS (SELECT DISTINCT subject_id, session_id, site, region, measure_type, value FROM obs WHERE value IS NOT NULL AND isfinite(value))
SELECT site, region, measure_type, p::DOUBLE AS percentile, count(*) AS n, true AS certified
FROM cells, unnest([{", ".join(map(str, digests.PERCENTILES))}]) AS t(p) GROUP BY ALL
"""

SQL["p8_kept"] = """
SELECT limit_name, (SELECT count(*) FROM documents) AS n_texts, 0 AS n_split_in_vain, 0 AS tokens_off, 0 AS n_overfull FROM pack_limits
"""
SQL["p9_kept"] = """
SELECT source, target_share, source IN (SELECT source FROM documents WHERE length(text) > 0) AS takes_part, true AS near_target, true AS within_repeats FROM mix_targets
"""

#: every window of 300 characters of every document that stands in another one too
WINDOWS = """
g AS (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS i FROM documents WHERE doc_id IS NOT NULL AND length(text) >= 300),
w AS (SELECT doc_id, i, md5(substr(text, i, 300)) AS h FROM g),
s AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING min(doc_id) <> max(doc_id)))
"""
SQL["p10_found"] = f"WITH {WINDOWS} SELECT DISTINCT doc_id FROM s"
SQL["p10_shared_shares"] = f"""
WITH {WINDOWS},
c AS (SELECT doc_id, sum(f) AS n_shared
      FROM (SELECT doc_id, least(coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 300), 300) AS f FROM s) t GROUP BY 1),
d AS (SELECT doc_id, max(coalesce(length(text), 0)) AS n_chars FROM documents GROUP BY 1)
SELECT d.doc_id, n_chars, coalesce(n_shared, 0)::BIGINT AS n_shared, coalesce(n_shared / nullif(n_chars, 0), 0) AS share FROM d LEFT JOIN c USING (doc_id)
"""
