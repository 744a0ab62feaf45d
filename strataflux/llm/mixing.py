"""Mixing sources to target weights by weighted fair queueing.

Every text of a source, in shuffled order, gets a virtual finish time: the tokens of its source up to and
with it, divided by the source's weight. Taking all texts in the order of that time and stopping at a token
budget draws from each source in proportion to its weight at any moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflux.llm.tokens import numbered_copies
from strataflux.operators.scaling import running_total

#: rows that one bucket of a source, or one bin of finish times, is meant to hold
ROWS_PER_BUCKET = 100_000


def weights(sizes: DataFrame, targets: DataFrame, max_sources: int = 100_000) -> tuple[DataFrame, float]:
    """(source, weight, target_share, max_repeats, available) of the sources that have tokens, and the token budget.

    Weights are the target shares of those sources, made to sum to 1. The budget is the greatest total at
    which no source has to be used more often than allowed. Both come from one row per source.
    """
    available = sizes.groupBy("source").agg(F.sum("n_tokens").cast("double").alias("available"))
    joined = targets.join(available, "source").filter("available > 0 AND target_share > 0 AND max_repeats > 0")
    rows = joined.select("source", "target_share", "max_repeats", "available").limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    total = sum(r.target_share for r in rows)
    budget = min((r.available * r.max_repeats * total / r.target_share for r in rows), default=0.0)
    table = sizes.sparkSession.createDataFrame(
        [(r.source, r.target_share / total, float(r.target_share), int(r.max_repeats), r.available) for r in rows],
        "source string, weight double, target_share double, max_repeats int, available double",
    )
    return table, budget


def mix(sizes: DataFrame, targets: DataFrame, budget: float | None = None, seed: int = 17) -> DataFrame:
    """(doc_id, source, repeat, n_tokens, virtual_finish, running_tokens): the blend, in the order of virtual_finish.

    `sizes` has doc_id, source and n_tokens. No source is used more than max_repeats times; every round of a
    source is shuffled anew by a hash of text, round and `seed`. Without a `budget` (tokens) the greatest one
    is taken that reaches the target shares. Sources without texts, and texts of sources without a target, null
    sources or no tokens, take no part. Repeated rows, and rows without an id, are texts of their own. Empty inputs give an empty blend.
    """
    sizes = numbered_copies(sizes, ["doc_id", "source", "n_tokens"])
    table, most = weights(sizes, targets.select("source", "target_share", "max_repeats"))
    budget = most if budget is None else float(budget)
    rows = sizes.count()
    buckets, bins = max(16, rows // ROWS_PER_BUCKET), max(16, 4 * rows // ROWS_PER_BUCKET)
    rounds = F.least(F.col("max_repeats"), F.greatest(F.lit(1), F.ceil(F.lit(budget) * F.col("weight") / F.col("available")).cast("int")))
    drawn = (
        sizes.filter("n_tokens > 0")
        .join(table.withColumn("rounds", rounds), "source")
        .withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("rounds"))))
        .withColumn("place", F.xxhash64("doc_id", "n_tokens", "copy", "repeat", F.lit(seed)))
        .withColumn("bucket", F.col("repeat").cast("bigint") * 2 * buckets + F.floor(F.col("place") / F.lit(2.0**64 / buckets)) + buckets // 2)
        .select("doc_id", "source", "repeat", F.col("n_tokens").cast("bigint").alias("n_tokens"), "weight", "place", "bucket")
    )
    queued = running_total(drawn, ["source"], "bucket", ["place", "doc_id"], "n_tokens", "source_tokens")
    finish = F.col("source_tokens") / F.col("weight")
    timed = queued.withColumn("virtual_finish", finish).filter(F.col("virtual_finish") <= budget * (1 + 1e-12))
    binned = timed.withColumns({"all": F.lit(1), "bin": F.floor(F.col("virtual_finish") * (bins / max(budget, 1.0)))})
    ordered = running_total(binned, ["all"], "bin", ["virtual_finish", "source", "doc_id"], "n_tokens", "running_tokens")
    return ordered.filter(F.col("running_tokens") <= budget).select(
        "doc_id", "source", "repeat", "n_tokens", "virtual_finish", "running_tokens"
    )


def reached_shares(blend: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, n_tokens, reached_share, times_used) for every source with a target."""
    used = blend.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.max("repeat").alias("times_used"))
    # one row per source, so that one task sees their number at most
    with_total = used.withColumn("total", F.sum("n_tokens").over(Window.partitionBy(F.lit(1))))
    return targets.select("source", "target_share", "max_repeats").join(with_total, "source", "left").select(
        "source", "target_share", "max_repeats", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce(F.col("n_tokens") / F.col("total"), F.lit(0.0)).alias("reached_share"), F.coalesce("times_used", F.lit(0)).alias("times_used"),
    )
