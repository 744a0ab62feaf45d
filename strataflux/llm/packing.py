"""Filling containers of fixed token capacity with whole texts, balanced by attention cost.

The cost of a sequence is linear in its tokens plus quadratic in the tokens of each text in it. Texts
are taken in descending size and go to the cheapest sequence that still has room (one that they fill
exactly comes first), so sequences fill up evenly and the small texts at the end close the gaps. Texts are
dealt out to shards of a few thousand by a hash of id, size and number of the copy, so that rows without an id or with the same
one spread too; each shard is packed in one task, and no shard grows with the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.llm.tokens import VOCABULARY, numbered_copies, token_count
from strataflux.session import materialize

TEXTS_PER_SHARD = 4_096
LINEAR_COST, QUADRATIC_COST = 1.0, 1.0 / 4_096
#: containers of one shard are numbered below this
CONTAINERS_PER_SHARD = 1 << 32


def token_sizes(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) as a table: counting tokens is the costly step, and several passes read them."""
    return materialize(documents.select("doc_id", "source", token_count(F.col("text"), vocabulary).alias("n_tokens")), "tokens")


def assign(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence number of each size, in descending order of size.

    As many sequences are planned as the total needs at least. A text goes to a sequence that it fills
    exactly, else to the cheapest one with room, else to a new one.
    """
    planned = max(1, -(-int(sizes.sum()) // capacity))
    cost, room = np.zeros(planned), np.full(planned, capacity, dtype=np.int64)
    out = np.empty(len(sizes), dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        exact = room == size
        j = int(np.argmax(exact))
        if not exact[j]:
            j = int(np.argmin(np.where(room >= size, cost, np.inf)))
            if room[j] < size:
                j = len(cost)
                cost, room = np.append(cost, 0.0), np.append(room, capacity)
        cost[j] += LINEAR_COST * size + QUADRATIC_COST * size * size
        room[j] -= size
        out[i] = j
    return out


def _pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    capacity, shard = int(key[1]), int(key[2])
    rows = rows.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
    full = rows["n_tokens"].to_numpy() == capacity
    number = np.empty(len(rows), dtype=np.int64)
    number[full] = np.arange(full.sum())
    number[~full] = full.sum() + assign(rows["n_tokens"].to_numpy()[~full], capacity)
    rows["container"] = shard * CONTAINERS_PER_SHARD + number
    return rows[["limit_name", "capacity_tokens", "container", "doc_id", "piece", "token_start", "n_tokens"]]


def pack(sizes: DataFrame, limits: DataFrame, texts_per_shard: int = TEXTS_PER_SHARD, max_limits: int = 1_000) -> DataFrame:
    """(limit_name, capacity_tokens, container, doc_id, piece, token_start, n_tokens): every text, for every limit.

    Only a text above the capacity is split: into pieces of exactly the capacity, each a full container, and
    a remainder that is packed like a text. Texts without tokens take no room and get container null.
    Repeated rows are packed as often as they occur; a null doc_id is packed like any other. Limits with a
    null or non-positive capacity raise an error, as do more than `max_limits` of them: the limits are a
    parameter table that is read by the driver. Empty inputs give an empty result.
    """
    parameters = limits.select("limit_name", "capacity_tokens").limit(max_limits + 1).collect()
    if len(parameters) > max_limits or any(not r.capacity_tokens or r.capacity_tokens <= 0 for r in parameters):
        raise ValueError("limits must be few and positive")
    schema = (
        "limit_name string, capacity_tokens int, container bigint, doc_id bigint, piece int, token_start bigint, n_tokens int"
    )
    if not parameters:
        return sizes.sparkSession.createDataFrame([], schema)
    shards = max(1, round(sizes.count() / texts_per_shard))
    options = F.array(
        *[F.struct(F.lit(r.limit_name).alias("limit_name"), F.lit(int(r.capacity_tokens)).alias("capacity_tokens")) for r in parameters]
    )
    shard = F.pmod(F.xxhash64("doc_id", "n_tokens", "copy"), F.lit(shards)).cast("bigint")
    rows = numbered_copies(sizes, ["doc_id", "n_tokens"]).select("doc_id", "n_tokens", shard.alias("shard")).select("doc_id", "n_tokens", "shard", F.explode(options).alias("o")).select(
        "doc_id", "n_tokens", "shard", "o.*"
    )
    empty = rows.filter("n_tokens = 0").select(
        "limit_name", "capacity_tokens", F.lit(None).cast("bigint").alias("container"), "doc_id", F.lit(0).alias("piece"),
        F.lit(0).cast("bigint").alias("token_start"), "n_tokens",
    )
    last = (F.floor((F.col("n_tokens") - 1) / F.col("capacity_tokens"))).cast("int")
    pieces = (
        rows.filter("n_tokens > 0")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("token_start", F.col("piece").cast("bigint") * F.col("capacity_tokens"))
        .withColumn("n_tokens", F.least(F.col("capacity_tokens"), (F.col("n_tokens") - F.col("token_start")).cast("int")))
    )
    packed = pieces.groupBy("limit_name", "capacity_tokens", "shard").applyInPandas(_pack_shard, schema)
    return packed.unionByName(empty)


def packing_report(packed: DataFrame) -> DataFrame:
    """(limit_name, n_containers, n_tokens, fill, cost_mean, cost_max) of a packing."""
    size = F.col("n_tokens").cast("double")
    containers = (
        packed.filter("container IS NOT NULL")
        .groupBy("limit_name", "capacity_tokens", "container")
        .agg(F.sum("n_tokens").alias("used"), F.sum(size * LINEAR_COST + size * size * QUADRATIC_COST).alias("cost"))
    )
    return containers.groupBy("limit_name", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("n_containers"),
        F.sum("used").alias("n_tokens"),
        (F.sum("used") / (F.count(F.lit(1)) * F.col("capacity_tokens"))).alias("fill"),
        F.avg("cost").alias("cost_mean"),
        F.max("cost").alias("cost_max"),
    )
