"""Long exact spans shared between records, found through difference-cover anchors.

A difference cover of a period v holds residues whose differences give every residue. Windows of
w = length - v + 1 characters are hashed only at the positions of each text that lie in the cover, modulo v.
Two texts that share `length` characters then share at least one anchored window, however the span lies
in either, though only about sqrt(v) / v of all positions are hashed. Shared anchors are extended by
comparing the full windows of `length` characters around them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflux.session import materialize

#: fixed values: perfect difference sets, period -> residues
DIFFERENCE_COVERS = {
    1: (0,),
    3: (0, 1),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (1, 6, 7, 9, 19, 38, 42, 49),
    73: (1, 2, 4, 8, 16, 32, 37, 55, 64),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}
DOCS_PER_BUCKET = 1_000
#: anchors that one task gathers before it sends them on; bounds its memory
ANCHORS_PER_FLUSH = 2_000_000
#: at most this many window places meet in one task
PLACES_PER_BUCKET = 8_000_000
#: characters hashed at a time; longer texts go through in overlapping pieces
PIECE = 262_144

_BASE, _OTHER_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93))


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest known period that leaves anchors of at least half the length."""
    period = max(v for v in DIFFERENCE_COVERS if v == 1 or 2 * v <= length + 1)
    return period, DIFFERENCE_COVERS[period]


class WindowHasher:
    """64-bit hashes of the windows of a text at given positions, vectorised over a piece of text."""

    def __init__(self, base: np.uint64 = _BASE) -> None:
        powers = np.full(2 * PIECE + 1, base, dtype=np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(PIECE + 1, np.uint64(pow(int(base), -1, 2**64)), dtype=np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)

    @staticmethod
    def codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")

    def hashes(self, codes: np.ndarray, positions: np.ndarray, width: int) -> np.ndarray:
        """The hash of codes[p : p + width] for each p of the sorted `positions`."""
        if width > PIECE:
            raise ValueError(f"windows are limited to {PIECE} characters")
        out = np.empty(len(positions), dtype=np.uint64)
        for start in range(0, len(codes), PIECE):
            i, j = np.searchsorted(positions, (start, start + PIECE))
            if i == j:
                continue
            piece = codes[start : start + PIECE + width].astype(np.uint64)
            piece += np.uint64(1)
            piece *= _MIX[0]
            piece ^= piece >> np.uint64(29)
            piece *= self.powers[: len(piece)]
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(piece, out=sums[1:])
            at = positions[i:j] - start
            h = (sums[at + width] - sums[at]) * self.inverse[at]
            h ^= h >> np.uint64(31)
            h *= _MIX[1]
            h ^= h >> np.uint64(32)
            h *= _MIX[2]
            out[i:j] = h ^ (h >> np.uint64(29))
        return out


class Anchors:
    """Positions of a text that lie in the cover, and their window hashes."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.period, cover = cover_for(length)
        self.width = length - self.period + 1
        self.cover = np.array(cover, dtype=np.int64)
        self.hasher = WindowHasher()
        self.known = np.zeros(0, dtype=np.int64)
        self.reach = 0

    def positions(self, n_chars: int) -> np.ndarray:
        last = n_chars - self.width
        if last < 0:
            return self.known[:0]
        if last >= self.reach:
            self.reach = max(1 << 16, last + 1)
            periods = np.arange(self.reach // self.period + 1, dtype=np.int64) * self.period
            self.known = (periods[:, None] + self.cover[None, :]).ravel()
        return self.known[: np.searchsorted(self.known, last, side="right")]

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = self.hasher.codes(text)
        at = self.positions(len(codes))
        return codes, at, self.hasher.hashes(codes, at, self.width)


def _key(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, key): the key is bucket and 32 more bits of the hash, so a bucket ships 4 bytes per anchor."""
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    return bucket, (bucket << 32) | (h >> np.uint64(32)).astype(np.int64)


def _send(keys: np.ndarray, docs: np.ndarray, buckets: int) -> pd.DataFrame:
    """One row per bucket of the gathered anchors.

    At most two records per anchor go to its bucket, where other tasks' records of it are met. The others
    are known to share it and are only passed on, spread by record: so an anchor that a third of all
    records hold is a few entries of its bucket.
    """
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    fresh = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])]
    keys, docs = keys[fresh], docs[fresh]
    opens = np.r_[True, keys[1:] != keys[:-1]]
    place = np.arange(len(keys)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
    meets = place < 2
    bucket = np.where(meets, keys >> 32, -1 - docs % buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, docs = bucket[order], keys[order], docs[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    low = np.where(bucket < 0, keys, keys & 0xFFFFFFFF)
    return pd.DataFrame(
        {
            "bucket": bucket[cuts],
            "near": [x.astype(np.uint32).view(np.int32) if b >= 0 else None for b, x in zip(bucket[cuts], np.split(low, cuts[1:]))],
            "far": [x if b < 0 else None for b, x in zip(bucket[cuts], np.split(low, cuts[1:]))],
            "docs": np.split(docs, cuts[1:]),
        }
    )


def _shared_in_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    bucket = int(rows["bucket"].iloc[0])
    docs = np.concatenate(rows["docs"].to_list())
    if bucket < 0:
        return pd.DataFrame({"doc_id": docs, "k": np.concatenate(rows["far"].to_list())})
    low = np.concatenate(rows["near"].to_list()).view(np.uint32)
    order = np.lexsort((docs, low))
    low, docs = low[order], docs[order]
    fresh = np.r_[True, (low[1:] != low[:-1]) | (docs[1:] != docs[:-1])]
    low, docs = low[fresh], docs[fresh]
    cuts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    shared = np.repeat(np.diff(np.r_[cuts, len(low)]) > 1, np.diff(np.r_[cuts, len(low)]))
    return pd.DataFrame({"doc_id": docs[shared], "k": (np.int64(bucket) << 32) | low[shared].astype(np.int64)})


def shared_anchors(documents: DataFrame, length: int, buckets: int) -> DataFrame:
    """(doc_id, k) of every anchor that stands in two or more records."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, keys, docs, held = Anchors(length), [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_numpy(), batch["text"]):
                h = anchors.of(text)[2]
                if len(h):
                    keys.append(_key(h, buckets)[1])
                    docs.append(np.full(len(h), doc, dtype=np.int64))
                    held += len(h)
                if held >= ANCHORS_PER_FLUSH:
                    yield _send(np.concatenate(keys), np.concatenate(docs), buckets)
                    keys, docs, held = [], [], 0
        if held:
            yield _send(np.concatenate(keys), np.concatenate(docs), buckets)

    sent = documents.mapInPandas(gather, "bucket bigint, near array<int>, far array<bigint>, docs array<bigint>")
    return sent.groupBy("bucket").applyInPandas(_shared_in_bucket, "doc_id bigint, k bigint")


def _placed(docs: pd.Series, parts: list[tuple], names: tuple[str, ...]) -> pd.DataFrame:
    """One frame for a batch: the arrays of each record one after another, with doc_id and n_chars repeated."""
    sizes = [len(x[0]) for x in parts]
    out = {name: np.concatenate([x[i] for x in parts]) if parts else [] for i, name in enumerate(names)}
    out["doc_id"] = np.repeat(docs.to_numpy(), sizes)
    out["n_chars"] = np.repeat([x[-1] for x in parts], sizes)
    return pd.DataFrame(out)


def _in_two_records(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys stand in two or more records; counts first, so that hot keys are combined early."""
    spread = rows.groupBy(*keys).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return rows.join(spread.filter("lo <> hi").select(*keys), keys)


def _send_places(bucket: np.ndarray, window: np.ndarray, docs: np.ndarray, at: np.ndarray, meetings: int) -> pd.DataFrame:
    """Arrays of the gathered window places, one row per bucket, and one row of results.

    A window that two of the gathered records hold is known to be shared: its places are results, passed on as runs of
    successive starts under a negative bucket, and one mark (place -1) goes to the window's bucket, where other tasks' places
    of it learn that. So a window that a third of all records hold is one entry per task. Within a bucket places are in the
    order of records and starts, in which they compress well.
    """
    order = np.argsort(window, kind="stable")
    known, opens = _held_by_two(window[order], docs[order], bucket[order])
    places = np.sort(order[known])
    here = _runs(docs[places], at[places])
    at = at.copy()
    at[places] = -1
    travels = np.sort(order[~known | opens])  # as gathered: by record and start
    travels = travels[np.argsort(bucket[travels], kind="stable")]
    bucket, window, docs, at = bucket[travels], window[travels], docs[travels], at[travels]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rows = [bucket[cuts].tolist(), *(np.split(x, cuts[1:]) for x in (window, docs, at.astype(np.int32)))]
    if len(here[0]):
        for column, value in zip(rows, (-1 - int(here[0][0]) % meetings, here[2], here[0], here[1].astype(np.int32))):
            column.append(value)
    return pd.DataFrame(dict(zip(("bucket", "window", "docs", "at"), rows)))


def _held_by_two(window: np.ndarray, docs: np.ndarray, bucket: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For places sorted by window: whether two records hold the window, and whether the place is the first of it."""
    opens = np.r_[True, window[1:] != window[:-1]]
    if bucket is not None:
        opens[1:] |= bucket[1:] != bucket[:-1]
    first = np.flatnonzero(opens)
    two = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
    return two[np.cumsum(opens) - 1], opens


def _runs(docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, first, last) of each run of successive starts."""
    order = np.lexsort((at, docs))
    docs, at = docs[order], at[order]
    opens = np.flatnonzero(np.r_[len(at) > 0, (docs[1:] != docs[:-1]) | (at[1:] > at[:-1] + 1)][: len(at)])
    ends = np.r_[opens[1:], len(at)][: len(opens)] - 1
    return docs[opens], at[opens], at[ends]


def _places_in_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    window, docs, at = (np.concatenate(rows[x].to_list()) for x in ("window", "docs", "at"))
    if rows["bucket"].iloc[0] < 0:
        return pd.DataFrame({"doc_id": docs, "pos": at, "last": window})
    order = np.argsort(window, kind="stable")
    docs, at = docs[order], at[order].astype(np.int64)
    held, opens = _held_by_two(window[order], docs)
    marked = (np.minimum.reduceat(at, np.flatnonzero(opens)) < 0)[np.cumsum(opens) - 1]
    kept = (held | marked) & (at >= 0)
    return pd.DataFrame(dict(zip(("doc_id", "pos", "last"), _runs(docs[kept], at[kept]))))


def shared_windows(documents: DataFrame, length: int = 300, whole_coverage: bool = True) -> DataFrame:
    """(doc_id, pos, last): runs of starts, pos to last, of windows of `length` characters that also stand in another record.

    Together they cover every character that lies in a shared span of at least `length` characters; with
    `whole_coverage=False` they only tell which records have such a span. Runs may repeat and overlap. Windows
    are compared by a 64-bit hash and the bucket that a second, independent hash gives; the buckets grow with the data, so
    n windows in b buckets have about n * n / (b * 2^65) pairs that are taken for equal and aren't. Rows with the same doc_id are
    one record, whatever their text; null doc_ids and null or short texts share nothing.
    """
    docs = documents.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    buckets = max(32, -(-docs.count() // DOCS_PER_BUCKET))
    found = shared_anchors(docs, length, buckets)
    lists = found.groupBy("doc_id").agg(F.array_sort(F.collect_set("k")).alias("keys"))
    # the texts travel once, to those records that share an anchor; later passes read this copy
    candidates = materialize(docs.join(lists, "doc_id"), "candidates")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = Anchors(length)
        for batch in batches:
            parts = []
            for text, keys in zip(batch["text"], batch["keys"]):
                codes, at, h = anchors.of(text)
                k = _key(h, buckets)[1]
                hit = keys[np.minimum(np.searchsorted(keys, k), len(keys) - 1)] == k
                at, k = at[hit], k[hit]
                fits = at + length <= len(codes)
                window = np.zeros(len(at), dtype=np.uint64)
                window[fits] = anchors.hasher.hashes(codes, at[fits], length)
                parts.append((at, k, window.view(np.int64), fits, len(codes)))
            yield _placed(batch["doc_id"], parts, ("pos", "k", "window", "fits"))

    anchored = materialize(
        candidates.mapInPandas(place, "pos bigint, k bigint, window bigint, fits boolean, doc_id bigint, n_chars bigint"), "anchored"
    )
    # 1. anchors at which the span goes on for the whole length
    long = materialize(
        _in_two_records(anchored.filter("fits").select("doc_id", "pos", "k", "window"), ["k", "window"]).select("doc_id", "pos"), "long"
    )

    # 2. anchors around which characters may belong to a span that no such window covers
    reach = length - Anchors(length).width
    if whole_coverage:
        marked = anchored.join(long.select("doc_id", "pos", F.lit(True).alias("is_long")), ["doc_id", "pos"], "left")
        by_place = Window.partitionBy("doc_id").orderBy("pos")
        before = F.last(F.when(F.col("is_long"), F.col("pos")), ignorenulls=True).over(by_place)
        after = F.first(F.when(F.col("is_long"), F.col("pos")), ignorenulls=True).over(
            by_place.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        )
        edges = marked.withColumns({"before": before, "after": after})
        # covered on both sides: a long window begins at or before the zone, or the gap to the next is closed
        left = F.coalesce(F.col("before") <= F.greatest(F.col("pos") - reach, F.lit(0)), F.lit(False))
        right = F.coalesce(F.col("after") + length >= F.least(F.col("pos") + length, F.col("n_chars")), F.lit(False))
        closed = F.coalesce(F.col("after") <= F.col("before") + length, F.lit(False))
        needy = edges.filter(~(left & right & closed)).select("k")
    else:
        needy = anchored.join(long.select("doc_id").distinct(), "doc_id", "left_anti").select("k")
    around = (
        anchored.join(needy.distinct(), "k", "left_semi").groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    )

    # 3. every start around those anchors; the places of a task travel as arrays, once
    meetings = max(32, -(-anchored.count() * (reach + 1) // PLACES_PER_BUCKET))

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, other = WindowHasher(), WindowHasher(_OTHER_BASE)
        parts, held = [], 0
        for batch in batches:
            for doc, text, places in zip(batch["doc_id"].to_numpy(), batch["text"], batch["places"]):
                codes = hasher.codes(text)
                starts = (places[:, None] + np.arange(-reach, 1)[None, :]).ravel()
                starts = np.unique(starts[(starts >= 0) & (starts + length <= len(codes))])
                if len(starts):
                    bucket = (other.hashes(codes, starts, length) % np.uint64(meetings)).astype(np.int64)
                    window = hasher.hashes(codes, starts, length).view(np.int64)
                    parts.append((bucket, window, np.full(len(starts), doc, dtype=np.int64), starts))
                    held += len(starts)
                if held >= ANCHORS_PER_FLUSH:
                    yield _send_places(*(np.concatenate(x) for x in zip(*parts)), meetings)
                    parts, held = [], 0
        if held:
            yield _send_places(*(np.concatenate(x) for x in zip(*parts)), meetings)

    sent = (
        candidates.select("doc_id", "text")
        .join(around, "doc_id")
        .mapInPandas(extend, "bucket bigint, window array<bigint>, docs array<bigint>, at array<int>")
    )
    short = sent.groupBy("bucket").applyInPandas(_places_in_bucket, "doc_id bigint, pos bigint, last bigint")
    return long.withColumn("last", F.col("pos")).unionByName(short)


def shared_shares(documents: DataFrame, length: int = 300) -> DataFrame:
    """(doc_id, n_chars, n_shared, share) for every record: how many of its characters stand in shared spans."""
    runs = shared_windows(documents, length).withColumn("end", F.col("last") + length)
    by_place = Window.partitionBy("doc_id").orderBy("pos")
    reached = F.coalesce(F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("pos"), reached), F.lit(0))
    covered = runs.withColumn("fresh", fresh).groupBy("doc_id").agg(F.sum("fresh").alias("n_shared"))
    sizes = documents.groupBy("doc_id").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("n_chars"))
    joined = sizes.join(covered, "doc_id", "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0)).cast("bigint"))
    return joined.withColumn("share", F.coalesce(F.try_divide(F.col("n_shared"), F.col("n_chars")), F.lit(0.0)))


def records_with_shared_spans(documents: DataFrame, length: int = 300) -> DataFrame:
    """(doc_id) of every record with a span of at least `length` characters that stands in another record."""
    return shared_windows(documents, length, whole_coverage=False).select("doc_id").distinct()
