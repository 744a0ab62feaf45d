"""Implausible readings: physical limits, spikes, level shifts and stuck runs per source.

Method: robust autoregression per source. A source is a (field, site, region, measure_type) series; each load of
it is ordered by time. Readings are standardised by the source's median and MAD. Each round fits an AR(1)
coefficient and the residual's scale to clipped readings, tests level shifts between windows of readings, and
tests additive outliers on the residuals; the next round works on the series without the outliers and with the
accepted levels subtracted. Physical limits and runs of one repeated reading are separate tests.

All readings are sorted once, over all sources, into ranges of about the same size, so that a source, or a time, that
holds a third of all readings is many ranges. Rounds are aggregates over the sorted table: blocks of ten successive
readings leave it, and all tests work on blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflux.operators.scaling import median_and_mad
from strataflux.operators.vocab import with_canonical_names
from strataflux.session import materialize, release

SOURCE = ["field", "site", "region", "measure_type"]
SESSION = ["subject_id", "session_id"]
MAD_TO_SIGMA = 1.4826
#: readings of a block; the windows of the level-shift test have BLOCK x 4^k readings, k < LEVELS
BLOCK, LEVELS = 10, 6
#: readings of a series that share one row of the table of levels
CHUNK = 16_384
#: clip for the estimate of a level, which must not hold it near zero
WIDE = 30.0
#: bits of `edge`: in the first run of its range, in the last run, first reading, last reading
HEAD, TAIL, FIRST, LAST = 1, 2, 4, 8
ORDERED = "sid bigint, series bigint, subject_id string, session_id string, reading double, day date, of_holes boolean, range int, pos bigint, prev double, stuck boolean, edge int"


@dataclass(frozen=True)
class SpikeRules:
    """Parameters of the tests; `mad_factor` and `stuck` are those of the published case definition.

    A reading farther than `mad_factor` from the median is either in a level of at least `level`, or its residual
    exceeds mad_factor - level - phi_limit x clip, which has to be more than `innovation`: the residual's scale
    is at most the source's own, as that of any stationary autoregression.
    """

    mad_factor: float = 8.0  # exact rule: distance from the source's median in robust sigmas
    clip: float = 3.0  # Huber clip of the standardised deviation
    phi_limit: float = 0.95
    innovation: float = 4.0  # additive-outlier threshold, in scales of the residual
    shift: float = 6.0  # level-shift threshold, in standard errors of the difference of two means
    level: float = 1.0  # least distance of a level that counts as shifted
    rounds: int = 2
    stuck: int = 5  # least length of a stuck run

    def __post_init__(self) -> None:
        if self.innovation >= self.mad_factor - self.level - self.phi_limit * self.clip:
            raise ValueError("the innovation threshold would lose readings that the exact rule flags")
        if self.rounds < 1 or self.stuck < 2:
            raise ValueError("at least one round, and runs of at least two readings")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def impossible(of_holes: Column, x: Column) -> Column:
    """Physical limits: volumes, thicknesses and eTIV are positive and finite, hole counts whole and not negative."""
    holes = (x < 0) | (x != F.floor(x).cast("double"))
    return ~finite(x) | F.when(of_holes, holes).otherwise(x <= 0)


def readings_of(observations: DataFrame, region_set: DataFrame) -> DataFrame:
    """Non-null readings in long form: SOURCE, SESSION, dataset_version, acquired_at, reading.

    `value` covers volume and thickness rows. etiv and surface_holes_lh belong to a session, with region and
    measure_type `*`. Rows without a site have no source and are left out.
    """
    base = observations.select(
        "site", *SESSION, "dataset_version", "acquired_at", "region", "hemisphere", "measure_type", "value", "etiv", "surface_holes_lh"
    ).filter("site IS NOT NULL")
    named = with_canonical_names(base, region_set)

    def cell(field: str, region: Column, measure: Column, x: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), region.alias("region"), measure.alias("measure_type"), x.cast("double").alias("reading"))

    star = F.lit("*")
    of_row = F.when(F.col("measure_type").isin("volume", "thickness"), cell("value", F.col("region"), F.col("measure_type"), F.col("value")))
    cells = F.array(of_row, cell("etiv", star, star, F.col("etiv")), cell("surface_holes_lh", star, star, F.col("surface_holes_lh")))
    return named.select("site", *SESSION, "dataset_version", "acquired_at", F.explode(cells).alias("c")).filter("c.reading IS NOT NULL").select(
        "c.field", "site", "c.region", "c.measure_type", *SESSION, "dataset_version", "acquired_at", "c.reading"
    )


def sources_of(observations: DataFrame, region_set: DataFrame) -> DataFrame:
    """SOURCE of every series that `readings_of` can give, from the different spellings of site, region and measure."""
    spelled = observations.select("site", "region", "hemisphere", "measure_type").filter("site IS NOT NULL").distinct()
    named = with_canonical_names(spelled, region_set)
    cell = lambda field, region, measure: F.struct(F.lit(field).alias("field"), region.alias("region"), measure.alias("measure_type"))
    star = F.lit("*")
    cells = F.array(cell("value", F.col("region"), F.col("measure_type")), cell("etiv", star, star), cell("surface_holes_lh", star, star))
    return named.select("site", F.explode(cells).alias("c")).select("c.field", "site", "c.region", "c.measure_type").distinct()


def _source_id() -> Column:
    return F.xxhash64(*[F.coalesce(F.col(c), F.lit("\u0001")) for c in SOURCE])


def _scan_in_order(stuck: int):  # noqa: ANN202
    """The pass over one sorted range: place and predecessor in the series, and whether a run is stuck.

    At most `stuck` readings are held back between batches: those of a run that may go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        schema = pa.schema([
            ("sid", pa.int64()), ("series", pa.int64()), ("subject_id", pa.string()), ("session_id", pa.string()), ("reading", pa.float64()),
            ("day", pa.date32()), ("of_holes", pa.bool_()), ("range", pa.int32()), ("pos", pa.int64()), ("prev", pa.float64()), ("stuck", pa.bool_()),
            ("edge", pa.int32()),
        ])
        held: pa.Table | None = None
        before = None  # series, reading, place and length of the run of the reading before the held ones
        sent, first_run_open = 0, True

        def mark(rows: pa.Table, final: bool):  # noqa: ANN202
            nonlocal before, sent, first_run_open
            series, x = rows["series"].to_numpy(), rows["reading"].to_numpy()
            n, at = len(x), np.arange(len(x))
            last_series, last_x = np.r_[before[0] if before else series[0] ^ 1, series[:-1]], np.r_[before[1] if before else np.nan, x[:-1]]
            opens = series != last_series
            same = ~opens & ((x == last_x) | (np.isnan(x) & np.isnan(last_x)))
            start = np.maximum.accumulate(np.where(opens, at, -1))
            pos = np.where(start >= 0, at - start, at + (before[2] + 1 if before else 0))
            run_start = np.maximum.accumulate(np.where(same, -1, at))
            length = np.where(run_start >= 0, at - run_start + 1, at + 1 + (before[3] if before else 0))
            ends = np.flatnonzero(np.r_[~same[1:], True])
            total = length[ends][np.searchsorted(ends, at)]
            keep = 0 if final else int(min(n, length[-1] if length[-1] < stuck else 1))
            edge = np.zeros(n, dtype=np.int32)
            if first_run_open:
                in_first = np.cumsum(~same) <= (1 if sent == 0 else 0)
                edge[in_first & (at + sent < stuck - 1)] |= HEAD
                if sent == 0:
                    edge[0] |= FIRST | HEAD
                first_run_open = bool(in_first[-1]) and n - keep + sent < stuck
            if final:
                tail = at > n - stuck
                edge[tail & (total == length[-1]) & (at >= ends[-1] - length[-1] + 1)] |= TAIL
                edge[-1] |= LAST | TAIL
            out = n - keep
            if not out:
                return None, rows
            ready = pa.RecordBatch.from_arrays(
                [*[pc.cast(rows[c].slice(0, out).combine_chunks(), schema.field(c).type) for c in schema.names[:7]], pa.array(np.full(out, number, np.int32)), pa.array(pos[:out]),
                 pa.array(np.where(opens, np.nan, last_x)[:out], mask=opens[:out]), pa.array((total >= stuck)[:out]), pa.array(edge[:out])], schema=schema,
            )
            before = (series[out - 1], x[out - 1], int(pos[out - 1]), int(length[out - 1]))
            sent += out
            return ready, rows.slice(out) if keep else None

        for batch in batches:
            if batch.num_rows:
                new = pa.Table.from_batches([batch])
                ready, held = mark(pa.concat_tables([held, new]).combine_chunks() if held is not None else new, False)
                if ready is not None:
                    yield ready
        if held is not None:
            yield mark(held, True)[0]

    return run


def in_order(readings: DataFrame, rules: SpikeRules) -> DataFrame:
    """The stored table of ORDERED: each cell once, with its place in the sorted series of its source and load.

    A cell that is repeated with the same value counts once, at its earliest time. Readings without a time come first;
    ties are ordered by subject, session and reading.
    """
    cells = (
        readings.select(
            _source_id().alias("sid"), *SESSION, F.coalesce("dataset_version", F.lit("\u0001")).alias("load"), "reading", "acquired_at",
            (F.col("field") == "surface_holes_lh").alias("of_holes"),
        )
        .groupBy("sid", *SESSION, "load", "reading", "of_holes").agg(F.min("acquired_at").alias("at"))
        .select("sid", F.xxhash64("sid", "load").alias("series"), *SESSION, "reading", "at", "of_holes")
    )
    order = ["series", "at", *SESSION, "reading"]
    ranges = cells.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranges.select("sid", "series", *SESSION, "reading", F.to_date("at").alias("day"), "of_holes").mapInArrow(_scan_in_order(rules.stuck), ORDERED)
    return materialize(placed, "ordered")


def _between_ranges(ordered: DataFrame, rules: SpikeRules) -> tuple[DataFrame, DataFrame]:
    """(carry, stuck readings) that only show across ranges, from at most 2 x `stuck` readings of each range.

    carry: range, series, offset (readings of the series in earlier ranges), last (the reading before the range).
    """
    few = ordered.filter("edge > 0").select("sid", "series", *SESSION, "reading", "stuck", "range", "pos", "edge", "of_holes")
    w = Window.partitionBy("series").orderBy("range", "pos")
    whole = F.when(F.col("edge").bitwiseAND(LAST) > 0, F.col("pos") + 1).otherwise(F.lit(0))
    seen = few.withColumns(
        {
            "offset": F.coalesce(F.sum(whole).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "before": F.lag(F.struct("reading", "range", "pos", "edge")).over(w),
        }
    )
    crossed = (F.col("before.edge").bitwiseAND(LAST) > 0) & (F.col("edge").bitwiseAND(FIRST) > 0) & (F.col("before.range") < F.col("range"))
    follows = F.coalesce(((F.col("before.range") == F.col("range")) & (F.col("before.pos") + 1 == F.col("pos"))) | crossed, F.lit(False))
    marked = seen.withColumn("opens", (~(follows & F.col("reading").eqNullSafe(F.col("before.reading")))).cast("int"))
    runs = marked.withColumn("run", F.sum("opens").over(w))
    long = (F.count(F.lit(1)).over(Window.partitionBy("series", "run")) >= rules.stuck) | F.max("stuck").over(Window.partitionBy("series", "run"))
    stored = materialize(runs.withColumns({"long": long, "last": F.when(crossed, F.col("before.reading")), "carries": F.coalesce(crossed, F.lit(False))}).drop("before"), "edges")
    carry = materialize(stored.filter("carries").select("range", "series", "offset", "last"), "carry")
    return carry, stored.filter("long AND NOT stuck AND NOT of_holes").select("sid", *SESSION, "reading")


def _clipped(x: Column, limit: float) -> Column:
    return F.greatest(F.lit(-limit), F.least(F.lit(limit), x))


def _level_at(place: Column) -> Column:
    """The level in force at a place of the series, from the sorted segments of its chunk; 0 without any."""
    found = F.aggregate(F.col("segments"), F.lit(0.0), lambda held, s: F.when(s["since"] <= place, s["level"]).otherwise(held))
    return F.coalesce(F.when(F.col("segments").isNotNull(), found), F.lit(0.0))


def _scored(rows: DataFrame, fit: DataFrame | None, levels: DataFrame | None, rules: SpikeRules) -> DataFrame:
    """`rows` with the level, the level before, and the residual in its own scale (null before the first fit)."""
    if fit is None:
        return rows.withColumns({"level": F.lit(0.0), "level_before": F.lit(0.0), "score": F.lit(None).cast("double")})
    if levels is None:
        at = rows.withColumns({"level": F.lit(0.0), "level_before": F.lit(0.0)})
        expected = F.col("phi") * F.coalesce(_clipped(F.col("prev_z"), rules.clip), F.lit(0.0))
        return at.join(fit.select("sid", "phi", "scale"), "sid").withColumn("score", (F.col("z") - expected) / F.col("scale"))
    leveled = rows.withColumn("chunk", F.floor(F.col("pos") / CHUNK)).join(levels, ["series", "chunk"], "left")
    at = leveled.withColumns({"level": _level_at(F.col("pos")), "level_before": _level_at(F.col("pos") - 1)}).drop("segments", "chunk")
    expected = F.col("level") + F.col("phi") * F.coalesce(_clipped(F.col("prev_z") - F.col("level_before"), rules.clip), F.lit(0.0))
    return at.join(fit.select("sid", "phi", "scale"), "sid").withColumn("score", (F.col("z") - expected) / F.col("scale"))


def _parted(scored: DataFrame, rules: SpikeRules) -> DataFrame:
    """(sid, series, pos, z, used, y, x, v): clipped readings about their level, null for outliers found so far; x and v are
    the predecessors and readings of whole pairs."""
    used = F.coalesce(F.abs("score") <= rules.innovation, F.lit(True))
    y = _clipped(F.col("z") - F.col("level"), rules.clip)
    x = F.when(F.col("prev_z").isNotNull() & used, _clipped(F.col("prev_z") - F.col("level_before"), rules.clip))
    return scored.select("sid", "series", "pos", "z", used.alias("used"), F.when(used, y).alias("y"), x.alias("x"), F.when(x.isNotNull(), y).alias("v"))


def _blocks(part: DataFrame) -> DataFrame:
    """Sums of each block of BLOCK successive readings; `used_z` and `wide` are for levels."""
    return part.groupBy("sid", "series", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("y"), F.coalesce(F.sum(F.col("y") * F.col("y")), F.lit(0.0)).alias("yy"),
        F.count("x").alias("m"), F.sum("x").alias("x"), F.sum("v").alias("v"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("v") * F.col("v")).alias("vv"),
        F.sum(F.col("x") * F.col("v")).alias("xv"), F.sum(F.when(F.col("used"), _clipped(F.col("z"), WIDE))).alias("used_z"), F.count_if("used").alias("used_n"),
        F.sum(_clipped(F.col("z"), WIDE)).alias("wide"), F.count(F.lit(1)).alias("all"),
    )


def _fit(blocks: DataFrame, rules: SpikeRules) -> DataFrame:
    """(sid, phi, scale, sd): autoregression, scale of its residual and of the readings about their level.

    Moments are taken about the means of the blocks, so that a level shift doesn't look like autocorrelation; the
    bias that this gives a coefficient, about -(1 + 3 phi) / BLOCK, is taken out.
    """
    c = lambda a, b, ab: F.sum(F.coalesce(F.col(ab) - F.col(a) * F.col(b) / F.col("m"), F.lit(0.0)))
    sums = blocks.groupBy("sid").agg(
        c("x", "x", "xx").alias("cxx"), c("x", "v", "xv").alias("cxv"), c("v", "v", "vv").alias("cvv"), F.sum(F.greatest(F.col("m") - 1, F.lit(0))).alias("free"),
        F.sum(F.when(F.col("n") > 0, F.col("yy") - F.col("y") * F.col("y") / F.col("n")).otherwise(0.0)).alias("cyy"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("free_y"),
    )
    raw = F.coalesce(F.try_divide(F.when(F.col("cxx") > 1e-12, F.col("cxv")), F.col("cxx")), F.lit(0.0))
    limit = F.lit(rules.phi_limit)
    fitted = sums.withColumn("phi", F.when(F.col("free") > BLOCK, F.greatest(-limit, F.least(limit, (raw + 1 / BLOCK) / (1 - 3 / BLOCK)))).otherwise(F.lit(0.0)))
    residual = F.try_divide(F.col("cvv") - 2 * F.col("phi") * F.col("cxv") + F.col("phi") * F.col("phi") * F.col("cxx"), F.col("free"))
    scale = F.greatest(F.lit(0.05), F.least(F.lit(1.0), F.coalesce(F.sqrt(F.greatest(residual, F.lit(0.0))), F.lit(1.0))))
    return fitted.select("sid", "phi", scale.alias("scale"), F.greatest(F.lit(0.05), F.coalesce(F.sqrt(F.greatest(F.try_divide(F.col("cyy"), F.col("free_y")), F.lit(0.0))), F.lit(1.0))).alias("sd"))


def _shift_tests(blocks: DataFrame, fit: DataFrame, rules: SpikeRules) -> DataFrame:
    """(sid, series, pos, k, score): the means of two adjoining windows differ, at every half window of every length.

    Each half window adds to the windows that it is part of, so no series is gathered; windows end where the series does.
    """
    half = [1 if k == 0 else 4**k // 2 for k in range(LEVELS)]
    units = blocks.select(
        "sid", "series", "n", "y", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor(F.col("block") / half[k]).alias("unit")) for k in range(LEVELS)])).alias("u")
    ).groupBy("sid", "series", "u").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    place = lambda shift, after: F.struct((F.col("u.unit") + shift).alias("unit"), F.lit(after).alias("after"))
    parts = F.when(F.col("u.k") == 0, F.array(place(1, False), place(0, True))).otherwise(F.array(place(1, False), place(2, False), place(0, True), place(-1, True)))
    side = lambda c, after: F.sum(F.when(F.col("p.after") == after, F.col(c)).otherwise(0)).alias(f"{c}_{'after' if after else 'before'}")
    windows = units.select("sid", "series", "u.k", "n", "y", F.explode(parts).alias("p")).groupBy("sid", "series", "k", "p.unit").agg(
        *[side(c, after) for c in ("n", "y") for after in (False, True)]
    )
    held = windows.filter(F.least("n_before", "n_after") >= rules.stuck).join(fit, "sid")
    gap = F.col("y_after") / F.col("n_after") - F.col("y_before") / F.col("n_before")
    error = F.col("sd") * F.sqrt((1 + F.col("phi")) / (1 - F.col("phi")) * (1 / F.col("n_after") + 1 / F.col("n_before")))
    step = F.get(F.array(*[F.lit(h * BLOCK) for h in half]), F.col("k"))
    return held.select("sid", "series", (F.col("unit") * step).alias("pos"), "k", (F.abs(gap) / error).alias("score")).filter(F.col("score") > rules.shift)


def _peaks(tests: DataFrame) -> DataFrame:
    """Of the tests that pass, those with the highest score among all that are nearer than their own window is long."""
    rank = F.struct("score", (-F.col("pos")).alias("pos"), (-F.col("k")).alias("k"))

    def reached(k: int) -> Column:
        # cells of half windows: places at or before a test's own are found by rounding up, those after it by rounding down
        step = BLOCK * max(1, 4**k // 2)
        up, down = F.ceil(F.col("pos") / step), F.floor(F.col("pos") / step)
        cells = F.array(up, down) if k == 0 else F.array(up, up + 1, down, down - 1)
        return F.transform(F.array_distinct(cells), lambda c: F.struct(F.lit(k).alias("k"), c.alias("cell")))

    best = tests.select("series", rank.alias("rank"), F.explode(F.concat(*[reached(k) for k in range(LEVELS)])).alias("c")).groupBy("series", "c").agg(F.max("rank").alias("best"))
    step = F.get(F.array(*[F.lit(BLOCK * max(1, 4**k // 2)) for k in range(LEVELS)]), F.col("k"))
    own = tests.withColumn("c", F.struct("k", F.floor(F.col("pos") / step).alias("cell")))
    return own.join(best, ["series", "c"]).filter(F.col("best") == rank).select("sid", "series", "pos", "k", "score")


def _placed(peaks: DataFrame, blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """(sid, series, pos, score): each peak at the reading that parts its two windows best, and one peak per place.

    First the best border of blocks inside the windows, then the best reading beside it. `rows` has series, pos and
    y; a peak sees 2 x BLOCK x 4^(LEVELS - 1) readings at most.
    """
    length = F.get(F.array(*[F.lit(BLOCK * 4**k) for k in range(LEVELS)]), F.col("k"))
    spans = peaks.withColumns({"peak": F.col("pos"), "length": length}).withColumns({"low": F.greatest(F.col("pos") - length, F.lit(0)), "high": F.col("pos") + length})
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / F.col("length")), F.floor((F.col("high") - 1) / F.col("length")))))
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor(F.col("block") * BLOCK / (BLOCK * 4**k)).alias("cell")) for k in range(LEVELS)]))
    own = blocks.join(peaks.select("series").distinct(), "series").select("series", "block", "n", "y", levels.alias("c")).select("series", "block", "n", "y", "c.*")
    inside = own.join(cells.select("sid", "series", "k", "cell", "peak", "low", "high", "score"), ["series", "k", "cell"]).filter(
        (F.col("block") * BLOCK >= F.col("low")) & (F.col("block") * BLOCK < F.col("high"))
    )
    key = ["series", "k", "peak"]

    def split(df: DataFrame, order: str, n0: Column, y0: Column) -> DataFrame:
        """`df` with the sums before each row and how well the row parts them from the rest."""
        upto = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sums = df.withColumns({"n_b": n0 + F.coalesce(F.sum("n").over(upto), F.lit(0)), "y_b": y0 + F.coalesce(F.sum("y").over(upto), F.lit(0.0))})
        n_a, y_a = F.col("n_all") - F.col("n_b"), F.col("y_all") - F.col("y_b")
        gain = F.pow(y_a / n_a - F.col("y_b") / F.col("n_b"), 2) * n_a * F.col("n_b") / F.col("n_all")
        return sums.withColumn("gain", F.when((F.col("n_b") > 0) & (n_a > 0), gain))

    whole = Window.partitionBy(*key)
    coarse = split(inside.withColumns({"n_all": F.sum("n").over(whole), "y_all": F.sum("y").over(whole)}), "block", F.lit(0), F.lit(0.0))
    at = coarse.groupBy("sid", *key, "score", "n_all", "y_all").agg(F.max_by(F.struct("block", "n_b", "y_b"), F.struct("gain", -F.col("block"))).alias("at"))
    # the sums before the block on the left of the border are those of the border less that block's own
    left = coarse.select(*key, F.col("block").alias("left"), F.col("n_b").alias("n0"), F.col("y_b").alias("y0"))
    first = at.withColumn("left", F.col("at.block") - 1).join(left, [*key, "left"], "left").withColumns(
        {"n0": F.coalesce("n0", "at.n_b"), "y0": F.coalesce("y0", "at.y_b"), "block": F.explode(F.array(F.col("at.block") - 1, F.col("at.block")))}
    )
    near = rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(first, ["series", "block"]).withColumn("n", F.col("y").isNotNull().cast("int"))
    fine = split(near.withColumn("y", F.coalesce("y", F.lit(0.0))), "pos", F.col("n0"), F.col("y0"))
    placed = fine.groupBy("sid", *key, "score").agg(F.max_by("pos", F.struct("gain", -F.col("pos"))).alias("pos"))
    beside = Window.partitionBy("series").orderBy("pos").rangeBetween(1 - 2 * BLOCK, 2 * BLOCK - 1)
    rank = F.struct("score", -F.col("pos"), -F.col("k"))
    return placed.withColumn("top", F.max(rank).over(beside)).filter(F.col("top") == rank).select("sid", "series", "pos", "score")


def _segments(shifts: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(levels, means) of the series that have shifts: levels has the segments of each (series, chunk), means the
    segments of a series with since, level and the level before."""
    ends = blocks.join(shifts.select("series").distinct(), "series").groupBy("series").agg((F.max("block") * BLOCK + BLOCK).alias("end"))
    starts = shifts.select("series", F.col("pos").alias("since")).distinct().unionByName(ends.select("series", F.lit(0).cast("bigint").alias("since")))
    by_place = Window.partitionBy("series").orderBy("since")
    cut = starts.distinct().withColumn("until", F.lead("since").over(by_place)).join(ends, "series").select("series", "since", F.coalesce("until", "end").alias("until"))
    spread = cut.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("since") / CHUNK), F.floor(F.col("until") / CHUNK))))
    inside = (F.col("block") * BLOCK >= F.col("since")) & (F.col("block") * BLOCK < F.col("until"))
    sums = blocks.withColumn("chunk", F.floor(F.col("block") * BLOCK / CHUNK)).join(spread, ["series", "chunk"]).filter(inside).groupBy("series", "since", "until").agg(
        F.coalesce(F.try_divide(F.sum("used_z"), F.sum("used_n")), F.sum("wide") / F.sum("all")).alias("level")
    )
    means = materialize(sums.withColumn("level_before", F.lag("level").over(by_place)), "levels")
    rows = means.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("since") / CHUNK), F.floor(F.col("until") / CHUNK))))
    return materialize(rows.groupBy("series", "chunk").agg(F.array_sort(F.collect_list(F.struct("since", "level"))).alias("segments")), "segments"), means


def _named(flags: DataFrame, sources: DataFrame) -> DataFrame:
    return flags.join(sources, "sid").select(*SOURCE, *SESSION, "reading", "kind", "score", "beyond")


def implausible_readings(readings: DataFrame, rules: SpikeRules = SpikeRules(), sources: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(flags, level shifts) of long readings as `readings_of` gives them.

    flags: SOURCE, SESSION, reading, kind, score, beyond with kind
      * `limit`: no scan can give the reading (NaN, infinite, not positive; holes negative or not whole);
      * `spike`: an additive outlier, its residual is more than `innovation` scales; score is the residual in scales;
      * `shift`: more than `innovation` robust sigmas from the source's median because its whole level is; score is that distance;
      * `stuck`: part of a run of `stuck` or more equal readings of one source and load (not of hole counts).
    `beyond` tells whether a spike or shift lies more than `mad_factor` x 1.4826 x MAD from the source's median (the exact
    rule, which every such reading passes the tests for); it is true for the other kinds. One reading may have several
    kinds. Null readings are no readings; NaN and infinite ones can only be `limit` or `stuck`. A source with MAD 0
    flags every reading that differs from its median. A reading whose predecessor in its load is none or not finite
    is tested against the level alone. An empty input gives empty results, extra columns are ignored.
    level shifts: SOURCE, load's series, since (day of the first reading of the new level), score, level, level_before in robust
    sigmas. Windows begin at blocks of BLOCK readings, the place is then the reading that parts them best; a series of
    one block has no place to test. `sources` may give the SOURCE rows that occur, if they can be had for less than a pass
    over the readings.
    """
    ordered = in_order(readings, rules)
    known = readings.select(*SOURCE) if sources is None else sources.select(*SOURCE)
    sources = materialize(known.distinct().select(_source_id().alias("sid"), *SOURCE), "sources")
    carry, crossing = _between_ranges(ordered, rules)
    stats = median_and_mad(ordered.filter(finite(F.col("reading"))), ["sid"], "reading", null_keys=False)

    distance, sigma = F.col("reading") - F.col("center"), F.col("mad") * MAD_TO_SIGMA
    standard = lambda d: F.when(F.col("mad") > 0, d / sigma).when(d == 0, F.lit(0.0)).otherwise(F.signum(d) * 1e12)
    before = F.coalesce("prev", "last")
    rows = (
        ordered.select("sid", "series", *SESSION, "reading", "day", "range", "pos", "prev").filter(finite(F.col("reading")))
        .join(carry, ["range", "series"], "left").join(stats.drop("n"), "sid")
        .withColumns({"z": standard(distance), "prev_z": F.when(finite(before), standard(before - F.col("center"))), "pos": F.col("pos") + F.coalesce("offset", F.lit(0))})
    )
    fit = levels = shifts = means = None
    for k in range(rules.rounds):
        part = _parted(_scored(rows, fit, levels, rules), rules)
        blocks = materialize(_blocks(part), "blocks")
        fit = materialize(_fit(blocks, rules), "fit")
        tests = materialize(_shift_tests(blocks, fit, rules), "tests")
        if not tests.isEmpty():
            new = _placed(materialize(_peaks(tests), "peaks"), blocks, part.select("series", "pos", "y"))
            if shifts is not None:
                # what is left of an accepted shift beside it is no other one
                old = shifts.select(F.col("series").alias("old_series"), F.col("pos").alias("old"))
                near = (F.col("series") == F.col("old_series")) & (F.abs(F.col("pos") - F.col("old")) < 2 * BLOCK)
                new = shifts.unionByName(new.join(old, near, "left_anti"))
            shifts = materialize(new, "shifts")
        if shifts is not None:
            levels, means = _segments(shifts, blocks)
        release(blocks, tests)
    scored = _scored(rows, fit, levels, rules)
    far = F.abs(distance) > rules.mad_factor * sigma
    spike = F.abs("score") > rules.innovation
    shifted = (F.abs("level") >= rules.level) & (F.abs("z") > rules.innovation)
    odd = scored.filter(spike | shifted).select(
        "sid", *SESSION, "reading", F.when(spike, "spike").otherwise("shift").alias("kind"), F.when(spike, F.col("score")).otherwise(F.col("z")).alias("score"), far.alias("beyond")
    )
    plain = lambda df, kind: df.select("sid", *SESSION, "reading", F.lit(kind).alias("kind"), F.lit(None).cast("double").alias("score"), F.lit(True).alias("beyond"))
    limits = ordered.filter(impossible(F.col("of_holes"), F.col("reading")))
    stuck = ordered.filter("stuck AND NOT of_holes").select("sid", *SESSION, "reading").unionByName(crossing)
    flags = odd.unionByName(plain(limits, "limit")).unionByName(plain(stuck, "stuck"))
    days = rows.select("series", "pos", "sid", "day")
    if means is None:
        none = days.filter(F.lit(False)).join(sources, "sid").select(*SOURCE, F.col("day").alias("since"))
        return _named(flags, sources), none.withColumns({c: F.lit(None).cast("double") for c in ("score", "level", "level_before")})
    found = means.join(shifts.select("series", F.col("pos").alias("since"), "score"), ["series", "since"])
    dated = days.join(found.withColumnRenamed("since", "pos"), ["series", "pos"])
    return (
        _named(flags, sources),
        dated.join(sources, "sid").select(*SOURCE, F.col("day").alias("since"), "score", "level", "level_before"),
    )
