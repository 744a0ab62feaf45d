"""Order-dependent building blocks that never put one whole group into one task.

* `grouped_quantiles`, `median_and_mad`: exact percentiles per group from a mergeable sketch and counting passes.
* `previous_in_group`: lag over a group that is cut into order-preserving buckets.
* `running_total`: prefix sum over a group that is cut into order-preserving buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflux.session import materialize, release


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on `keys` where null equals null; the right side's key columns are dropped."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"__r_{k}"])
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


#: groups of fewer values are ranked whole; brackets of others are cut into so many bins
SMALL_GROUP = 2_000
BINS = 256


def _sketch(rows: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """(keys, n, low, high, q): one approximate percentile per entry of `probs`, from a mergeable sketch of bounded size."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("__low"), F.max("__v").alias("__high"),
        F.percentile_approx("__v", [float(p) for p in probs], F.lit(accuracy)).alias("__q"),
    )


def _bin(low: Column, high: Column, v: Column) -> Column:
    """The bin of a value inside its bracket; a bracket without finite width has one bin."""
    width = high - low
    return F.when((width > 0) & (width < float("inf")), F.floor((v - low) / width * BINS)).otherwise(F.lit(0)).cast("int")


def _ranked(rows: DataFrame, keys: list[str], brackets: DataFrame, probs: Sequence[float], null_keys: bool = True) -> DataFrame:
    """(keys, n, r): the exact interpolated percentiles of `__v`, of which brackets[i] holds the two values around rank i.

    `brackets` has keys, n and b, an array of struct<low, high>. The first pass counts bins of each bracket, which
    are BINS at most, and whatever lies below it; the second counts the values of the one or two bins that hold the
    rank. So a group of any size leaves a bounded number of rows to be ranked.
    """
    place = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    match = null_safe_join if null_keys else (lambda left, right, on, how="left": left.join(right, on, how))
    joined = match(rows, brackets, keys, "inner")
    v, spots = F.col("__v"), range(len(probs))

    def cell(i: int, code: Column) -> Column:
        return F.struct(F.lit(i).alias("i"), code.alias("x"))

    def bracket(i: int) -> tuple[Column, Column, Column]:
        low, high = F.col("__b")[i]["low"], F.col("__b")[i]["high"]
        return low, high, _bin(low, high, v)

    def counted(i: int) -> Column:
        low, high, code = bracket(i)
        return F.when(v < low, cell(i, F.lit(-1))).when(v <= high, cell(i, code))

    rank = lambda i: F.get(F.array(*place), i)
    def entries(of, df: DataFrame) -> DataFrame:  # noqa: ANN001
        # one bracket needs no array per row
        one = of(0) if len(probs) == 1 else F.explode(F.array_compact(F.array(*[of(i) for i in spots])))
        return df.select(*keys, "n", one.alias("__c")).filter(F.col("__c").isNotNull())

    bins = entries(counted, joined).groupBy(*keys, "n", "__c").agg(F.count(F.lit(1)).alias("__k"))
    order = Window.partitionBy(*keys, "__c.i").orderBy("__c.x").rowsBetween(Window.unboundedPreceding, 0)
    upto = bins.withColumn("__upto", F.sum("__k").over(order)).withColumn("__before", F.col("__upto") - F.col("__k"))
    holds = lambda r: (F.col("__before") <= r) & (r < F.col("__upto"))
    chosen = upto.filter((F.col("__c.x") >= 0) & (holds(F.floor(rank(F.col("__c.i")))) | holds(F.ceil(rank(F.col("__c.i"))))))
    picked = chosen.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("__c.i").alias("i"), F.col("__c.x").alias("x"), F.col("__before").alias("before"))).alias("__bins")
    )
    edges = match(brackets, picked, keys)
    own = lambda i: F.filter("__bins", lambda b: b["i"] == i)
    cut = edges.select(
        *keys, "n", "__b",
        F.array(*[F.struct(F.array_min(F.transform(own(i), lambda b: b["x"])).alias("first"), F.array_max(F.transform(own(i), lambda b: b["x"])).alias("last"),
                           F.array_min(F.transform(own(i), lambda b: b["before"])).alias("before")) for i in spots]).alias("__t"),
    )
    limits = materialize(cut, "limits")  # stored, so that its size is known and the rows don't travel for it

    def kept(i: int) -> Column:
        low, high, code = bracket(i)
        return F.when(v.between(low, high) & code.between(F.col("__t")[i]["first"], F.col("__t")[i]["last"]), F.struct(F.lit(i).alias("i"), F.col("__t")[i]["before"].alias("before"), v.alias("v")))

    values = entries(kept, match(rows, limits, keys, "inner")).groupBy(*keys, "n", "__c").agg(F.count(F.lit(1)).alias("__k"))
    along = Window.partitionBy(*keys, "__c.i").orderBy("__c.v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumn("__upto", F.col("__c.before") + F.sum("__k").over(along)).withColumn("__before", F.col("__upto") - F.col("__k"))
    at = lambda i, r: F.max(F.when((F.col("__c.i") == i) & (F.col("__before") <= r) & (r < F.col("__upto")), F.col("__c.v")))
    ends = ranked.groupBy(*keys, "n").agg(*[at(i, f(place[i])).alias(f"__{name}{i}") for i in spots for name, f in (("lo", F.floor), ("hi", F.ceil))])
    missed = F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")
    out = []
    for i in spots:
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        exact = F.when(low == high, low).otherwise(low + (high - low) * (place[i] - F.floor(place[i])))
        out.append(F.when(low.isNull() | high.isNull(), missed).otherwise(exact))
    return ends.select(*keys, "n", F.array(*out).alias("r"))


def _valued(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """One row per group: the keys, `n` and an exact, linearly interpolated percentile per entry of `probs`.

    A sketch brackets every wanted rank by two values, with ten times its rank error to spare; two counting passes
    over the brackets find the values. `df` is read three times: pass a stored table where it is costly. Null and NaN
    values are left out; groups without values don't appear. A bracket that misses its rank (impossible while
    the sketch keeps its bound) raises an error.
    """
    keys, names = list(keys), list(probs)
    rows, margin = _valued(df, keys, value), 20.0 / accuracy
    wanted = [min(1.0, max(0.0, probs[n] + side * margin)) for n in names for side in (-1, 1)]
    small = F.col("n") < SMALL_GROUP
    b = [F.struct(F.when(small, F.col("__low")).otherwise(F.col("__q")[2 * i]).alias("low"), F.when(small, F.col("__high")).otherwise(F.col("__q")[2 * i + 1]).alias("high")) for i in range(len(names))]
    brackets = materialize(_sketch(rows, keys, wanted, accuracy).select(*keys, "n", F.array(*b).alias("__b")), "brackets")
    found = _ranked(rows, keys, brackets, [probs[n] for n in names])
    return found.select(*keys, "n", *[F.col("r")[i].alias(n) for i, n in enumerate(names)])


def _middle(x: Column) -> Column:
    """The interpolated median of a sorted array, null of an empty one."""
    place = (F.size(x) - 1) / 2
    low, high = F.get(x, F.floor(place).cast("int")), F.get(x, F.ceil(place).cast("int"))
    return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))


def _whole_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, center, mad) of groups that are known to hold fewer than SMALL_GROUP values, each sorted as one array."""
    sorted_ = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("__v")).alias("__x")).withColumn("center", _middle(F.col("__x")))
    away = F.filter(F.transform("__x", lambda x: F.abs(x - F.col("center"))), lambda d: ~F.isnan(d))
    apart = sorted_.withColumn("__d", F.sort_array(away))
    return apart.select(*keys, F.size("__x").cast("bigint").alias("n"), "center", _middle(F.col("__d")).alias("mad"))


def median_and_mad(df: DataFrame, keys: Sequence[str], value: str, accuracy: int = 10_000, null_keys: bool = True) -> DataFrame:
    """(keys, n, center, mad): exact median, and exact median of the distances from it, per group.

    Groups under SMALL_GROUP values are sorted whole. For the others one sketch brackets both: distances of its grid of
    percentiles from the median tell where the median distance lies. The small tables between the passes, of which there are
    five over `df` beside that over small groups, are stored. `null_keys=False` promises keys without nulls.
    """
    keys, grid = list(keys), accuracy // 10
    match = null_safe_join if null_keys else (lambda left, right, on, how="left": left.join(right, on, how))
    rows, half = _valued(df, keys, value), accuracy // 20
    sketch = materialize(_sketch(rows, keys, [k / grid for k in range(grid + 1)], accuracy), "sketch")
    few = sketch.filter(F.col("n") < SMALL_GROUP).select(*keys)
    many = sketch.filter(F.col("n") >= SMALL_GROUP)
    small = _whole_groups(match(rows, few, keys, "inner"), keys)
    if many.isEmpty():
        out = materialize(small, "spread")
        release(sketch)
        return out
    pair = lambda low, high: F.array(F.struct(low.alias("low"), high.alias("high")))
    first = materialize(many.select(*keys, "n", pair(F.col("__q")[half - 3], F.col("__q")[half + 3]).alias("__b")), "brackets")
    centers = materialize(match(many, _ranked(rows, keys, first, [0.5], null_keys).select(*keys, F.col("r")[0].alias("center")), keys, "inner"), "centers")
    off = F.array_sort(F.transform("__q", lambda x: F.abs(x - F.col("center"))))
    second = materialize(centers.select(*keys, "n", pair(off[half - 8], off[half + 8]).alias("__b")), "brackets")
    center = materialize(centers.select(*keys, "center"), "center")
    away = match(rows, center, keys, "inner").select(*keys, F.abs(F.col("__v") - F.col("center")).alias("__v"))
    spread = _ranked(away.filter(~F.isnan("__v")), keys, second, [0.5], null_keys).select(*keys, F.col("r")[0].alias("mad"))
    out = materialize(match(centers.select(*keys, "n", "center"), spread, keys).unionByName(small), "spread")
    release(sketch, first, centers, center, second)
    return out


def previous_in_group(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """`df` with `prev_<c>` for each of `cols`: the value in the row before, by `order`, within `keys`.

    `bucket` must not decrease along `order`. Rows are windowed per (keys, bucket); only the last row
    of each bucket travels to the next one, so a hot group is spread over as many tasks as it has buckets.
    The first row of a group gets nulls. `df` is read twice: pass a materialized table.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    by_time = Window.partitionBy(*keys, bucket).orderBy(*order)
    inner = df.withColumn("__lag", F.lag(F.struct(*cols)).over(by_time))
    tails = df.groupBy(*keys, bucket).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__tail"))
    carried = tails.select(
        *keys, bucket, F.lag("__tail").over(Window.partitionBy(*keys).orderBy(bucket)).alias("__carry")
    )
    joined = null_safe_join(inner, carried, [*keys, bucket])
    prev = F.coalesce("__lag", "__carry")
    return joined.withColumns({f"prev_{c}": prev[c] for c in cols}).drop("__lag", "__carry")


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], amount: str, name: str
) -> DataFrame:
    """`df` with `name`: the sum of `amount` over this row and all before it by `order` within `keys`.

    Same bucketing as `previous_in_group`: bucket sums are accumulated first, rows only within their bucket.
    """
    keys, order = list(keys), list(order)
    sums = df.groupBy(*keys, bucket).agg(F.sum(amount).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, bucket, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.withColumn("__within", F.sum(amount).over(within))
    joined = null_safe_join(inner, offsets, [*keys, bucket])
    return joined.withColumn(name, F.col("__within") + F.col("__offset")).drop("__within", "__offset")


def weighted_quantiles(counts: DataFrame, keys: Sequence[str], value: str, weight: str, probs: dict[str, float], cuts: int = 256) -> DataFrame:
    """As `grouped_quantiles`, from one row per group and value with the number of its occurrences in `weight`.

    A group's values are cut into buckets at approximate percentiles of its different values; prefix sums over the buckets
    find the ranks, so a group with very many values is spread over `cuts` tasks. `counts` should be a stored table.
    """
    keys = list(keys)
    rows = _valued(counts, [*keys, weight], value).withColumnRenamed(weight, "__w")
    grid = F.percentile_approx("__v", [i / cuts for i in range(1, cuts)], F.lit(10_000))
    edges = materialize(rows.groupBy(*keys).agg(F.sum("__w").alias("n"), grid.alias("__q")), "cuts")
    bucket = F.size(F.filter("__q", lambda q: q < F.col("__v"))).alias("__bucket")
    placed = null_safe_join(rows, edges, keys, "inner").select(*keys, "n", "__v", "__w", bucket)
    upto = running_total(placed, keys, "__bucket", ["__v"], "__w", "__upto")
    out = []
    at = lambda r: F.max(F.when((F.col("__upto") - F.col("__w") <= r) & (r < F.col("__upto")), F.col("__v")))
    for name, p in probs.items():
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = at(F.floor(place)), at(F.ceil(place))
        out.append(F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(name))
    return upto.groupBy(*keys, "n").agg(*out)
