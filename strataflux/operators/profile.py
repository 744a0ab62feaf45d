"""Data-quality profile of columns per load, and its departures from an accepted profile.

Besides the standard aggregates, the profile induces regular expressions for text columns by minimum
description length over all distinct values: every value has a chain of ever more general expressions
(itself, its character classes, its runs of classes, anything), and a bottom-up pass over this hierarchy
keeps the set of expressions that describes all distinct values in the fewest bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflux.operators.scaling import null_safe_join, weighted_quantiles
from strataflux.session import materialize

KEYS = ["load", "column_name"]
ACCEPTED = (
    "column_name", "null_share", "n_distinct", "min_value", "max_value", "median_value", "iqr_value", "value_pattern", "top_value", "top_share",
)


def long_values(df: DataFrame, load: str, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """(load, column_name, num, txt): one row per cell of the profiled columns."""
    none_n, none_t = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("num"), none_t.alias("txt")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column_name"), none_n.alias("num"), F.col(c).cast("string").alias("txt")) for c in text]
    return df.select(F.col(load).alias("load"), F.explode(F.array(*cells)).alias("c")).select("load", "c.*")


def value_counts(long: DataFrame) -> DataFrame:
    return long.groupBy(*KEYS, "num", "txt").agg(F.count(F.lit(1)).alias("rows"))


def _shape(v: Column) -> Column:
    """Character classes of a value: d digit, a lower-case letter, A upper-case letter; other characters stay."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "d")


def _runs(shape: Column) -> Column:
    return F.regexp_replace(shape, "([daA])\\1+", "$1")


def _regex(level: int, node: Column) -> Column:
    """The regular expression of a node of the hierarchy."""
    special = F.regexp_replace(node, r"([\\.\[\]{}()*+?^$|])", r"\\$1")
    if level == 0:
        return special
    many = "+" if level == 2 else ""
    # A first, so that the letters of later replacements are not replaced again
    marked = F.translate(special, "Aad", "\u0001\u0002\u0003")
    out = F.replace(marked, F.lit("\u0001"), F.lit(f"[A-Z]{many}"))
    out = F.replace(out, F.lit("\u0002"), F.lit(f"[a-z]{many}"))
    return F.replace(out, F.lit("\u0003"), F.lit(rf"\d{many}"))


def _count(text: Column, cls: str) -> Column:
    return F.length(text) - F.length(F.translate(text, cls, ""))


def induced_expressions(counts: DataFrame) -> DataFrame:
    """(load, column_name, level, node, txt, rows): every distinct text value with the expression chosen for it.

    level 0 is the value itself, 1 its classes letter by letter, 2 runs of classes, 3 `.*`. Coding: 8 bits per
    character of an expression, log2 of the class size per character left open, two bits per unit of
    log2(length + 1) for an open run, 8 bits per character under `.*`. A node is kept where it costs no more
    than the best cover of its children; the choice runs top-down, so exactly one ancestor of a value is chosen.
    """
    values = counts.filter("txt IS NOT NULL").select(*KEYS, "txt", "rows")
    shape = _shape(F.col("txt"))
    leaves = values.withColumns({"n1": shape, "n2": _runs(shape), "n3": F.lit(".*")})
    open_bits = _count(F.col("n1"), "d") * 3.33 + (_count(F.col("n1"), "a") + _count(F.col("n1"), "A")) * 4.71
    run_bits = F.length("n2") * 2 * F.log2(F.length("txt") + F.lit(1.0))
    leaves = leaves.withColumns(
        {
            "b0": F.greatest(F.length("txt"), F.lit(1)) * 8.0,
            "b1": open_bits,
            "b2": open_bits + run_bits,
            "b3": F.length("txt") * 8.0 + 8.0,
        }
    )
    level1 = leaves.groupBy(*KEYS, "n1", "n2", "n3").agg(
        F.sum("b0").alias("below"), *[F.sum(f"b{i}").alias(f"b{i}") for i in (1, 2, 3)]
    ).withColumns({"own": F.length("n1") * 8.0 + F.col("b1")}).withColumn("best", F.least("own", "below"))
    level2 = level1.groupBy(*KEYS, "n2", "n3").agg(
        F.sum("best").alias("below"), *[F.sum(f"b{i}").alias(f"b{i}") for i in (2, 3)]
    ).withColumns({"own": F.length("n2") * 16.0 + F.col("b2")}).withColumn("best", F.least("own", "below"))
    level3 = level2.groupBy(*KEYS, "n3").agg(F.sum("best").alias("below"), F.sum("b3").alias("b3")).withColumn(
        "own", F.col("b3") + 16.0
    )
    top = level3.select(*KEYS, (F.col("own") <= F.col("below")).alias("take3"))
    mid = level2.select(*KEYS, "n2", (F.col("own") <= F.col("below")).alias("take2"))
    low = level1.select(*KEYS, "n1", (F.col("own") <= F.col("below")).alias("take1"))
    path = null_safe_join(null_safe_join(null_safe_join(leaves, top, KEYS), mid, [*KEYS, "n2"]), low, [*KEYS, "n1"])
    level = F.when(F.col("take3"), 3).when(F.col("take2"), 2).when(F.col("take1"), 1).otherwise(0)
    node = F.when(level == 3, F.col("n3")).when(level == 2, F.col("n2")).when(level == 1, F.col("n1")).otherwise(F.col("txt"))
    return path.select(*KEYS, level.alias("level"), node.alias("node"), "txt", "n1", "n2", "rows")


def expression_report(chosen: DataFrame, accepted: DataFrame) -> DataFrame:
    """(load, column_name, level, expression, n_values, n_rows, n_nonconforming): the induced expressions and,
    for each, its rows that don't match the accepted expression `value_pattern` of the column."""
    known = accepted.select("column_name", "value_pattern")
    whole = F.concat(F.lit("^(?:"), F.col("value_pattern"), F.lit(r")\z"))
    bad = F.when(F.col("value_pattern").isNotNull() & ~F.rlike(F.col("txt"), whole), F.col("rows")).otherwise(F.lit(0))
    rendered = (
        F.when(F.col("level") == 3, F.lit(".*")).when(F.col("level") == 2, _regex(2, F.col("node")))
        .when(F.col("level") == 1, _regex(1, F.col("node"))).otherwise(_regex(0, F.col("node")))
    )
    return (
        chosen.join(known, "column_name", "left")
        .groupBy(*KEYS, "level", "node")
        .agg(F.count(F.lit(1)).alias("n_values"), F.sum("rows").alias("n_rows"), F.sum(bad).alias("n_nonconforming"))
        .select(*KEYS, "level", rendered.alias("expression"), "n_values", "n_rows", "n_nonconforming")
    )


def coverage_between_loads(chosen: DataFrame) -> DataFrame:
    """(load, column_name, previous_load, n_rows, n_covered, coverage): how much of a load's text the
    expressions induced from the load before it (by name) still match."""
    loads = chosen.select(*KEYS).distinct()
    before = loads.select(
        *KEYS, F.lag("load").over(Window.partitionBy("column_name").orderBy("load")).alias("previous_load")
    ).filter("previous_load IS NOT NULL")
    sets = chosen.select(F.col("load").alias("previous_load"), "column_name", "level", "node").distinct().withColumn("hit", F.lit(True))
    paths = chosen.join(before, KEYS).select(
        *KEYS, "previous_load", "txt", "rows",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("level"), F.col("txt").alias("node")), F.struct(F.lit(1).alias("level"), F.col("n1").alias("node")),
                F.struct(F.lit(2).alias("level"), F.col("n2").alias("node")), F.struct(F.lit(3).alias("level"), F.lit(".*").alias("node")),
            )
        ).alias("p"),
    ).select(*KEYS, "previous_load", "txt", "rows", "p.*")
    hit = paths.join(sets, ["previous_load", "column_name", "level", "node"], "left")
    per_value = hit.groupBy(*KEYS, "previous_load", "txt", "rows").agg(F.max("hit").alias("hit"))
    return per_value.groupBy(*KEYS, "previous_load").agg(
        F.sum("rows").alias("n_rows"), F.sum(F.when(F.col("hit"), F.col("rows")).otherwise(0)).alias("n_covered")
    ).withColumn("coverage", F.col("n_covered") / F.col("n_rows"))


def profile(df: DataFrame, load: str, numeric: Sequence[str], text: Sequence[str], accepted: DataFrame) -> DataFrame:
    """One row per load and column: counts, shares, range, quartiles, top value and departures' raw figures.

    Rows count as stored. NaN is a value: it lies outside every range and takes no part in the quartiles;
    null is none. A load whose column is all null has null shares of values. A null load is a load of its
    own. An empty input gives an empty profile; extra columns are ignored. `accepted` has the columns of
    the accepted profile; a column that it lacks is profiled without departures.
    """
    accepted = accepted.select(*ACCEPTED)
    long = long_values(df, load, numeric, text)
    counts = materialize(value_counts(long), "values")
    is_value = F.col("num").isNotNull() | F.col("txt").isNotNull()
    base = counts.join(accepted, "column_name", "left")
    outside = F.col("num").isNotNull() & (
        F.isnan("num") | (F.col("num") < F.col("min_value")) | (F.col("num") > F.col("max_value"))
    )
    shown = F.coalesce(F.col("num").cast("string"), F.col("txt"))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("rows")).otherwise(F.lit(0)))

    sums = base.groupBy(*KEYS).agg(
        F.sum("rows").alias("n_rows"),
        rows_where(~is_value).alias("n_null"),
        F.sum(F.when(is_value, 1).otherwise(0)).alias("n_distinct"),
        F.min(F.when(~F.isnan("num"), F.col("num"))).alias("min_num"),
        F.max(F.when(~F.isnan("num"), F.col("num"))).alias("max_num"),
        F.min("txt").alias("min_txt"),
        F.max("txt").alias("max_txt"),
        rows_where(outside).alias("n_outside"),
        rows_where(F.col("txt") == F.col("top_value")).alias("n_accepted_top"),
        F.max(F.when(is_value, F.struct(F.col("rows").alias("top_rows"), shown.alias("top_value")))).alias("top"),
    )
    quartiles = weighted_quantiles(counts, KEYS, "num", "rows", {"q1": 0.25, "median": 0.5, "q3": 0.75}).drop("n")
    expressions = expression_report(induced_expressions(counts), accepted)
    text_part = expressions.groupBy(*KEYS).agg(
        F.sum("n_nonconforming").alias("n_nonconforming"), F.count(F.lit(1)).alias("n_expressions")
    )
    joined = null_safe_join(null_safe_join(sums, quartiles, KEYS), text_part, KEYS)
    values = F.col("n_rows") - F.col("n_null")
    share = lambda c: F.try_divide(F.col(c), values)
    return joined.select(
        *KEYS, "n_rows", "n_null", (F.col("n_null") / F.col("n_rows")).alias("null_share"), "n_distinct", "min_num", "max_num",
        "min_txt", "max_txt", "q1", "median", "q3", share("n_outside").alias("outside_share"),
        F.col("top.top_value").alias("top_value"), F.try_divide(F.col("top.top_rows"), values).alias("top_share"),
        share("n_accepted_top").alias("accepted_top_share"), "n_expressions", share("n_nonconforming").alias("nonconforming_share"),
    )


def departures(
    profiled: DataFrame, accepted: DataFrame, null_rate: float = 0.08, distinct: float = 2.0, outside: float = 0.01,
    shift_iqr: float = 0.5, shift_share: float = 0.15,
) -> DataFrame:
    """(load, column_name, finding) for every figure of a profile that departs from the accepted one."""
    base = accepted.select(*[F.col(c).alias("column_name" if c == "column_name" else f"was_{c}") for c in ACCEPTED])
    moved = F.abs(F.col("median") - F.col("was_median_value")) > shift_iqr * F.col("was_iqr_value")
    shared = F.abs(F.col("accepted_top_share") - F.col("was_top_share")) > shift_share
    tests = {
        "null_rate": F.abs(F.col("null_share") - F.col("was_null_share")) > null_rate,
        "distinct": F.col("n_distinct") > distinct * F.col("was_n_distinct"),
        "range": F.col("was_min_value").isNotNull() & (F.col("outside_share") > outside),
        "pattern": F.col("was_value_pattern").isNotNull() & (F.col("nonconforming_share") > outside),
        "shift": F.when(F.col("was_median_value").isNotNull(), moved).otherwise(shared),
    }
    found = F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]), lambda x: x.isNotNull())
    return profiled.join(base, "column_name").select(*KEYS, F.explode(found).alias("finding"))
