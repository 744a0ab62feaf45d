import random
from statistics import quantiles

import numpy as np
from pyspark.sql import functions as F

from strataflux.operators.scaling import grouped_quantiles, median_and_mad, null_safe_join, previous_in_group, running_total, weighted_quantiles


def test_grouped_quantiles_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(x)) for x in rng.normal(size=30_000)] + [("ties", float(x)) for x in rng.integers(0, 3, 500)]
    rows += [(None, 4.0), (None, None), ("nan", float("nan")), ("one", 7.0), ("two", 1.0), ("two", 2.0)]
    rows += [(f"n{n}", float(x)) for n in range(3, 12) for x in range(n)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in grouped_quantiles(df, ["k"], "v", {"q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99}, accuracy=1000).collect()}
    assert "nan" not in got and got[None].med == 4.0
    for k in ("hot", "ties", "one", "two", "n3", "n4", "n9", "n11"):
        x = [v for g, v in rows if g == k]
        for name, p in (("q1", 25), ("med", 50), ("q3", 75), ("p99", 99)):
            assert abs(got[k][name] - np.percentile(x, p)) < 1e-12, (k, name)
        assert got[k].n == len(x)
    assert quantiles([1.0, 2.0])[1] == got["two"].med


def test_grouped_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert grouped_quantiles(empty, ["k"], "v", {"med": 0.5}).count() == 0


def test_lag_and_prefix_sum_across_buckets(spark):
    rnd = random.Random(3)
    rows = [(k, t // 10, t, rnd.randint(1, 9)) for k in ("a", None) for t in sorted(rnd.sample(range(200), 60))]
    df = spark.createDataFrame(rows, "k string, b int, t int, v int")
    lagged = {(r.k, r.t): r.prev_v for r in previous_in_group(df, ["k"], "b", ["t"], ["v"]).collect()}
    summed = {(r.k, r.t): r.s for r in running_total(df, ["k"], "b", ["t"], "v", "s").collect()}
    for k in ("a", None):
        own = sorted((t, v) for g, _, t, v in rows if g == k)
        for i, (t, _) in enumerate(own):
            assert lagged[k, t] == (own[i - 1][1] if i else None)
            assert summed[k, t] == sum(v for _, v in own[: i + 1])


def test_null_safe_join_matches_nulls(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    right = spark.createDataFrame([(None, 10)], "k string, b int")
    assert {(r.k, r.b) for r in null_safe_join(left, right, ["k"]).collect()} == {(None, 10), ("x", None)}
    assert null_safe_join(left, right, ["k"], "inner").agg(F.sum("b")).first()[0] == 10


def test_weighted_quantiles_and_mad_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(x)) for x in rng.normal(size=5_000).round(2)] + [(None, float(x)) for x in range(7)] + [("one", 3.0), ("nan", float("nan"))]
    rows += [(f"n{n}", float(x * x)) for n in range(2, 9) for x in range(n)] + [("ties", 2.0)] * 1_999 + [("many ties", 2.0)] * 2_000
    df = spark.createDataFrame(rows, "k string, v double")
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    got = {r.k: r for r in weighted_quantiles(counts, ["k"], "v", "c", {"q1": 0.25, "med": 0.5}).collect()}
    spread = {r.k: r for r in median_and_mad(df, ["k"], "v").collect()}
    assert set(got) == set(spread) == {k for k, _ in rows} - {"nan"}
    for k in got:
        x = np.array([v for g, v in rows if g == k])
        assert abs(got[k].q1 - np.percentile(x, 25)) < 1e-12 and abs(got[k].med - np.median(x)) < 1e-12 and got[k].n == len(x)
        assert abs(spread[k].center - np.median(x)) < 1e-12 and abs(spread[k].mad - np.median(np.abs(x - np.median(x)))) < 1e-12


def test_mad_of_small_groups_only_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, float("inf")), ("b", None)], "k string, v double")
    got = {r.k: (r.n, r.center, r.mad) for r in median_and_mad(df, ["k"], "v").collect()}
    assert got == {"a": (2, 2.5, 1.5), None: (1, float("inf"), None)}
    assert median_and_mad(df.filter("k = 'c'"), ["k"], "v").count() == 0
