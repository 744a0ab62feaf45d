import numpy as np

from strataflux.llm import digests

SCHEMA = "k string, load string, value double, v double, c int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0, 2) for r in rows], SCHEMA)


def test_percentiles_within_the_stated_rank_error(spark):
    rng = np.random.default_rng(6)
    rows = [("normal", f"l{i % 3}", float(x)) for i, x in enumerate(rng.normal(size=20_000))]
    rows += [("heavy", f"l{i % 2}", float(x)) for i, x in enumerate(np.exp(3 * rng.normal(size=8_000)))]
    rows += [("ties", "l0", float(x)) for x in [0.0] * 3_000 + list(rng.random(3_000))] + [("one", None, 5.0), (None, "l1", 1.0), (None, "l1", 2.0)]
    got = digests.certified_percentiles(frame(spark, rows), ["k"], compression=200, rank_error=0.02).collect()
    assert len(got) == 5 * len(digests.PERCENTILES) and all(r.certified for r in got)
    for r in got:
        x = np.array([v for k, _, v in rows if k == r.k])
        low, high = (x < r.estimate).mean(), (x <= r.estimate).mean()
        assert abs(max(low - r.percentile, r.percentile - high, 0.0) - r.rank_error) < 1e-12 and r.n == len(x)


def test_hot_groups_are_split_and_merge_again(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", "l", float(x)) for x in rng.normal(size=6_000)]
    parts = digests.build_digests(frame(spark, rows), ["k"], compression=200, rows_per_digest=1_000)
    assert digests.build_digests(frame(spark, rows), ["k"], compression=200, rows_per_digest=10).count() > 1_000  # 600 parts in 256 folds
    merged = digests.merge_digests(parts, ["k"], 200).collect()
    assert sum(r.weight for r in merged) == 6_000 and len(merged) <= 101
    assert parts.count() > 400
    mass = sum(r.mean * r.weight for r in merged) / 6_000
    assert abs(mass - np.mean([v for _, _, v in rows])) < 1e-9


def test_stored_digests_combine_loads(spark):
    rng = np.random.default_rng(8)
    rows = [("g", f"l{i % 4}", float(x)) for i, x in enumerate(rng.gamma(2.0, size=8_000))]
    per_load = digests.build_digests(frame(spark, rows), ["k", "load"], compression=200)
    stored = digests.pack_digests(per_load, ["k", "load"])
    merged = digests.merge_digests(digests.unpack_digests(stored, ["k", "load"]), ["k"], 200)
    got = digests.estimates(merged, ["k"], [0.5]).first().estimates[0]
    x = np.array([v for _, _, v in rows])
    assert abs((x < got).mean() - 0.5) < 0.01


def test_no_values(spark):
    assert digests.certified_percentiles(frame(spark, []), ["k"]).count() == 0
